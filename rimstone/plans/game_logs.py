"""Silver team game logs: one typed, keyed, latest row per team and game, and the checks on them."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.operators.checks import (
    WARN,
    GroupCheck,
    RowCheck,
    duplicate_keys,
    failing_check_rows,
    groups_breaking,
    holds,
    in_range,
    in_values,
    length_is,
    not_latest,
    not_null,
    summarize,
    summarize_failing,
)
from rimstone.operators.cleaning import clean
from rimstone.operators.dedup import latest_per_key
from rimstone.functions import hash_key
from rimstone.plans.silver_build import Built, write_audit_publish

TABLE = "league_game_logs_00_t_regular_season"
TABLE_COMMENT = "Regular-season box-score totals, one row per team and game."

# The silver contract. Columns: name, type, whether NULL is refused, text length, accepted range,
# rule with the column on its left, comment.
CONTRACT = [
    ("season_sk", "string", True, 64, None, None, "Hash of season_id"),
    ("season_id", "string", True, 5, None, "= concat('2', split_part(season, '-', 1))", "Season type digit and start year"),
    ("season", "string", True, 7, None, None, "Season label"),
    ("team_sk", "string", True, 64, None, None, "Hash of team_id"),
    ("team_id", "string", True, 10, None, None, "Team number"),
    ("team_abbreviation", "string", True, 3, None, "= left(matchup, 3)", "Team code"),
    ("team_name", "string", True, None, None, None, "Team name"),
    ("game_sk", "string", True, 64, None, None, "Hash of game_id"),
    ("game_id", "string", True, 10, None, None, "Game number, the same for both teams"),
    ("game_date", "date", True, None, None, None, "Day of the game"),
    ("matchup", "string", True, None, None, r"rlike r'^[A-Z]{3} (vs\.|@) [A-Z]{3}$'", "Team and opponent; @ means away"),
    ("wl", "string", True, None, None, None, "W or L"),
    ("min", "smallint", True, None, (240, 340), None, "Minutes of all players"),
    ("fgm", "smallint", True, None, (20, 65), None, "Field goals made"),
    ("fga", "smallint", True, None, (60, 125), None, "Field goals tried"),
    ("fg_pct", "decimal(4,3)", False, None, (0, 1), "<=> round(fgm / nullif(fga, 0), 3)", "Share of field goals made"),
    ("fg3m", "smallint", True, None, (0, 30), None, "Three-pointers made"),
    ("fg3a", "smallint", True, None, (10, 70), None, "Three-pointers tried"),
    ("fg3_pct", "decimal(4,3)", False, None, (0, 1), "<=> round(fg3m / nullif(fg3a, 0), 3)", "Share of three-pointers made"),
    ("ftm", "smallint", True, None, (0, 50), None, "Free throws made"),
    ("fta", "smallint", True, None, (0, 60), None, "Free throws tried"),
    ("ft_pct", "decimal(4,3)", False, None, (0, 1), "<=> round(ftm / nullif(fta, 0), 3)", "Share of free throws made"),
    ("oreb", "smallint", True, None, (0, 30), None, "Offensive rebounds"),
    ("dreb", "smallint", True, None, (10, 60), None, "Defensive rebounds"),
    ("reb", "smallint", True, None, (20, 75), "= oreb + dreb", "Rebounds"),
    ("ast", "smallint", True, None, (5, 50), None, "Assists"),
    ("stl", "smallint", True, None, (0, 25), None, "Steals"),
    ("blk", "smallint", True, None, (0, 20), None, "Blocks"),
    ("tov", "smallint", True, None, (0, 35), None, "Turnovers"),
    ("pf", "smallint", True, None, (0, 40), None, "Fouls"),
    ("pts", "smallint", True, None, (65, 180), "= 2 * fgm + fg3m + ftm", "Points"),
    ("plus_minus", "smallint", True, None, (-75, 75), None, "Points minus the opponent's points"),
    ("_bronze_path", "string", True, None, None, "like '%/' || season || '/' || _source_name || '%'", "Bronze file of the row"),
    ("_source_name", "string", True, None, None, None, "Source of the row"),
    ("_ingested_at", "timestamp", True, None, None, None, "Load time in bronze"),
    ("_processed_at", "timestamp", True, None, None, None, "Build time in silver"),
]
COLUMNS = [name for name, *_ in CONTRACT]
KEY_COLUMNS = {"season_sk": "season_id", "team_sk": "team_id", "game_sk": "game_id"}
TRIMMED = ["season_id", "team_id", "team_abbreviation", "team_name", "game_id", "matchup", "wl", "season"]
LINEAGE = ["_bronze_path", "_source_name", "_ingested_at"]


def silver_schema() -> T.StructType:
    """Declared columns with their comments."""
    fields = [
        T.StructField(name, T._parse_datatype_string(dtype), True, {"comment": comment})
        for name, dtype, *_, comment in CONTRACT
    ]
    return T.StructType(fields)


def silver(bronze: DataFrame, processed_at: Column | datetime | None = None) -> DataFrame:
    """Latest row per season, team and game, with declared types, surrogate keys and column order.

    Rows are grouped by the trimmed ids, which is the same as by their hashes, so that hashes are computed
    only for rows that stay and are not shuffled.
    """
    casts = {n: d for n, d, *_ in CONTRACT if d in ("date", "smallint", "decimal(4,3)")}
    typed = clean(bronze, trims=TRIMMED, casts=casts, keep=LINEAGE)
    latest = latest_per_key(typed, list(KEY_COLUMNS.values()), ["_ingested_at", "_bronze_path"])
    keyed = latest.withColumns({sk: hash_key(i) for sk, i in KEY_COLUMNS.items()})
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at)
    return keyed.withColumn("_processed_at", stamp).select(*COLUMNS)


def row_checks() -> list[RowCheck]:
    """The 74 checks that look at one row at a time."""
    checks = [
        holds("made_within_tried", "fgm <= fga and fg3m <= fg3a and ftm <= fta and fg3m <= fgm and fg3a <= fga"),
        holds(
            "played_in_season",
            "year(game_date) between cast(split_part(season, '-', 1) as int) "
            "and cast(split_part(season, '-', 1) as int) + 1",
        ),
        holds("result_matches_margin", "(wl = 'W' and plus_minus > 0) or (wl = 'L' and plus_minus < 0)"),
    ]
    for name, _, required, length, accepted, rule, _ in CONTRACT:
        if required:
            checks.append(not_null(name))
        if length:
            checks.append(length_is(name, length))
        if accepted:
            checks.append(in_range(name, *accepted, severity=WARN))
        if rule:
            checks.append(holds(f"rule_{name}", rule, column=name))
    checks.append(in_values("wl", ["W", "L"]))
    return checks


def games_without_two_zero_sum_rows(table: DataFrame) -> DataFrame:
    """Games that do not have exactly two rows whose margins cancel out."""
    measures = {"row_count": F.count(F.lit(1)), "plus_minus_sum": F.sum("plus_minus")}
    rule = "not (row_count <> 2 or plus_minus_sum <> 0)"
    return groups_breaking(table, ["season_sk", "game_sk"], measures, rule)


def rows_not_latest(table: DataFrame, bronze: DataFrame) -> DataFrame:
    """Silver rows older than the latest bronze row of their key."""
    return not_latest(table, bronze, list(KEY_COLUMNS.values()), "_ingested_at")


def check_table(table: DataFrame, bronze: DataFrame) -> DataFrame:
    """Failures of all 77 checks. Give the written table, as it is read once per kind of check."""
    parts = [
        summarize(table, row_checks()),
        summarize_failing(
            "unique_team_game", duplicate_keys(table, list(KEY_COLUMNS)), "unique_combination_of_columns"
        ),
        summarize_failing("not_latest_bronze", rows_not_latest(table, bronze), "singular"),
        summarize_failing("not_two_zero_sum_rows", games_without_two_zero_sum_rows(table), "singular"),
    ]
    return reduce(DataFrame.unionByName, parts)


def failing_rows_of(table: DataFrame, bronze: DataFrame) -> DataFrame:
    """Every row that fails one of the 77 checks, once for each check it fails."""
    ids = tuple(KEY_COLUMNS.values())
    groups = [
        GroupCheck(
            "unique_team_game", "unique_combination_of_columns", tuple(KEY_COLUMNS), duplicate_keys(table, list(KEY_COLUMNS))
        ),
        GroupCheck("not_latest_bronze", "singular", (*ids, "_ingested_at"), rows_not_latest(table, bronze)),
        GroupCheck(
            "not_two_zero_sum_rows", "singular", ("season_sk", "game_sk"), games_without_two_zero_sum_rows(table)
        ),
    ]
    return failing_check_rows(table, row_checks(), groups)


def build(bronze: DataFrame, processed_at: Column | datetime | None = None, *, schema: str = "silver") -> Built:
    """Build the silver table, check it, and publish it if no error check failed; see `write_audit_publish`."""
    return write_audit_publish(
        silver(bronze, processed_at),
        TABLE,
        silver_schema(),
        lambda table: check_table(table, bronze),
        lambda table: failing_rows_of(table, bronze),
        schema=schema,
        description=TABLE_COMMENT,
    )
