"""Entry points, one per dataset: skip what is done, publish the rest, reconcile whatever happened.

Fetching is not part of this package: `landing` reads what a fetcher has landed, and a bronze dataset is the
landed rows of the keys that an earlier bronze dataset asks for.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.errors import EmptyDataset
from rimstone.operators.keyed import budget_report, covered_by, distinct_keys, enforce_budget
from rimstone.operators.ledger import Ledger
from rimstone.operators.skew import spread_join
from rimstone.plans.injury_reports import DecodedReports, parse_reports
from rimstone.plans.publish import ingest, ingest_many, ingest_targets, publish, publish_raw, reconcile
from rimstone.sinks.naming import Target, report_folder
from rimstone.sources.datasets import (
    BOX_SCORE_DATASETS,
    GAME_LOG_TYPES,
    GAME_LOGS,
    INJURIES,
    PLAYERS,
    PLAY_BY_PLAY,
    TEAMS,
    Landed,
    LandedDataset,
)
from rimstone.sources.drift import expand, load_datasets
from rimstone.sources.files import file_path, season_of


def _target(dataset: LandedDataset) -> Target:
    return Target(dataset.source_name, dataset.path, dataset.s3_key)


def rows_per_source(rows: DataFrame, keys: DataFrame, key: str, key_in_list: str) -> DataFrame:
    """Rows of the listed keys, once per source that lists the key, with that `source_name`."""
    sources = keys.groupBy(F.col(key_in_list).alias(key)).agg(F.collect_set("source_name").alias("_sources"))
    landed = rows.drop("source_name")
    found = spread_join(landed, sources, [key])
    return found.select(*landed.columns, F.explode("_sources").alias("source_name"))


def require_covered(keys: DataFrame, landed: Iterable[DataFrame], key: str, key_in_list: str) -> None:
    """Raise for a source that lost more keys than its budget allows, or all of them.

    `keys(source_name, ...)` are the keys asked for. A key has failed if no frame of the response has a row for it;
    one frame alone may lack it.
    """
    found = None
    for frame in landed:
        each = frame.select(key)
        found = each if found is None else found.unionByName(each)
    wanted = keys.select("source_name", F.col(key_in_list).alias(key)).where(F.col(key).isNotNull()).distinct()
    marked = spread_join(wanted, found.distinct().withColumn("_found", F.lit(True)), [key], "left")
    error = F.when(F.col("_found").isNull(), "nothing landed")
    enforce_budget(budget_report(marked.select("source_name", key, error.alias("error")), key))


def ingest_league_game_logs(
    ledger: Ledger, landing: Landed, bronze: Landed, season: str, kind: str = "T", season_type: str = "Regular Season"
) -> int | None:
    target = _target(bronze.game_log_dataset(season, kind, season_type))
    source = landing.game_log_dataset(season, kind, season_type)
    return ingest(ledger, bronze.root, target, source.read)


def ingest_game_log_seasons(
    ledger: Ledger, landing: Landed, bronze: Landed, seasons: Sequence[str], kind: str = "T", season_type: str = "Regular Season"
) -> dict[str, int]:
    """Game logs of many seasons, which may have landed in different types, in one job; the result is keyed by season.

    Seasons are published in the given order. The first that has not landed fails, and those after it stay pending.
    """
    targets = {s: _target(bronze.game_log_dataset(s, kind, season_type)) for s in seasons}

    def build(spark: SparkSession, names: Sequence[str]) -> DataFrame:
        landed = [landing.game_log_dataset(s, kind, season_type).path for s in names]
        there = [path for pattern in landed for path in expand(spark, pattern)]
        if not there:
            raise EmptyDataset(f"none of {len(names)} seasons has landed")
        return load_datasets(
            spark, there, GAME_LOG_TYPES, lambda rows: rows.withColumn("_season", season_of(file_path()))
        )

    return ingest_targets(ledger, bronze.root, targets, build, "_season")


def ingest_play_by_play(ledger: Ledger, landing: Landed, bronze: Landed, season: str) -> int | None:
    def build(spark: SparkSession) -> DataFrame:
        keys = bronze.game_ids_by_source(season, GAME_LOGS, "GAME_ID")
        rows = landing.get_play_by_play_logs(season)
        require_covered(keys, [rows], "gameId", "GAME_ID")
        return rows_per_source(rows, keys, "gameId", "GAME_ID")

    return ingest(ledger, bronze.root, _target(bronze.play_by_play_dataset(season)), build)


def ingest_box_scores(ledger: Ledger, landing: Landed, bronze: Landed, season: str) -> dict[str, int]:
    """Datasets of all variants that are not done; the result is keyed by `variant/dataset`."""
    counts = {}
    for variant in BOX_SCORE_DATASETS:
        targets = {n: _target(d) for n, d in bronze.box_score_datasets(season, variant).items()}

        def build(spark: SparkSession, names: Sequence[str], variant: str = variant) -> dict[str, DataFrame]:
            keys = bronze.game_ids_by_source(season, PLAY_BY_PLAY, "gameId")
            landed = {n: d.read(spark) for n, d in landing.box_score_datasets(season, variant).items()}
            require_covered(keys, landed.values(), "gameId", "gameId")
            return {n: rows_per_source(landed[n], keys, "gameId", "gameId") for n in names}

        made = ingest_many(ledger, bronze.root, targets, build)
        counts.update({f"{variant}/{name}": n for name, n in made.items()})
    return counts


def ingest_players(ledger: Ledger, landing: Landed, bronze: Landed, season: str) -> int | None:
    """The player list; made anew on every run."""
    target = _target(bronze.player_list_dataset(season))
    return ingest(ledger, bronze.root, target, landing.player_list_dataset(season).read, skip_done=False)


def ingest_player_details(ledger: Ledger, landing: Landed, bronze: Landed, players: DataFrame) -> int | None:
    """Details of the players in a list; made anew on every run."""

    def build(spark: SparkSession) -> DataFrame:
        details = landing.player_detail_dataset().read(spark)
        require_covered(players.withColumn("source_name", F.lit(PLAYERS)), [details], "PERSON_ID", "PERSON_ID")
        return covered_by(details, players, "PERSON_ID")

    return ingest(ledger, bronze.root, _target(bronze.player_detail_dataset()), build, skip_done=False)


def ingest_rosters(ledger: Ledger, landing: Landed, bronze: Landed, players: DataFrame) -> dict[str, int]:
    """Rosters and coaches of the teams in a player list; made anew on every run."""
    targets = {n: _target(d) for n, d in bronze.roster_datasets().items()}

    def build(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
        teams = distinct_keys(players, "TEAM_ID")
        landed = {n: d.read(spark) for n, d in landing.roster_datasets().items()}
        require_covered(teams.withColumn("source_name", F.lit(TEAMS)), landed.values(), "TEAM_ID", "TEAM_ID")
        return {n: covered_by(landed[n], teams, "TEAM_ID") for n in names}

    return ingest_many(ledger, bronze.root, targets, build, skip_done=False)


def ingest_injury_reports(
    ledger: Ledger, bronze: Landed, year: int, decoded: DecodedReports
) -> int | None:
    """Record the year's raw files, then publish their rows."""
    dataset = bronze.injury_dataset(year)
    target = _target(dataset)
    raw = report_folder(bronze.root, INJURIES, year, "raw")
    try:
        if not ledger.should_ingest(target.s3_key):
            return None
        publish_raw(ledger, raw, f"{INJURIES}/{year}/raw")
        return publish(ledger, target, lambda spark: parse_reports(decoded))
    finally:
        reconcile(ledger, bronze.root)
