"""Data checks: summaries, and failing rows of rules known to fail."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.gallery.base import Registered, flat, table
from rimstone.gallery.derived import BRONZE_SQL, bronze_game_logs
from rimstone.gallery.silver import PROCESSED_AT, SILVER_SQL
from rimstone.operators.checks import (
    duplicate_keys,
    failing_rows,
    groups_breaking,
    holds,
    in_range,
    in_values,
    length_is,
    not_null,
    summarize,
    value_counts_outside,
)
from rimstone.operators.checks import failing_check_rows as all_failing_rows
from rimstone.operators.cleaning import clean
from rimstone.plans import game_logs
from rimstone.plans.silver_build import write_audit_publish
from rimstone.session import materialize, shared_folder
from rimstone.sources.files import read_table


def contract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 77 checks on the silver game logs, written once and then read with only the columns each needs."""
    bronze = bronze_game_logs(spark, sf_dir)
    built = materialize(game_logs.silver(bronze, F.lit(PROCESSED_AT).cast("timestamp")), "silver")
    return game_logs.check_table(built, bronze).drop("column")


# The nine column rules in the other engine's words, as conditions that hold.
COLUMN_RULES = {
    "season_id": "season_id = '2' || split_part(season, '-', 1)",
    "team_abbreviation": "team_abbreviation = left(matchup, 3)",
    "matchup": r"regexp_matches(matchup, '^[A-Z]{3} (vs\.|@) [A-Z]{3}$')",
    "fg_pct": "fg_pct is not distinct from cast(case when fga <> 0 then (2000 * fgm::int + fga) // (2 * fga::int) / 1000.0 end as decimal(4,3))",
    "fg3_pct": "fg3_pct is not distinct from cast(case when fg3a <> 0 then (2000 * fg3m::int + fg3a) // (2 * fg3a::int) / 1000.0 end as decimal(4,3))",
    "ft_pct": "ft_pct is not distinct from cast(case when fta <> 0 then (2000 * ftm::int + fta) // (2 * fta::int) / 1000.0 end as decimal(4,3))",
    "reb": "reb = oreb + dreb",
    "pts": "pts = 2 * fgm + fg3m + ftm",
    "_bronze_path": "_bronze_path like '%/' || season || '/' || _source_name || '%'",
}


def failing_check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every failing row of the 77 checks, once for each check, from the written table."""
    bronze = bronze_game_logs(spark, sf_dir)
    built = materialize(game_logs.silver(bronze, F.lit(PROCESSED_AT).cast("timestamp")), "silver")
    keys = ["check", "kind", "severity", "season_id", "team_id", "game_id"]
    return game_logs.failing_rows_of(built, bronze).select(*keys)


def _row_rules() -> list[tuple[str, str, str, str]]:
    """Name, kind, severity and rule of the checks of one row."""
    lines = [
        ("made_within_tried", "expression_is_true", "error", "fgm <= fga and fg3m <= fg3a and ftm <= fta and fg3m <= fgm and fg3a <= fga"),
        ("played_in_season", "expression_is_true", "error", "year(game_date) - cast(left(season, 4) as int) in (0, 1)"),
        ("result_matches_margin", "expression_is_true", "error", "case when wl = 'W' then plus_minus > 0 when wl = 'L' then plus_minus < 0 else false end"),
        ("values_wl", "accepted_values", "error", "wl = 'W' or wl = 'L'"),
    ]
    for name, _, required, length, accepted, _, _ in game_logs.CONTRACT:
        if required:
            lines.append((f"not_null_{name}", "not_null", "error", f"{name} is not null"))
        if length:
            lines.append((f"length_{name}", "length_equal_to", "error", f"length({name}) = {length}"))
        if accepted:
            low, high = accepted
            lines.append((f"range_{name}", "accepted_range", "warn", f"{name} >= {low} and {name} <= {high}"))
        if name in COLUMN_RULES:
            lines.append((f"rule_{name}", "expression_is_true", "error", COLUMN_RULES[name]))
    return lines


# Keys that are double, rows that are not the latest, and games that are not two rows adding up to nothing.
BROKEN_GROUPS = """
doubles as (select season_sk, team_sk, game_sk from silver group by 1, 2, 3 having count(*) > 1),
tops as (select trim(SEASON_ID, ' ') as s, cast(TEAM_ID as varchar) as t, GAME_ID as g, max(_ingested_at) as top from bronze group by 1, 2, 3),
old as (select silver.* from silver join tops on season_id = s and team_id = t and game_id = g where top <> _ingested_at),
games as (select season_sk, game_sk from silver group by 1, 2 having count(*) <> 2 or sum(plus_minus) <> 0)
"""


def _contract_sql() -> str:
    row_part = " union all ".join(
        f"""select '{n}' as "check", '{kind}' as kind, '{sev}' as severity, count(*) filter (not ({rule})) as failures from silver"""
        for n, kind, sev, rule in _row_rules()
    )
    return f"""with {SILVER_SQL}, {BROKEN_GROUPS}
{row_part}
union all select 'unique_team_game', 'unique_combination_of_columns', 'error', count(*) from doubles
union all select 'not_latest_bronze', 'singular', 'error', count(*) from old
union all select 'not_two_zero_sum_rows', 'singular', 'error', count(*) from games
"""


def _failing_sql() -> str:
    listed = ", ".join(f"case when not ({rule}) then ['{n}', '{kind}', '{sev}'] end" for n, kind, sev, rule in _row_rules())
    return f"""with {SILVER_SQL}, {BROKEN_GROUPS},
lines as (
  select unnest([x for x in [{listed}] if x is not null]) as c, season_id, team_id, game_id from silver
  union all select ['unique_team_game', 'unique_combination_of_columns', 'error'], season_id, team_id, game_id
  from silver semi join doubles using (season_sk, team_sk, game_sk)
  union all select ['not_latest_bronze', 'singular', 'error'], season_id, team_id, game_id from old
  union all select ['not_two_zero_sum_rows', 'singular', 'error'], season_id, team_id, game_id
  from silver semi join games using (season_sk, game_sk)
)
select c[1] as "check", c[2] as kind, c[3] as severity, season_id, team_id, game_id from lines
"""


def silver_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers built as a version, checked, published under a name and read by it; a range check only warns."""
    location = f"{shared_folder(spark)}/gallery-{uuid.uuid4().hex}"
    schema = f"gallery_{uuid.uuid4().hex}"
    spark.sql(f"create database {schema} location '{location}'")
    cleaned = clean(
        table(spark, sf_dir, "customer"), trims=["c_name", "c_mktsegment"], casts={"c_acctbal": "decimal(12,2)"}, keep=["c_custkey"]
    )
    declared = T.StructType([T.StructField(f.name, f.dataType, True, {"comment": f.name}) for f in cleaned.schema])
    checks = [not_null("c_custkey"), in_range("c_acctbal", 0, 9000)]
    write_audit_publish(
        cleaned, "customers", declared, lambda t: summarize(t, checks), lambda t: all_failing_rows(t, checks),
        schema=schema, audit_schema=schema,
    )
    warned = read_table(spark, "customers_failures", schema=schema).select("c_custkey", "check")
    return flat(read_table(spark, "customers", schema=schema).join(warned, "c_custkey", "left"))


SILVER_PUBLISHED = """
select trim(c_name, ' ') as c_name, trim(c_mktsegment, ' ') as c_mktsegment, c_custkey,
  cast(cast(c_acctbal as decimal(12,2)) as double) as c_acctbal,
  case when cast(c_acctbal as decimal(12,2)) not between 0 and 9000 then 'range_c_acctbal' end as "check"
from customer
"""


def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = {
        "part": [
            not_null("p_name"),
            length_is("p_brand", 8),
            in_range("p_size", 5, 45),
            holds("rule_brand", "rlike r'^Brand#[0-9]{2}$'", column="p_brand"),
            holds("size_unless_small", "nullif(p_size, 1) > 10"),
        ],
        "orders": [
            not_null("o_orderdate"),
            in_values("o_orderstatus", ["P", "F"]),
            length_is("o_orderpriority", 5),
            holds("price_by_status", "(o_orderstatus = 'F' and o_totalprice > 100000) or (o_orderstatus <> 'F' and o_totalprice < 400000)"),
        ],
        "customer": [
            in_range("c_acctbal", 0, 9000),
            holds("rule_segment", "<=> nullif(c_mktsegment, 'BUILDING')", column="c_mktsegment"),
        ],
    }
    parts = [
        summarize(table(spark, sf_dir, name), checks).withColumn("table", F.lit(name)) for name, checks in plan.items()
    ]
    return reduce(DataFrame.unionByName, parts).drop("column")


def _summary_sql() -> str:
    lines = [
        ("part", "not_null_p_name", "not_null", "error", "p_name is null"),
        ("part", "length_p_brand", "length_equal_to", "error", "length(p_brand) <> 8"),
        ("part", "range_p_size", "accepted_range", "warn", "p_size < 5 or p_size > 45"),
        ("part", "rule_brand", "expression_is_true", "error", "not regexp_matches(p_brand, '^Brand#[0-9][0-9]$')"),
        ("part", "size_unless_small", "expression_is_true", "error", "p_size <> 1 and p_size <= 10"),
        ("orders", "not_null_o_orderdate", "not_null", "error", "o_orderdate is null"),
        ("orders", "values_o_orderstatus", "accepted_values", "error", "o_orderstatus not in ('P', 'F')"),
        ("orders", "length_o_orderpriority", "length_equal_to", "error", "length(o_orderpriority) <> 5"),
        ("orders", "price_by_status", "expression_is_true", "error", "case when o_orderstatus = 'F' then o_totalprice <= 100000 else o_totalprice >= 400000 end"),
        ("customer", "range_c_acctbal", "accepted_range", "warn", "c_acctbal < 0 or c_acctbal > 9000"),
        ("customer", "rule_segment", "expression_is_true", "error", "c_mktsegment = 'BUILDING'"),
    ]
    return " union all ".join(
        f"""select '{t}' as "table", '{n}' as "check", '{k}' as kind, '{s}' as severity, count(*) filter ({bad}) as failures from {t}"""
        for t, n, k, s, bad in lines
    )


def group_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "row_count": F.count(F.lit(1)),
        "quantity_sum": F.sum(F.col("l_quantity").cast("decimal(12,2)")),
    }
    broken = groups_breaking(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], measures, "row_count = 4 and quantity_sum = 100"
    )
    return flat(broken)


GROUP_RULE = """
select l_orderkey, count(*) as row_count, cast(sum(cast(l_quantity as decimal(12,2))) as double) as quantity_sum
from lineitem group by 1 having count(*) <> 4 or sum(cast(l_quantity as decimal(12,2))) <> 100
"""


def two_row_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = game_logs.silver(bronze_game_logs(spark, sf_dir), F.lit(PROCESSED_AT).cast("timestamp"))
    return game_logs.games_without_two_zero_sum_rows(silver)


TWO_ROW_GAMES = f"""with {SILVER_SQL}
select season_sk, game_sk, count(*) as row_count, cast(sum(plus_minus) as bigint) as plus_minus_sum
from silver group by 1, 2 having count(*) <> 2 or sum(plus_minus) <> 0
"""


def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts_outside(table(spark, sf_dir, "orders"), "o_orderstatus", ["P", "F"])


def _rows(name: str, columns: list[str], check):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(failing_rows(table(spark, sf_dir, name), check).select(*columns))

    return query


def check_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["TEAM_ID", "GAME_ID", "_bronze_path", "FGM", "FGA", "FG_PCT"]
    typed = bronze_game_logs(spark, sf_dir).select(*columns).withColumn("FG_PCT", F.expr("cast(FG_PCT as decimal(4,3))"))
    rule = holds("ratio", "<=> round(FGM / nullif(FGA, 0), 3)", column="FG_PCT")
    return flat(failing_rows(typed, rule)).toDF(*[c.lower() for c in columns])


CHECK_RATIO = """
select TEAM_ID as team_id, GAME_ID as game_id, _bronze_path, FGM as fgm, FGA as fga,
  cast(cast(FG_PCT as decimal(4,3)) as double) as fg_pct
from bronze
where cast(FG_PCT as decimal(4,3)) is distinct from
  cast(case when FGA <> 0 then (2000 * FGM + FGA) // (2 * FGA) / 1000.0 end as decimal(4,3))
"""


def _check_ratio_sql() -> str:
    return f"with {BRONZE_SQL} {CHECK_RATIO}"


def check_like_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    rule = holds("named_by_nation", "like concat('Customer#%', c_nationkey)", column="c_name")
    return failing_rows(customers, rule)


QUERIES: Registered = {
    "contract_checks": (contract_checks, _contract_sql()),
    "silver_published": (silver_published, SILVER_PUBLISHED),
    "failing_check_rows": (failing_check_rows, _failing_sql()),
    "check_summary": (check_summary, _summary_sql()),
    "group_rule": (group_rule, GROUP_RULE),
    "two_row_games": (two_row_games, TWO_ROW_GAMES),
    "dup_keys": (
        dup_keys,
        "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1",
    ),
    "bad_values": (
        bad_values,
        "select o_orderstatus, count(*) as n_records from orders where o_orderstatus not in ('P', 'F') group by 1",
    ),
    "check_range_rows": (
        _rows("part", ["p_partkey", "p_size"], in_range("p_size", 5, 45)),
        "select p_partkey, p_size from part where p_size not between 5 and 45",
    ),
    "check_length_rows": (
        _rows("orders", ["o_orderkey", "o_orderpriority"], length_is("o_orderpriority", 5)),
        "select o_orderkey, o_orderpriority from orders where length(o_orderpriority) <> 5",
    ),
    "check_regex_rows": (
        _rows("part", ["p_partkey", "p_brand"], holds("brand", "rlike r'^Brand#[0-9]{2}$'", column="p_brand")),
        "select p_partkey, p_brand from part where not regexp_matches(p_brand, '^Brand#[0-9]{2}$')",
    ),
    "check_like_rows": (
        check_like_rows,
        "select c_custkey, c_name, c_nationkey from customer where c_name not like 'Customer#%' || c_nationkey",
    ),
    "check_ratio": (check_ratio, _check_ratio_sql()),
    "check_prefix": (
        _rows("part", ["p_partkey", "p_brand", "p_type"], holds("prefix", "= left(p_type, 6)", column="p_type")),
        "select p_partkey, p_brand, p_type from part where length(p_type) > 6",
    ),
    "check_sum": (
        _rows(
            "lineitem",
            ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
            holds("sum", "l_linenumber <= 2 * (l_suppkey % 3) + l_partkey % 5 and l_suppkey < l_partkey"),
        ),
        "select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem "
        "where l_linenumber > 2 * (l_suppkey % 3) + l_partkey % 5 or l_suppkey >= l_partkey",
    ),
    "check_year_window": (
        _rows(
            "orders",
            ["o_orderkey", "o_orderdate"],
            holds(
                "year_window",
                "year(o_orderdate) between cast(split_part('1996-97', '-', 1) as int) "
                "and cast(split_part('1996-97', '-', 1) as int) + 1",
            ),
        ),
        "select o_orderkey, o_orderdate from orders where year(o_orderdate) not in (1996, 1997)",
    ),
}
