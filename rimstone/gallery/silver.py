"""Cleaning, keys, deduplication, lineage and unions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.functions import file_stem, kebab, last_part, path_tail, season_of_year
from rimstone.gallery.base import TABLES, Registered, flat, table
from rimstone.gallery.derived import BRONZE_SQL, bronze_game_logs
from rimstone.operators.checks import not_latest
from rimstone.operators.cleaning import clean, snake_columns, tag_source, with_hash_keys
from rimstone.operators.dedup import latest_per_key
from rimstone.plans import game_logs
from rimstone.session import shared_folder
from rimstone.sinks.parquet import write_folders
from rimstone.sources.drift import read_with_drift
from rimstone.sources.files import dataset_path, scan_prefix, union_by_name, with_source_name

PROCESSED_AT = "2024-01-01 00:00:00"


def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean(
        table(spark, sf_dir, "lineitem"),
        trims=["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"],
        casts={
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "l_quantity": "smallint",
            "l_extendedprice": "decimal(12,2)",
            "l_discount": "decimal(4,3)",
        },
        keep=["l_shipdate"],
    )
    latest = latest_per_key(
        typed,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey"],
        tie=["l_suppkey", "l_extendedprice", "l_quantity", "l_discount"],
    )
    keyed = with_hash_keys(latest, {"order_sk": "l_orderkey", "line_sk": "l_linenumber"})
    return flat(keyed.withColumn("processed_at", F.lit(PROCESSED_AT).cast("timestamp_ntz")))


SILVER_LATEST = """
select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
  trim(l_returnflag, ' ') as l_returnflag, trim(l_linestatus, ' ') as l_linestatus, l_partkey, l_suppkey,
  cast(trunc(l_quantity) as smallint) as l_quantity,
  cast(cast(l_extendedprice as decimal(12,2)) as double) as l_extendedprice,
  cast(cast(l_discount as decimal(4,3)) as double) as l_discount, l_shipdate,
  sha256(cast(l_orderkey as varchar)) as order_sk, sha256(cast(l_linenumber as varchar)) as line_sk,
  timestamp '2024-01-01 00:00:00' as processed_at
from lineitem
qualify row_number() over (
  partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc, l_discount desc
) = 1
"""


def silver_game_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = F.lit(PROCESSED_AT).cast("timestamp")
    return flat(game_logs.silver(bronze_game_logs(spark, sf_dir), processed))


def _silver_sql() -> str:
    casts = {"date": "cast({c} as date)", "smallint": "cast({c} as smallint)", "decimal(4,3)": "cast({c} as decimal(4,3))"}
    typed = []
    for name, dtype, *_ in game_logs.CONTRACT:
        if name in game_logs.TRIMMED:
            typed.append(f"trim(cast({name} as varchar), ' ') as {name}")
        elif name in game_logs.LINEAGE:
            typed.append(name)
        elif dtype in casts:
            typed.append(f"{casts[dtype].format(c=name)} as {name}")
    return f"""{BRONZE_SQL},
typed as (select {', '.join(typed)} from bronze),
silver as (
  select sha256(season_id) as season_sk, sha256(team_id) as team_sk, sha256(game_id) as game_sk, *,
    timestamp '2024-01-01 00:00:00' as _processed_at
  from typed
  qualify row_number() over (
    partition by sha256(season_id), sha256(team_id), sha256(game_id) order by _ingested_at desc, _bronze_path desc
  ) = 1
)"""


SILVER_SQL = _silver_sql()


def _flat_silver_sql() -> str:
    out = []
    for name, dtype, *_ in game_logs.CONTRACT:
        cast = {"date": "varchar", "decimal(4,3)": "double"}.get(dtype)
        out.append(f"cast({name} as {cast}) as {name}" if cast else name)
    return f"with {SILVER_SQL} select {', '.join(out)} from silver"


def clean_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return flat(
        clean(
            padded,
            trims=["c_name", "c_mktsegment"],
            casts={"c_acctbal": "decimal(12,2)", "c_nationkey": "smallint"},
            keep=["c_custkey"],
        )
    )


CLEAN_TYPED = """
select c_name, trim(c_mktsegment, ' ') as c_mktsegment, cast(cast(c_acctbal as decimal(12,2)) as double) as c_acctbal,
  cast(c_nationkey as smallint) as c_nationkey, c_custkey
from (select * replace (trim('  ' || c_name || ' ', ' ') as c_name) from customer)
"""


def hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = clean(table(spark, sf_dir, "orders"), trims=["o_orderkey", "o_custkey"])
    return with_hash_keys(ids, {"order_sk": "o_orderkey", "customer_sk": "o_custkey"})


HASH_KEYS = """
select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
  sha256(cast(o_orderkey as varchar)) as order_sk, sha256(cast(o_custkey as varchar)) as customer_sk
from orders
"""


def source_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    tagged = tag_source(parts, "part-feed")
    return tagged.withColumn("kebab", kebab(F.lit("part"), "p_brand", "p_type", F.lit("Regular Season")))


SOURCE_TAG = """
select p_partkey, p_brand, p_type, 'part-feed' as source_name,
  'part-' || replace(lower(p_brand || '-' || p_type || '-Regular Season'), ' ', '-') as kebab
from part
"""


def snake_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return snake_columns(nations.toDF("NationKey", "Nation Name", "TEAM_ID"))


SNAKE_HEADERS = 'select n_nationkey as nation_key, n_name as nation_name, n_regionkey as t_ea_m__id from nation'


def glob_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = with_source_name(scan_prefix(spark, sf_dir, "part"))
    return named.groupBy("source_name").agg(F.count(F.lit(1)).alias("n_rows"), F.max("p_partkey").alias("last_key"))


GLOB_LINEAGE = "select 'part' as source_name, count(*) as n_rows, max(p_partkey) as last_key from part"


def path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        path_tail("url", 2).alias("key2"),
        path_tail("url", 4).alias("key4"),
        last_part("url").alias("file_name"),
        file_stem("url", ".html").alias("stem"),
    )


PATH_KEYS = """
select page_id, array_to_string(parts[greatest(len(parts) - 1, 1):], '/') as key2,
  array_to_string(parts[greatest(len(parts) - 3, 1):], '/') as key4,
  regexp_extract(url, '[^/]*$') as file_name, replace(regexp_extract(url, '[^/]*$'), '.html', '') as stem
from (select page_id, url, [x for x in string_split(url, '/') if x <> ''] as parts from pages)
"""


def union_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").cast("bigint").alias("id"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").cast("decimal(12,2)").cast("double").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return union_by_name([customers, suppliers])


UNION_DRIFT = """
select c_custkey as id, c_acctbal as balance, c_mktsegment as segment from customer
union all by name
select s_acctbal as balance, s_suppkey as id from supplier
"""


# Types in which the orders of a season land: by the remainder of its year.
DRIFTING = [
    {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"},
    {"o_orderkey": "string", "o_custkey": "int", "o_totalprice": "decimal(12,2)"},
    {"o_orderkey": "bigint", "o_custkey": "string", "o_totalprice": "string"},
]
SOURCE = "orders-feed"


def _landed_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders landed in a folder of each season, in types that differ, and loaded again by the declared ones."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    root = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    for kind, types in enumerate(DRIFTING):
        rows = orders.where(F.col("year") % len(DRIFTING) == kind).withColumns({c: F.col(c).cast(t) for c, t in types.items()})
        if kind:  # a column that other seasons lack
            rows = rows.withColumn("note", F.lit(f"kind {kind}"))
        folder = F.concat(season_of_year(F.col("year")), F.lit(f"/{SOURCE}-{kind}.parquet"))
        write_folders(rows.withColumn("folder", folder).drop("year"), "folder", root)
    return read_with_drift(spark, root, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}, prefix=SOURCE)


def drift_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _landed_by_season(spark, sf_dir)
    return loaded.select("o_orderkey", "o_custkey", "o_totalprice", "note", "season")


_SEASON = "cast(year(o_orderdate) as varchar) || '-' || lpad(cast((year(o_orderdate) + 1) % 100 as varchar), 2, '0')"
DRIFT_LOAD = f"""
select o_orderkey, o_custkey, cast(cast(o_totalprice as decimal(12,2)) as double) as o_totalprice,
  case when year(o_orderdate) % 3 > 0 then 'kind ' || (year(o_orderdate) % 3) end as note, {_SEASON} as season
from orders
"""


def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _landed_by_season(spark, sf_dir)
    inside = path_tail(dataset_path(F.col("_bronze_path")), 2)
    dated = F.count_if(F.col("_ingested_at") > F.lit("2020-01-01").cast("timestamp"))
    return loaded.groupBy("season", "_source_name", inside.alias("dataset")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("o_orderkey").alias("last_key"), dated.alias("n_dated")
    )


BRONZE_LINEAGE = f"""
select season, source as _source_name, season || '/' || source || '.parquet' as dataset, count(*) as n_rows,
  max(o_orderkey) as last_key, count(*) as n_dated
from (select o_orderkey, {_SEASON} as season, '{SOURCE}-' || (year(o_orderdate) % 3) as source from orders)
group by 1, 2, 3
"""


def latest_max_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    text = {c: F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")}
    return not_latest(lines.withColumns(text), lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


LATEST_MAX_JOIN = """
with latest as (select l_orderkey, l_linenumber, max(l_shipdate) as top from lineitem group by 1, 2)
select cast(t.l_orderkey as varchar) as l_orderkey, cast(t.l_linenumber as varchar) as l_linenumber, t.l_partkey,
  t.l_suppkey, t.l_shipdate
from lineitem t join latest l on t.l_orderkey = l.l_orderkey and t.l_linenumber = l.l_linenumber
where l.top <> t.l_shipdate
"""


def season_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(season_of_year(year).alias("season"), "o_custkey")
    return orders.groupBy("season").agg(F.count(F.lit(1)).alias("n_games"), F.max("o_custkey").alias("last_team"))


SEASON_LIST = """
select cast(year(o_orderdate) as varchar) || '-' || lpad(cast((year(o_orderdate) + 1) % 100 as varchar), 2, '0') as season,
  count(*) as n_games, max(o_custkey) as last_team
from orders group by 1
"""


def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = [
        table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("rows_in")).withColumn("dataset", F.lit(name))
        for name in TABLES
    ]
    return union_by_name(counted).select("dataset", "rows_in")


DATASET_COUNTS = " union all ".join(f"select '{name}' as dataset, count(*) as rows_in from {name}" for name in TABLES)

QUERIES: Registered = {
    "silver_game_logs": (silver_game_logs, _flat_silver_sql()),
    "silver_latest": (silver_latest, SILVER_LATEST),
    "clean_typed": (clean_typed, CLEAN_TYPED),
    "hash_keys": (hash_keys, HASH_KEYS),
    "source_tag": (source_tag, SOURCE_TAG),
    "snake_columns": (snake_headers, SNAKE_HEADERS),
    "glob_lineage": (glob_lineage, GLOB_LINEAGE),
    "path_keys": (path_keys, PATH_KEYS),
    "union_drift": (union_drift, UNION_DRIFT),
    "drift_load": (drift_load, DRIFT_LOAD),
    "bronze_lineage": (bronze_lineage, BRONZE_LINEAGE),
    "latest_max_join": (latest_max_join, LATEST_MAX_JOIN),
    "season_list": (season_list, SEASON_LIST),
    "dataset_counts": (dataset_counts, DATASET_COUNTS),
}
