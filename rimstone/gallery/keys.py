"""Key lists, key-driven reads and per-key functions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.gallery.base import Registered, table
from rimstone.operators.asof import asof_join
from rimstone.operators.intervals import interval_join
from rimstone.operators.keyed import (
    failed_keys,
    apply_per_key,
    budget_report,
    covered_by,
    key_counts,
    keys_by_source,
    outcomes_of,
    results_of,
    uncovered_by,
)
from rimstone.session import materialize


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumnRenamed("event_type", "source_name")


def distinct_ids_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys_by_source(_events(spark, sf_dir), "user_id")


def ids_per_source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_counts(distinct_ids_by_source(spark, sf_dir))


IDS_PER_SOURCE_COUNT = """
with counted as (select event_type as source_name, count(distinct user_id) as n_keys from events group by 1)
select * from counted union all select '(all)', cast(sum(n_keys) as bigint) from counted
"""


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return covered_by(lines, finished, "o_orderkey")


KEY_LOOKUP = """
select l_orderkey as o_orderkey, l_linenumber, l_partkey, l_suppkey
from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')
"""


def key_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return uncovered_by(orders, lines, "o_orderkey")


KEY_UNCOVERED = """
select o_orderkey, o_custkey from orders o
where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey)
"""

_PAYLOAD = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.LongType())])


def _parse_even(request: str) -> list[dict]:
    """Rows of one request `<id>#<json>`; an odd number counts as a failure."""
    event_id, _, text = request.partition("#")
    k = json.loads(text)["k"]
    if k % 2:
        raise ValueError(f"odd k {k}")
    return [{"event_id": int(event_id), "k": k}]


def _applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _events(spark, sf_dir).withColumn("request", F.concat_ws("#", "event_id", "props"))
    return apply_per_key(requests, "request", _parse_even, _PAYLOAD)


def error_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    applied = materialize(_applied(spark, sf_dir), "per-key")
    report = budget_report(outcomes_of(applied), "request")
    return report.withColumn("failed_keys", F.concat_ws(" ", "failed_keys"))


ERROR_BUDGET = """
with outcome as (
  select event_type as source_name, event_id || '#' || props as request,
    cast(json_extract(props, '$.k') as bigint) % 2 as failed
  from events
)
select source_name, count(*) filter (failed = 0) as n_done, count(*) filter (failed = 1) as n_failed,
  array_to_string((list(request order by request) filter (failed = 1))[1:11], ' ') as failed_keys,
  case when count(*) filter (failed = 1) > 10 then 'aborted' when count(*) filter (failed = 0) = 0 then 'empty' else 'passed' end as verdict
from outcome group by 1
"""


def budget_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_keys(outcomes_of(_applied(spark, sf_dir)))


BUDGET_FAILURES = """
select event_type as source_name, event_id || '#' || props as request,
  'ValueError: odd k ' || cast(json_extract(props, '$.k') as bigint) as error
from events where cast(json_extract(props, '$.k') as bigint) % 2 = 1
"""


def per_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results_of(materialize(_applied(spark, sf_dir), "per-key"))


PER_KEY_ROWS = """
select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
where cast(json_extract(props, '$.k') as bigint) % 2 = 0
"""

def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a time among those of the events: user, time placed, hours open."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(o_orderkey * 7 % 30 as int), 0, cast(o_orderkey * 11 % 1440 as int), 0)"
        ).alias("placed_at"),
        "o_orderkey",
    )


_PLACED_SQL = """
placed as (
  select o_custkey as user_id, timestamp '2024-01-01' + to_days(cast(o_orderkey * 7 % 30 as int))
    + to_minutes(o_orderkey * 11 % 1440) as placed_at, o_orderkey
  from orders
)"""


def event_asof_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    return asof_join(events, _placed(spark, sf_dir), ["user_id"], "ts", "placed_at")


EVENT_ASOF_ORDER = f"""with {_PLACED_SQL},
matched as (
  select event_id, placed_at, o_orderkey from events e join placed p on p.user_id = e.user_id and p.placed_at <= e.ts
  qualify row_number() over (partition by event_id order by placed_at desc, o_orderkey desc) = 1
)
select event_id, user_id, ts, placed_at, o_orderkey from events left join matched using (event_id)
"""


def event_in_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    hours = F.make_dt_interval(hours=F.when(F.col("o_orderkey") % 50 == 0, 700).otherwise(F.col("o_orderkey") % 36).cast("int"))
    opened = _placed(spark, sf_dir).withColumn("closed_at", F.col("placed_at") + hours)
    return interval_join(events, opened, ["user_id"], "ts", "placed_at", "closed_at")


EVENT_IN_INTERVAL = f"""with {_PLACED_SQL},
opened as (
  select *, placed_at + to_hours(case when o_orderkey % 50 = 0 then 700 else o_orderkey % 36 end) as closed_at from placed
)
select event_id, e.user_id, ts, placed_at, o_orderkey, closed_at
from events e join opened o on o.user_id = e.user_id and ts between placed_at and closed_at
"""

QUERIES: Registered = {
    "event_asof_order": (event_asof_order, EVENT_ASOF_ORDER),
    "event_in_interval": (event_in_interval, EVENT_IN_INTERVAL),
    "distinct_ids_by_source": (
        distinct_ids_by_source,
        "select distinct event_type as source_name, user_id from events",
    ),
    "ids_per_source_count": (ids_per_source_count, IDS_PER_SOURCE_COUNT),
    "key_lookup": (key_lookup, KEY_LOOKUP),
    "key_uncovered": (key_uncovered, KEY_UNCOVERED),
    "error_budget": (error_budget, ERROR_BUDGET),
    "budget_failures": (budget_failures, BUDGET_FAILURES),
    "per_key_rows": (per_key_rows, PER_KEY_ROWS),
}
