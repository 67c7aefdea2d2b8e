"""Run ledger and report calendar, with `events` as ledger and `orders` as the source of years.

A run is a user's day: `view` opens it, `purchase` closes it well with rows, `error` closes it badly.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.errors import EmptyDataset
from rimstone.functions import latest_completed_season, season_table
from rimstone.gallery.base import Registered, table
from rimstone.operators.calendar import missing_slots, report_urls, slot_calendar, slot_text
from rimstone.operators.ledger import Ledger, latest_good, latest_good_of, missing, outcome_counts, route_stale, run_state, stale_runs
from rimstone.plans.publish import publish_targets
from rimstone.session import materialize, shared_folder
from rimstone.sinks.naming import Target
from rimstone.sinks.parquet import write_folders
from rimstone.sources.listing import StoreListing

AS_OF = "2024-01-20 00:00:00"
CALENDAR_AS_OF = datetime(2001, 5, 20, 12)


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with the key and run they belong to."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("users/"), "user_id").alias("s3_key"),
        F.concat_ws("/", F.lit("users"), "user_id", F.to_date("ts").cast("string")).alias("run_id"),
        F.col("ts").alias("event_time"),
        "event_type",
        "value",
    )


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "view", "Pending")
        .when(F.col("event_type") == "purchase", "Success")
        .when(F.col("event_type") == "error", "Failure")
    )
    closed = F.col("status") != "Pending"
    return (
        _runs(spark, sf_dir)
        .withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select(
            "run_id",
            "s3_key",
            "event_time",
            "status",
            F.col("event_time").alias("started_at"),
            F.when(closed, F.col("event_time")).alias("ended_at"),
            F.when(F.col("status") == "Success", F.floor("value")).alias("rows_in"),
        )
    )


LEDGER_SQL = """
runs as (
  select 'users/' || user_id as s3_key, 'users/' || user_id || '/' || strftime(ts, '%Y-%m-%d') as run_id,
    ts as event_time, event_type, value
  from events
),
ledger as (
  select run_id, s3_key, event_time, status, event_time as started_at,
    case when status <> 'Pending' then event_time end as ended_at,
    case when status = 'Success' then cast(floor(value) as bigint) end as rows_in
  from (select *, case event_type when 'view' then 'Pending' when 'purchase' then 'Success' when 'error' then 'Failure' end as status from runs)
  where status is not null
),
state as (
  select * from ledger
  qualify row_number() over (partition by run_id order by event_time desc, case when status = 'Pending' then 0 else 1 end desc) = 1
)"""


def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = run_state(_ledger(spark, sf_dir))
    return state.select("run_id", "s3_key", "event_time", "status", F.coalesce("rows_in", F.lit(-1)).alias("rows_in"))


def ledger_latest_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_good(run_state(_ledger(spark, sf_dir))).select("s3_key", "run_id", "ended_at", "rows_in")


def ledger_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _runs(spark, sf_dir).select("run_id").distinct()
    return missing(wanted, run_state(_ledger(spark, sf_dir)), ["run_id"])


def _stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stale_runs(run_state(_ledger(spark, sf_dir)), F.lit(AS_OF).cast("timestamp_ntz"))


def ledger_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stale(spark, sf_dir).select("run_id", "s3_key", "started_at")


def reconcile_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _runs(spark, sf_dir).where("event_type = 'click'")
    return route_stale(_stale(spark, sf_dir), stored, "run_id").select("run_id", "s3_key", "outcome")


def reconcile_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(reconcile_routes(spark, sf_dir))


STALE_SQL = f"""{LEDGER_SQL},
stale as (select * from state where status = 'Pending' and started_at < timestamp '{AS_OF}' - interval 10 minute),
routes as (
  select run_id, s3_key, case when run_id in (select run_id from runs where event_type = 'click') then 'Success' else 'Failure' end as outcome
  from stale
)"""


def _written_ledger(spark: SparkSession) -> Ledger:
    ledger = Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    ledger.create()
    return ledger


def ledger_after_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a written ledger: early events in a snapshot, later ones in its tail, stale runs resolved."""
    events = _ledger(spark, sf_dir).withColumn("error_message", F.lit(None).cast("string"))
    events = events.withColumns({c: F.col(c).cast("timestamp") for c in ("event_time", "started_at", "ended_at")})
    early = F.col("event_time") < F.lit("2024-01-15").cast("timestamp")
    ledger = _written_ledger(spark)
    ledger.append(events.where(early))
    ledger.compact()
    ledger.append(events.where(~early))
    stale = stale_runs(ledger.state(), F.lit(AS_OF).cast("timestamp"))
    stored = _runs(spark, sf_dir).where("event_type = 'click'")
    ledger.set_status(materialize(route_stale(stale, stored, "run_id"), "routed"), datetime(2025, 1, 1, tzinfo=timezone.utc))
    started = F.col("started_at").cast("timestamp_ntz").alias("started_at")
    return ledger.state().select("run_id", "s3_key", "status", F.coalesce("rows_in", F.lit(-1)).alias("rows_in"), started)


LEDGER_AFTER_UPDATE = """
select run_id, s3_key, coalesce(outcome, status) as status, coalesce(rows_in, -1) as rows_in, started_at
from state left join routes using (run_id, s3_key)
"""


def season_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of the orders of all years published in one job; after the last year two are declared without orders."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    first, last = orders.agg(F.min("year"), F.max("year")).first()
    ledger = _written_ledger(spark)
    root = f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"
    keys = {str(year): f"{year}/orders.parquet" for year in range(first, last + 3)}
    targets = {year: Target("orders", f"{root}/{key}", key) for year, key in keys.items()}
    try:
        publish_targets(ledger, targets, orders, "year")
    except EmptyDataset:
        pass  # the first year without orders; its run and those after it are what is asked for
    outcome = F.coalesce("rows_in", F.lit(-1)).alias("rows_in")
    return ledger.state().select("s3_key", "status", outcome, F.col("ended_at").isNotNull().alias("ended"))


SEASON_OUTCOMES = """
with counted as (select year(o_orderdate) as y, count(*) as n from orders group by 1),
declared as (select unnest(generate_series(min(y), max(y) + 2)) as y from counted),
joined as (select y, n from declared left join counted using (y)),
gap as (select min(y) as y from joined where n is null)
select j.y || '/orders.parquet' as s3_key,
  case when j.y < gap.y then 'Success' when j.y = gap.y then 'Failure' else 'Pending' end as status,
  case when j.y < gap.y then n else -1 end as rows_in, j.y <= gap.y as ended
from joined j, gap
"""


def ledger_top_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_good_of(run_state(_ledger(spark, sf_dir)), "users/7").select("s3_key", "run_id", "ended_at", "rows_in")


def stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders of the wanted years are stored: the years of finished orders are, two are never."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_orderstatus")
    years = orders.select("year").distinct()
    wanted = years.union(years.select(F.col("year") + 2)).distinct()
    wanted = wanted.select(F.concat(F.col("year"), F.lit("/orders.parquet")).alias("s3_key"))
    root = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    placed = orders.where("o_orderstatus = 'F'").withColumn("folder", F.concat(F.col("year"), F.lit("/orders.parquet")))
    write_folders(placed.drop("year"), "folder", root)
    stored = StoreListing(spark, root, f"{root}-listing").stored_among(wanted).withColumn("stored", F.lit(True))
    marked = wanted.join(stored, "s3_key", "left")
    return marked.select("s3_key", F.coalesce("stored", F.lit(False)).alias("stored"))


STORED_KEYS = """
with years as (select distinct year(o_orderdate) as y from orders),
wanted as (select y from years union select y + 2 from years)
select y || '/orders.parquet' as s3_key,
  y in (select year(o_orderdate) from orders where o_orderstatus = 'F') as stored
from wanted
"""


def seasons_played(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every season between the first order and two years past the last, with its orders, and the last completed one."""
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("start_year"), "o_orderdate")
    first, last, newest = orders.agg(F.min("start_year"), F.max("start_year"), F.max("o_orderdate")).first()
    played = orders.groupBy("start_year").agg(F.count(F.lit(1)).alias("n_games"))
    seasons = season_table(spark, first, last + 3).join(played, "start_year", "left")
    completed = F.col("season") == latest_completed_season(F.lit(newest))
    return seasons.select("season", "start_year", F.coalesce("n_games", F.lit(0)).alias("n_games"), completed.alias("completed_last"))


SEASONS_PLAYED = """
with counted as (select year(o_orderdate) as y, count(*) as n from orders group by 1),
listed as (select unnest(generate_series(min(y), max(y) + 2)) as y, max(y) as top from counted)
select cast(listed.y as varchar) || '-' || lpad(cast((listed.y + 1) % 100 as varchar), 2, '0') as season,
  cast(listed.y as integer) as start_year, coalesce(n, 0) as n_games, listed.y = top - 1 as completed_last
from listed left join counted on counted.y = listed.y
"""


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    calendar = report_urls(slot_calendar(years, CALENDAR_AS_OF, quarter_from=1999))
    return calendar.withColumn("year", F.col("year").cast("bigint"))


SLOT_CALENDAR = """
with years as (select distinct year(o_orderdate) as year from orders),
ticks as (
  select year, unnest(generate_series(make_timestamp(year, 1, 1, 0, 0, 0.0), make_timestamp(year, 12, 31, 0, 0, 0.0),
    case when year >= 1999 then interval 15 minute else interval 1 hour end)) as slot_time
  from years
),
named as (
  select year, slot_time,
    case when year >= 1999 then strftime(slot_time, '%Y-%m-%d_%I_%M%p') else strftime(slot_time, '%Y-%m-%d_%I%p') end as slot
  from ticks where month(slot_time) not in (7, 8, 9) and slot_time <= timestamp '2001-05-20 12:00:00'
)
select *, 'Injury-Report_' || slot || '.pdf' as file_name,
  'https://ak-static.cms.nba.com/referee/injury/Injury-Report_' || slot || '.pdf' as url
from named
"""


def slot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    years = events.select(F.year("ts").alias("year")).distinct()
    calendar = slot_calendar(years, datetime(2024, 1, 31), quarter_from=2024)
    into_quarter = F.make_dt_interval(mins=F.minute("ts") % 15, secs=F.expr("extract(second from ts)"))
    text = slot_text(F.col("ts") - into_quarter, F.lit(True))
    present = events.where("event_type = 'error'").select(text.alias("slot"))
    return missing_slots(calendar, present, "slot").select("slot", "slot_time")


SLOT_COVERAGE = """
with ticks as (
  select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval 15 minute)) as slot_time
),
present as (select distinct time_bucket(interval 15 minute, ts) as slot_time from events where event_type = 'error')
select strftime(slot_time, '%Y-%m-%d_%I_%M%p') as slot, slot_time from ticks anti join present using (slot_time)
"""

QUERIES: Registered = {
    "ledger_state": (
        ledger_state,
        f"with {LEDGER_SQL} select run_id, s3_key, event_time, status, coalesce(rows_in, -1) as rows_in from state",
    ),
    "ledger_latest_good": (
        ledger_latest_good,
        f"""with {LEDGER_SQL} select s3_key, run_id, ended_at, rows_in from state
        where status = 'Success' and rows_in > 0 and ended_at is not null
        qualify row_number() over (partition by s3_key order by ended_at desc) = 1""",
    ),
    "ledger_missing": (
        ledger_missing,
        f"""with {LEDGER_SQL} select distinct run_id from runs
        where run_id not in (select run_id from state where status = 'Success' and rows_in > 0 and ended_at is not null)""",
    ),
    "ledger_stale": (ledger_stale, f"with {STALE_SQL} select run_id, s3_key, started_at from stale"),
    "reconcile_routes": (reconcile_routes, f"with {STALE_SQL} select * from routes"),
    "reconcile_outcomes": (
        reconcile_outcomes,
        f"with {STALE_SQL} select outcome, count(*) as n_runs from routes group by 1",
    ),
    "ledger_after_update": (ledger_after_update, f"with {STALE_SQL} {LEDGER_AFTER_UPDATE}"),
    "season_outcomes": (season_outcomes, SEASON_OUTCOMES),
    "ledger_top_run": (
        ledger_top_run,
        f"""with {LEDGER_SQL} select s3_key, run_id, ended_at, rows_in from state
        where s3_key = 'users/7' and status = 'Success' and rows_in > 0 and ended_at is not null
        order by ended_at desc limit 1""",
    ),
    "stored_keys": (stored_keys, STORED_KEYS),
    "seasons_played": (seasons_played, SEASONS_PLAYED),
    "slot_calendar": (slots, SLOT_CALENDAR),
    "slot_coverage": (slot_coverage, SLOT_COVERAGE),
}
