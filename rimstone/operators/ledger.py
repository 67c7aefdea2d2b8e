"""Run ledger as an append-only event table with snapshots; the state of a run is its latest event.

Every event carries the whole state of its run, so an update is one more row. Events are ordered by time,
and at equal time an outcome beats `Pending`. One writer at a time is assumed.

Events go to the tail that follows the newest snapshot. Compaction writes the state of all runs as the next snapshot;
from the moment it is complete, events go to a new tail, and a lookup reads one snapshot and one tail, however old the
ledger is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.operators.dedup import latest_per_key
from rimstone.operators.skew import spread_join
from rimstone.session import filesystem, materialize

# Run states, and the age in minutes after which a pending run is stale.
PENDING = "Pending"
SUCCESS = "Success"
FAILURE = "Failure"
STALE_MINUTES = 10

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("s3_key", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def status_rank(status: Column) -> Column:
    return F.when(status == PENDING, 0).otherwise(1)


def run_state(events: DataFrame) -> DataFrame:
    """Latest event of each run."""
    ranked = events.withColumn("_state", status_rank(F.col("status")))
    return latest_per_key(ranked, ["run_id"], ["event_time", "_state"]).drop("_state")


def stale_runs(state: DataFrame, as_of: datetime | Column, minutes: int = STALE_MINUTES) -> DataFrame:
    """Pending runs that started more than `minutes` before `as_of`."""
    cutoff = F.lit(as_of) - F.expr(f"interval {minutes} minutes")
    return state.where((F.col("status") == PENDING) & (F.col("started_at") < cutoff))


def good_runs(state: DataFrame) -> DataFrame:
    """Runs that count as done: successful, with rows, and ended."""
    return state.where((F.col("status") == SUCCESS) & (F.col("rows_in") > 0) & F.col("ended_at").isNotNull())


def latest_good(state: DataFrame, keys: Sequence[str] = ("s3_key",)) -> DataFrame:
    """The good run that ended last, for every key at once."""
    return latest_per_key(good_runs(state), list(keys), ["ended_at"])


def latest_good_of(state: DataFrame, s3_key: str) -> DataFrame:
    """The good run that ended last for one key; no row when there is none."""
    return good_runs(state).where(F.col("s3_key") == s3_key).orderBy(F.col("ended_at").desc()).limit(1)


def missing(wanted: DataFrame, state: DataFrame, keys: Sequence[str] = ("s3_key",)) -> DataFrame:
    """Wanted datasets that no good run has produced."""
    keys = list(keys)
    return spread_join(wanted, good_runs(state).select(*keys).distinct(), keys, "left_anti")


def route_stale(stale: DataFrame, objects: DataFrame, key: str = "s3_key") -> DataFrame:
    """Stale runs with the status they resolve to: success if their object is stored, else failure."""
    stored = objects.select(key).distinct().withColumn("_stored", F.lit(True))
    outcome = F.when(F.col("_stored"), SUCCESS).otherwise(FAILURE)
    return spread_join(stale, stored, [key], "left").withColumn("outcome", outcome).drop("_stored")


def outcome_counts(routed: DataFrame) -> DataFrame:
    """Number of stale runs per outcome."""
    return routed.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_runs"))


def utc_now() -> datetime:
    return datetime.now(tz=timezone.utc)


@dataclass(frozen=True)
class OpenRun:
    """What the driver remembers of a run it opened."""

    run_id: str
    s3_key: str
    started_at: datetime


class Ledger:
    """The ledger table at `path`; holds no state of its own.

    `path/tail-<n>` holds events, `path/snapshot-<n>` the state of all runs at the end of tail n - 1. The newest complete
    snapshot (Spark's `_SUCCESS` file tells) decides which tail is written and read.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def create(self) -> None:
        """Make an empty ledger unless there is one."""
        self.spark.createDataFrame([], EVENT_SCHEMA).write.mode("ignore").parquet(self._tail(0))

    def _tail(self, number: int) -> str:
        return f"{self.path}/tail-{number:06d}"

    def _snapshot(self, number: int) -> str:
        return f"{self.path}/snapshot-{number:06d}"

    def _parts(self, kind: str) -> list[int]:
        """Numbers of the tails or complete snapshots there are."""
        mark = "/_SUCCESS" if kind == "snapshot" else ""
        store, pattern = filesystem(self.spark, f"{self.path}/{kind}-*{mark}")
        found = store.globStatus(pattern) or []
        names = [f.getPath().getParent().getName() if mark else f.getPath().getName() for f in found]
        return sorted(int(name.rpartition("-")[2]) for name in names)

    def generation(self) -> int:
        """Number of the snapshot in force; 0 before the first."""
        return max(self._parts("snapshot"), default=0)

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(EVENT_SCHEMA).parquet(*paths)

    def events(self) -> DataFrame:
        """All events ever appended."""
        return self._read(*[self._tail(n) for n in self._parts("tail")])

    def recent(self) -> DataFrame:
        """The snapshot in force and the events after it."""
        now = self.generation()
        places = [self._snapshot(now)] if now else []
        if now in self._parts("tail"):
            places.append(self._tail(now))
        return self._read(*places)

    def state(self) -> DataFrame:
        return run_state(self.recent())

    def compact(self) -> int:
        """Write the state of all runs as the next snapshot; returns its number.

        Rows lie by key, so that a lookup of one key reads few of them. A compaction that fails leaves an incomplete
        snapshot that nobody reads and that the next one replaces.
        """
        number = self.generation() + 1
        by_key = self.state().repartitionByRange("s3_key").sortWithinPartitions("s3_key")
        by_key.write.mode("overwrite").option("compression", "zstd").parquet(self._snapshot(number))
        return number

    def compact_if(self, files: int = 200) -> bool:
        """Compact when the tail has come to at least so many files; tells whether it did."""
        store, pattern = filesystem(self.spark, f"{self._tail(self.generation())}/*.parquet")
        if len(store.globStatus(pattern) or []) < files:
            return False
        self.compact()
        return True

    def forget(self, keep: int = 2) -> None:
        """Delete all snapshots but the `keep` newest; events stay."""
        for number in self._parts("snapshot")[: -max(keep, 1)]:
            store, path = filesystem(self.spark, self._snapshot(number))
            store.delete(path, True)

    def append(self, rows: DataFrame) -> None:
        """Append events, in as many tasks as the rows come in."""
        rows.select(*EVENT_SCHEMA.names).write.mode("append").parquet(self._tail(self.generation()))

    def _append_few(self, rows: DataFrame) -> None:
        """Append rows that the driver has made, as one file."""
        self.append(rows.coalesce(1))

    def open_runs(self, s3_keys: Sequence[str], started_at: datetime | None = None) -> list[OpenRun]:
        """Append one pending event per key, all at once."""
        at = started_at or utc_now()
        rows = self.spark.createDataFrame(
            [(k, at) for k in s3_keys], "s3_key string, started_at timestamp"
        ).select(
            F.sha2(F.concat_ws("|", "s3_key", F.unix_micros("started_at")), 256).alias("run_id"),
            "s3_key",
            F.col("started_at").alias("event_time"),
            F.lit(PENDING).alias("status"),
            "started_at",
            F.lit(None).cast("timestamp").alias("ended_at"),
            F.lit(None).cast("long").alias("rows_in"),
            F.lit(None).cast("string").alias("error_message"),
        )
        made = {r["s3_key"]: r["run_id"] for r in rows.select("s3_key", "run_id").collect()}
        self._append_few(rows)
        return [OpenRun(made[k], k, at) for k in s3_keys]

    def close(
        self,
        run: OpenRun,
        status: str,
        *,
        rows_in: int | None = None,
        error: str | None = None,
        ended_at: datetime | None = None,
    ) -> None:
        """Append the outcome of one run."""
        self.close_all([(run, status, rows_in, error)], ended_at)

    def close_all(
        self, outcomes: Sequence[tuple[OpenRun, str, int | None, str | None]], ended_at: datetime | None = None
    ) -> None:
        """Append the outcomes of several runs at once: run, status, rows and error of each."""
        at = ended_at or utc_now()
        made = [(r.run_id, r.s3_key, at, status, r.started_at, at, n, error) for r, status, n, error in outcomes]
        if made:
            self._append_few(self.spark.createDataFrame(made, EVENT_SCHEMA))

    def set_status(self, changes: DataFrame, as_of: datetime | None = None) -> None:
        """Append a status change for each row of `changes(run_id, outcome)`; other fields stay as they were.

        Nothing is written when there is no change.
        """
        if changes.isEmpty():
            return
        self._append_status(self.state().join(changes.select("run_id", "outcome"), "run_id"), as_of or utc_now())

    def _append_status(self, runs: DataFrame, at: datetime) -> None:
        """Append each run's state with `outcome` as its status."""
        self.append(runs.withColumn("status", F.col("outcome")).withColumn("event_time", F.lit(at).cast("timestamp")))

    def missing(self, wanted: DataFrame) -> DataFrame:
        return missing(wanted, self.state())

    def should_ingest(self, s3_key: str) -> bool:
        """Whether no good run has produced the key; for many keys use `missing`."""
        return latest_good_of(self.state(), s3_key).isEmpty()

    def reconcile(
        self, stored: Callable[[DataFrame], DataFrame], as_of: datetime | None = None
    ) -> dict[str, int]:
        """Resolve stale runs by what is stored; returns the number of runs per outcome.

        `stored` is given the stale runs and returns the stored keys among theirs; with no stale run it is
        not called.
        """
        at = as_of or utc_now()
        stale = materialize(stale_runs(self.state(), F.lit(at).cast("timestamp")), "stale-runs")
        counts = {}
        if not stale.isEmpty():
            routed = materialize(route_stale(stale, stored(stale)), "routed-runs")
            counts = {r["outcome"]: r["n_runs"] for r in outcome_counts(routed).collect()}
            self._append_status(routed, at)
        return {SUCCESS: counts.get(SUCCESS, 0), FAILURE: counts.get(FAILURE, 0)}
