"""Two-phase publishing: a pending run first, then the data, then the outcome."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.errors import EmptyDataset
from rimstone.operators.ledger import FAILURE, SUCCESS, Ledger, OpenRun
from rimstone.sinks.naming import Target
from rimstone.session import filesystem
from rimstone.sinks.parquet import publish_parquet, take_place, write_folders
from rimstone.sources.files import list_files, stored_among
from rimstone.sources.listing import StoreListing

Build = Callable[[SparkSession], DataFrame]
BuildMany = Callable[[SparkSession], Mapping[str, DataFrame]]


def _write(ledger: Ledger, run: OpenRun, target: Target, rows: Callable[[], DataFrame]) -> int:
    """Second phase of one dataset: its rows and a success, or a failure and the error."""
    try:
        rows_in = publish_parquet(rows(), target.path)
    except Exception as exc:
        ledger.close(run, FAILURE, error=str(exc))
        raise
    ledger.close(run, SUCCESS, rows_in=rows_in)
    return rows_in


def publish(ledger: Ledger, target: Target, build: Build) -> int:
    """Publish one dataset; returns its row count."""
    (run,) = ledger.open_runs([target.s3_key])
    return _write(ledger, run, target, lambda: build(ledger.spark))


def publish_many(ledger: Ledger, targets: Mapping[str, Target], build: BuildMany) -> dict[str, int]:
    """Publish several datasets made by one computation, in the given order.

    If the computation cannot be set up, every run fails. If one dataset fails, its run fails and the runs
    of the datasets after it stay pending until they are reconciled. Whoever builds the frames writes their
    common part to a table once (see `materialize`) so that it is not computed for each dataset.
    """
    runs = ledger.open_runs([t.s3_key for t in targets.values()])
    try:
        frames = build(ledger.spark)
    except Exception as exc:
        for run in runs:
            ledger.close(run, FAILURE, error=str(exc))
        raise
    counts = {}
    for run, (dataset, target) in zip(runs, targets.items(), strict=True):
        counts[dataset] = _write(ledger, run, target, lambda name=dataset: frames[name])
    return counts


def publish_targets(ledger: Ledger, targets: Mapping[str, Target], rows: DataFrame, column: str) -> dict[str, int]:
    """Publish the rows of many targets, told apart by the names in `column`, with one write for all of them.

    One pending run per target is opened first. Then all rows are computed and written beside their places in one job,
    with their number per target; if that fails, every run fails. Then the targets take their places in the declared
    order, which moves folders only. A target without rows, or one whose move fails, fails its run, and the runs of the
    targets after it stay pending until they are reconciled. All outcomes are appended together.
    """
    if not targets:
        return {}
    spark = ledger.spark
    runs = dict(zip(targets, ledger.open_runs([t.s3_key for t in targets.values()]), strict=True))
    # Beside the first target, so that moves stay within one store.
    first = next(iter(targets.values())).path
    staged = f"{first.rstrip('/').rpartition('/')[0]}/_staged-{uuid.uuid4().hex}"
    store, staged_path = filesystem(spark, staged)
    # Folders have the targets' numbers, whatever their names; rows of no target are left out.
    names = spark.createDataFrame([(n, str(i)) for i, n in enumerate(targets)], "_name string, _place string")
    placed = rows.join(F.broadcast(names), F.col(column).cast("string") == F.col("_name")).drop("_name", column)  # one row each
    outcomes = []
    counts: dict[str, int] = {}
    try:
        try:
            made = write_folders(placed, "_place", staged)
        except Exception as exc:
            outcomes = [(run, FAILURE, None, str(exc)) for run in runs.values()]
            raise
        for i, (name, target) in enumerate(targets.items()):
            try:
                if str(i) not in made:
                    raise EmptyDataset(f"no rows for {target.path}")
                take_place(spark, f"{staged}/{i}", target.path)
            except Exception as exc:
                outcomes.append((runs[name], FAILURE, None, str(exc)))
                raise
            counts[name] = made[str(i)]
            outcomes.append((runs[name], SUCCESS, made[str(i)], None))
    finally:
        ledger.close_all(outcomes)
        store.delete(staged_path, True)
    return counts


def publish_raw(ledger: Ledger, folder: str, s3_key: str, land: Callable[[], None] | None = None) -> DataFrame:
    """Record that raw files have landed in a folder; returns their listing. No row count is kept.

    `land` stands for whatever puts the files there.
    """
    (run,) = ledger.open_runs([s3_key])
    try:
        if land is not None:
            land()
        files = list_files(ledger.spark, folder)
    except Exception as exc:
        ledger.close(run, FAILURE, error=str(exc))
        raise
    ledger.close(run, SUCCESS)
    return files


def reconcile(ledger: Ledger, root: str, listing: StoreListing | None = None) -> dict[str, int]:
    """Resolve stale runs by what is stored below the lake's root; with a kept listing only changed folders are listed."""
    return ledger.reconcile(listing.stored_among if listing else lambda stale: stored_among(stale, root))


def ingest(ledger: Ledger, root: str, target: Target, build: Build, *, skip_done: bool = True) -> int | None:
    """Publish one dataset unless a good run has produced it, and always reconcile afterwards."""
    try:
        if skip_done and not ledger.should_ingest(target.s3_key):
            return None
        return publish(ledger, target, build)
    finally:
        reconcile(ledger, root)


def ingest_many(
    ledger: Ledger,
    root: str,
    targets: Mapping[str, Target],
    build: Callable[[SparkSession, Sequence[str]], Mapping[str, DataFrame]],
    *,
    skip_done: bool = True,
) -> dict[str, int]:
    """Publish the datasets that no good run has produced; nothing is computed when all are done.

    `build` gets the names still to be made, so no finished dataset is computed again.
    """
    try:
        left = dict(targets)
        if skip_done:
            wanted = ledger.spark.createDataFrame([(n, t.s3_key) for n, t in targets.items()], "name string, s3_key string")
            names = {r["name"] for r in ledger.missing(wanted).select("name").collect()}
            left = {n: t for n, t in targets.items() if n in names}
        if not left:
            return {}
        return publish_many(ledger, left, lambda spark: build(spark, list(left)))
    finally:
        reconcile(ledger, root)


def ingest_targets(
    ledger: Ledger,
    root: str,
    targets: Mapping[str, Target],
    build: Callable[[SparkSession, Sequence[str]], DataFrame],
    column: str,
    *,
    skip_done: bool = True,
) -> dict[str, int]:
    """Publish those of many targets, such as the seasons of a dataset, that no good run has produced, in one job.

    `build` gets the names still to be made and returns the rows of all of them, told apart by `column`. Stale runs are
    reconciled whatever happened.
    """
    try:
        left = dict(targets)
        if skip_done:
            wanted = ledger.spark.createDataFrame([(n, t.s3_key) for n, t in targets.items()], "name string, s3_key string")
            names = {r["name"] for r in ledger.missing(wanted).select("name").collect()}
            left = {n: t for n, t in targets.items() if n in names}
        if not left:
            return {}
        return publish_targets(ledger, left, build(ledger.spark, list(left)), column)
    finally:
        reconcile(ledger, root)


def for_each_season(step: Callable[[str], object], seasons: DataFrame) -> list[object]:
    """Run one publish per season of a season table, in order; the first error stops the rest.

    Only the publishing is looped; a build that spans seasons should be one job partitioned by season.
    """
    return [step(row["season"]) for row in seasons.orderBy("start_year").collect()]


def for_each_year(step: Callable[..., object], years: Mapping[int, Mapping[str, object]]) -> list[object]:
    """Run one publish per year with its own options; the first error stops the rest."""
    return [step(year, **options) for year, options in years.items()]
