"""Key lists of one dataset driving the read of another, and per-key functions with a failure budget."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rimstone.errors import BudgetExceeded, EmptyDataset
from rimstone.operators.cleaning import require_columns
from rimstone.operators.skew import spread_join

# Fixed value: failures one source may have; the next one aborts it.
FAILURE_BUDGET = 10
ALL_SOURCES = "(all)"
NO_KEYS = "the key list is empty: no source names a game"

# Lines a per-key function gathers before they are handed to Spark.
LINES_PER_BATCH = 10_000

# What a per-key function returns for one dataset.
Records = Iterable[Mapping[str, object]]


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one column."""
    return require_columns(df, [key]).select(key).distinct()


def keys_by_source(df: DataFrame, key: str, source: str = "source_name") -> DataFrame:
    """Distinct keys of each source; a key found in two sources is kept twice."""
    return require_columns(df, [source, key]).select(source, key).distinct()


def key_counts(keys: DataFrame, source: str = "source_name") -> DataFrame:
    """Number of keys per source, and their sum in a line named `(all)`."""
    per_source = keys.groupBy(source).agg(F.count(F.lit(1)).alias("n_keys"))
    total = per_source.agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n_keys"))
    return per_source.select(F.col(source).cast("string").alias(source), "n_keys").unionByName(
        total.withColumn(source, F.lit(ALL_SOURCES))
    )


def require_keys(keys: DataFrame) -> DataFrame:
    """`keys` itself, or an error when no source has any."""
    if keys.isEmpty():
        raise EmptyDataset(NO_KEYS)
    return keys


def covered_by(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the key list."""
    return spread_join(rows, distinct_keys(keys, key), [key], "left_semi")


def uncovered_by(keys: DataFrame, rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys for which no row has landed."""
    on = [key] if isinstance(key, str) else list(key)
    return spread_join(keys, rows.select(*on).distinct(), on, "left_anti")


def apply_per_key(
    keys: DataFrame,
    key: str,
    function: Callable[[object], Records | Mapping[str, Records]],
    payload: Mapping[str, T.StructType] | T.StructType,
    source: str = "source_name",
    partitions: int | None = None,
) -> DataFrame:
    """Run a user function once per row of `keys(source, key)` and keep what it raised instead of stopping.

    The function maps a key to the records of one dataset, or to several named lists of records; `payload`
    gives their schemas in the same shape. Each key yields one line with `dataset` NULL that carries its `error` (NULL when it went
    well), and one line per returned row with the row in the struct column named after its dataset. Read it
    twice only from a written table, or the function runs twice.

    Keys are shared out over `partitions` tasks (by default the number of shuffle partitions): a key list is short,
    its calls are long. The function and its module travel to the executors by value, so they need not be installed
    there. Records are handed on while the function runs, at most `LINES_PER_BATCH` at a time, so a function that yields
    them never holds them all. If it fails midway, the lines it had made are there already: `results_of` withdraws them.
    """
    if function.__module__ in sys.modules and function.__module__ != "__main__":
        cloudpickle.register_pickle_by_value(sys.modules[function.__module__])
    n_tasks = partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shapes = {"rows": payload} if isinstance(payload, T.StructType) else dict(payload)
    schema = T.StructType(
        [
            keys.schema[source],
            keys.schema[key],
            T.StructField("dataset", T.StringType()),
            T.StructField("error", T.StringType()),
            *[T.StructField(name, shape) for name, shape in shapes.items()],
        ]
    )

    def lines_of(source_name: object, value: object) -> Iterator[dict]:
        error = None
        try:
            made = function(value)
            for name, records in (made if isinstance(made, Mapping) else {"rows": made}).items():
                for record in records:
                    yield {source: source_name, key: value, "dataset": name, name: dict(record)}
        except Exception as exc:  # what the user's function raises is data here
            error = f"{type(exc).__name__}: {exc}"
        yield {source: source_name, key: value, "error": error}

    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch[source].to_pylist(), batch[key].to_pylist(), strict=True)
            lines = (line for s, k in pairs for line in lines_of(s, k))
            while waiting := list(islice(lines, LINES_PER_BATCH)):
                yield pa.RecordBatch.from_pylist(waiting, schema=arrow_schema)

    return keys.select(source, key).repartition(n_tasks, source, key).mapInArrow(run, schema)


def results_of(applied: DataFrame, dataset: str = "rows") -> DataFrame:
    """Rows of one dataset returned by the per-key function; those of keys on which it failed are withdrawn.

    `applied` is read twice: give a written table, or the function runs twice.
    """
    source, key = applied.columns[:2]
    failed = failed_keys(outcomes_of(applied)).select(F.col(source).alias("_source"), F.col(key).alias("_key"))
    made = applied.where(F.col("dataset") == dataset)
    same = made[source].eqNullSafe(F.col("_source")) & made[key].eqNullSafe(F.col("_key"))
    return made.join(failed, same, "left_anti").select(f"{dataset}.*")


def outcomes_of(applied: DataFrame) -> DataFrame:
    """One line per key: its source, the key and the error or NULL."""
    return applied.where(F.col("dataset").isNull()).drop("dataset").select(*applied.columns[:2], "error")


def failed_keys(outcomes: DataFrame) -> DataFrame:
    """Every failed key with its source and error."""
    return outcomes.where(F.col("error").isNotNull())


def budget_report(
    outcomes: DataFrame, key: str, source: str = "source_name", budget: int = FAILURE_BUDGET
) -> DataFrame:
    """Keys done and failed per source, the first failed keys up to one past the budget, and the verdict.

    All failed keys are in `failed_keys`; those here are for messages.

    `aborted`: more than `budget` keys failed. `empty`: none succeeded. `passed`: the rest.
    """
    failed = F.col("error").isNotNull()
    counts = outcomes.groupBy(source).agg(
        F.count_if(~failed).alias("n_done"), F.count_if(failed).alias("n_failed")
    )
    first = Window.partitionBy(source).orderBy(key)
    listed = (
        outcomes.where(failed)
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= budget + 1)
        .groupBy(source)
        .agg(F.array_sort(F.collect_list(key)).alias("failed_keys"))
    )
    verdict = (
        F.when(F.col("n_failed") > budget, "aborted").when(F.col("n_done") == 0, "empty").otherwise("passed")
    )
    return counts.join(listed, source, "left").withColumn("verdict", verdict)


def enforce_budget(report: DataFrame, source: str = "source_name") -> None:
    """Raise for sources whose verdict is not `passed`: by a count over all of them, naming a few in the message."""
    bad = report.where("verdict <> 'passed'")
    n_bad, n_aborted = bad.agg(F.count("*"), F.count_if(F.col("verdict") == "aborted")).first()
    if not n_bad:
        return
    named = bad.orderBy("verdict", source).limit(20).collect()
    text = "; ".join(f"{r[source]}: {r['n_failed']} failed {r['failed_keys']}" for r in named)
    text += f" ({n_bad} sources, {n_aborted} of them aborted)"
    if n_aborted:
        raise BudgetExceeded(text)
    raise EmptyDataset(f"no key succeeded for {text}")
