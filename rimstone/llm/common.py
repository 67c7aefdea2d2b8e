"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone import session

# Functions of this subpackage travel to executors by value, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read again; the shuffle files it took are then free to be removed.

    Spark removes the shuffle files of a plan once the driver's collector has met the plan.
    """
    written = session.materialize(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    return written


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """Only `doc_id` and `text` (null read as empty), with `text_hash` telling rows of one id apart.

    Rows that agree in both are the same document: each of them gets that document's result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))


def same_doc(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about `most` bytes of one column; a longer text is a slice of its own."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        start = 0
        size = 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(at)).to_pylist()):
            if i > start and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def running_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds this partition's number and, for each row, the rows and bytes before it in the partition."""
    part, rows, size = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index("__size")).to_pylist()
        before = list(accumulate(sizes, initial=size))
        columns = [pa.array([part] * len(sizes), pa.int32()), pa.array(range(rows, rows + len(sizes)), pa.int64())]
        columns.append(pa.array(before[:-1], pa.int64()))
        rows, size = rows + len(sizes), before[-1]
        named = dict(zip(batch.schema.names, batch.columns, strict=True))
        named |= dict(zip(("__part", "__row", "__before"), columns, strict=True))
        yield pa.RecordBatch.from_pydict(named)


def global_positions(df: DataFrame, order_by: list[str], size: Column | None = None) -> tuple[DataFrame, int, int]:
    """`df` in a global order with `__row` and `__before` (rows and summed sizes before each row), and both totals.

    One range shuffle and one written table. Each partition sums its own rows; only one total per partition
    (their number is the shuffle setting, not the data's) comes to the driver, which sums those.
    """
    sized = df.withColumn("__size", (F.lit(1) if size is None else size).cast("long"))
    order = [F.col(c).asc_nulls_first() for c in order_by]
    ordered = sized.repartitionByRange(shuffles(df.sparkSession), *order).sortWithinPartitions(*order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema.fields)
    fields += ", __part int, __row long, __before long"
    placed = materialize(ordered.mapInArrow(running_sums, fields), "positions")
    totals = placed.groupBy("__part").agg(F.count("*").alias("n"), F.sum("__size").alias("b")).orderBy("__part").collect()
    rows_before = list(accumulate((t["n"] for t in totals), initial=0))
    bytes_before = list(accumulate((t["b"] for t in totals), initial=0))
    offsets = df.sparkSession.createDataFrame(
        [(t["__part"], r, b) for t, r, b in zip(totals, rows_before, bytes_before, strict=False)],
        "__part int, __rows_before long, __bytes_before long",
    )
    joined = placed.join(F.broadcast(offsets), "__part")
    moved = joined.withColumns(
        {"__row": F.col("__row") + F.col("__rows_before"), "__before": F.col("__before") + F.col("__bytes_before")}
    )
    return moved.drop("__part", "__rows_before", "__bytes_before"), rows_before[-1], bytes_before[-1]


def per_slice(function: Callable, column: str = "text", most: int = SLICE_BYTES) -> Callable:
    """Turns a function of one record batch into one over an iterator, fed in slices of bounded size."""

    def run(batches):
        for part in slices(batches, column, most):
            yield from function(part)

    return run
