"""Table access and output shape shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]
# Query function and its SQL; None where SQL cannot state it.
Registered = dict[str, tuple[Query, str | None]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_up(df: DataFrame, key: str, most_rows: int | None = None) -> DataFrame:
    """`df` with at least one partition per core, for a table that lies in fewer file splits than that.

    With `most_rows` also with one partition for each so many rows (counted from the footers of its files), for jobs
    that make many or wide rows of each and sort them within the partition.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if most_rows is not None:
        wanted = max(wanted, -(-df.count() // most_rows))
    return df.repartition(wanted, key) if df.rdd.getNumPartitions() < wanted else df


def flat(df: DataFrame) -> DataFrame:
    """Columns in types that compare the same in any engine: no decimals, dates or zoned timestamps."""
    plain = {"decimal": "double", "date": "string", "timestamp": "timestamp_ntz"}
    changed = {}
    for name, dtype in df.dtypes:
        cast_to = plain.get("decimal" if dtype.startswith("decimal") else dtype)
        if cast_to:
            changed[name] = F.col(f"`{name}`").cast(cast_to)
    return df.withColumns(changed) if changed else df
