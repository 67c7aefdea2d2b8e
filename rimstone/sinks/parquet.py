"""Writers of Parquet datasets and catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.errors import ContractBroken, EmptyDataset
from rimstone.session import filesystem
from rimstone.sinks.naming import qualified


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a dataset with zstd compression, replacing what is there."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_folders(df: DataFrame, column: str, root: str) -> dict[str, int]:
    """Write the rows of each value of `column`, a path below `root`, to that folder, all in one job.

    The rows go to `<column>=<value>` folders of a staging folder, whose names are escaped, and are moved to their places
    afterwards. The column itself is not written. Returns the number of rows of each folder, counted from the footers.
    Folders that are there already are replaced; the column must not be NULL.
    """
    spark = df.sparkSession
    staged = f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    numbered = df.withColumn("_folder", F.col(column))
    numbered.drop(column).write.option("compression", "zstd").partitionBy("_folder").parquet(staged)
    store, staged_path = filesystem(spark, staged)
    try:
        place = F.regexp_extract("_metadata.file_path", "/_folder=([^/]*)/", 1).alias("place")
        counts = {}
        for row in spark.read.parquet(staged).groupBy(place).count().collect():  # one row per folder
            name = unquote(row["place"])  # of the folder on disk; its own escapes are Spark's
            folder = unquote(name)
            _, source = filesystem(spark, f"{staged}/_folder={name}")
            _, final = filesystem(spark, f"{root.rstrip('/')}/{folder}")
            store.mkdirs(final.getParent())
            store.delete(final, True)
            move(store, source, final)
            counts[folder] = row["count"]
    finally:
        store.delete(staged_path, True)
    return counts


def former_path(path: str) -> str:
    """Where the former dataset waits while a new one takes its place."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_former-{name}"


def move(fs, source, to) -> None:
    if not fs.rename(source, to):
        raise OSError(f"cannot move {source} to {to}")


def restore_former(spark: SparkSession, path: str) -> bool:
    """Put the former dataset back where a publish was cut short; tells whether it was."""
    fs, former = filesystem(spark, former_path(path))
    _, final = filesystem(spark, path)
    if not fs.exists(former) or fs.exists(final):
        return False
    move(fs, former, final)
    return True


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """A published dataset, or a glob of several; the former one where the driver stopped before the new one was moved."""
    if "*" not in path:
        fs, final = filesystem(spark, path)
        _, former = filesystem(spark, former_path(path))
        if not fs.exists(final) and fs.exists(former):
            path = former_path(path)
    # A folder whose name begins with an underscore is read only when it is named itself.
    return spark.read.parquet(path)


def take_place(spark: SparkSession, staged: str, path: str) -> None:
    """Move a written dataset to its place; the former one is moved aside before and deleted after.

    A failed move puts the former one back. A move is one step on HDFS and local disks; an object store copies.
    """
    restore_former(spark, path)
    fs, staged_path = filesystem(spark, staged)
    _, former = filesystem(spark, former_path(path))
    _, final = filesystem(spark, path)
    if fs.exists(final):
        fs.delete(former, True)
        move(fs, final, former)
    try:
        fs.mkdirs(final.getParent())
        move(fs, staged_path, final)
    except Exception:
        restore_former(spark, path)
        raise
    fs.delete(former, True)


def publish_parquet(df: DataFrame, path: str) -> int:
    """Write a dataset beside its place, refuse it if it is empty, then move it there; returns the row count.

    The rows are computed once: the count is observed during the write. The former dataset is moved aside and
    deleted last: an empty, failed or unfinished write leaves it as it was, and a failed move puts it back. If the
    driver stops between the two moves, `read_published` and the next publish find it beside its place. A move is
    one step on HDFS and local disks; an object store copies.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    staged = f"{parent}/_staged-{uuid.uuid4().hex}-{name}"
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows_in"))
    fs, staged_path = filesystem(spark, staged)
    try:
        observed.write.option("compression", "zstd").parquet(staged)
        rows_in = seen.get["rows_in"]
        if rows_in == 0:
            raise EmptyDataset(f"no rows for {path}")
        take_place(spark, staged, path)
    finally:
        fs.delete(staged_path, True)
    return rows_in


def require_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """`df` itself, or an error listing where its columns or types differ from the declaration."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in declared]
    if have != want:
        raise ContractBroken(f"missing or different: {[x for x in want if x not in have]}, "
                             f"not declared or out of order: {[x for x in have if x not in want] or have}")
    return df


def with_comments(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Give every column the comment of its declared field."""
    for declared_field in declared:
        df = df.withMetadata(declared_field.name, declared_field.metadata)
    return df


def save_table(
    df: DataFrame,
    table: str,
    declared: T.StructType,
    *,
    schema: str = "silver",
    catalog: str | None = None,
    description: str = "",
    partition_by: Sequence[str] = (),
) -> str:
    """Rebuild a catalog table from a frame that meets its contract, comments included; returns its name.

    A table that is mostly read by season can be laid out so, which lets Spark skip the other seasons.
    """
    spark = df.sparkSession
    name = qualified(table, schema, catalog)
    spark.sql(f"create database if not exists {name.rpartition('.')[0]}")
    writer = with_comments(require_schema(df, declared), declared).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    if description:
        text = description.replace("'", "\\'")
        spark.sql(f"comment on table {name} is '{text}'")
    return name
