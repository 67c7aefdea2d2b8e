"""Tables that are replaced by one switch of their name.

A build is written as a table of its own, `<name>__v<number>`; the public name is a view of one of them. A version that has
been checked takes over by one statement that replaces the view, so readers see the former version or the new one, whole.
The former versions stay until they expire, and a switch can be taken back.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.errors import EmptyDataset, LakeError
from rimstone.sinks.naming import qualified
from rimstone.sinks.parquet import require_schema, with_comments

MARK = "__v"
VERSION_PROPERTY = "rimstone.version"


@dataclass(frozen=True)
class Version:
    """One written build of a table."""

    name: str  # the public name
    number: str
    rows: int

    @property
    def table(self) -> str:
        return f"{self.name}{MARK}{self.number}"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stage(
    df: DataFrame,
    table: str,
    declared: T.StructType,
    *,
    schema: str = "silver",
    catalog: str | None = None,
    partition_by: Sequence[str] = (),
) -> Version:
    """Write a build that meets its contract beside the published version; an empty one is refused.

    Rows are computed and counted once. A write that fails leaves nothing that readers see.
    """
    spark = df.sparkSession
    name = qualified(table, schema, catalog)
    spark.sql(f"create database if not exists {name.rpartition('.')[0]}")
    seen = Observation()
    counted = with_comments(require_schema(df, declared), declared).observe(seen, F.count(F.lit(1)).alias("rows"))
    version = Version(name, f"{time.time_ns():020d}", 0)
    writer = counted.write.mode("errorifexists").option("compression", "zstd")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(version.table)
        version = Version(name, version.number, seen.get["rows"])
        if not version.rows:
            raise EmptyDataset(f"no rows for {name}")
    except Exception:
        drop(spark, version)
        raise
    return version


def drop(spark: SparkSession, version: Version) -> None:
    spark.sql(f"drop table if exists {version.table}")


def switch(spark: SparkSession, version: Version, description: str = "") -> None:
    """Let the public name stand for a version: one statement, whatever the size of the table.

    A plain table of that name, from before there were versions, becomes the first version.
    """
    schema, _, short = version.name.rpartition(".")
    plain = spark.sql(f"show tables in {schema} like '{short}'").where("not isTemporary").collect()
    views = {r["viewName"] for r in spark.sql(f"show views in {schema} like '{short}'").collect()}
    if plain and short.lower() not in {v.lower() for v in views}:
        spark.sql(f"alter table {version.name} rename to {version.name}{MARK}{0:020d}")
    columns = ", ".join(
        f"`{f.name}`" + (f" comment {_text(f.metadata['comment'])}" if f.metadata.get("comment") else "")
        for f in spark.table(version.table).schema
    )
    about = f"comment {_text(description)}" if description else ""
    spark.sql(
        f"create or replace view {version.name} ({columns}) {about} "
        f"tblproperties ('{VERSION_PROPERTY}' = '{version.number}') as select * from {version.table}"
    )


def versions(spark: SparkSession, name: str) -> list[str]:
    """Numbers of the versions that are kept, the oldest first."""
    schema, _, short = name.rpartition(".")
    tables = spark.sql(f"show tables in {schema} like '{short}{MARK}*'").select("tableName").collect()
    return sorted(r["tableName"].rpartition(MARK)[2] for r in tables)


def published(spark: SparkSession, name: str) -> str | None:
    """Number of the version that the public name stands for; None before the first."""
    if not spark.catalog.tableExists(name):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {name}").collect()}
    return found.get(VERSION_PROPERTY)


def roll_back(spark: SparkSession, name: str) -> str:
    """Let the name stand for the version before the published one again; returns its number."""
    now = published(spark, name)
    before = [v for v in versions(spark, name) if now is not None and v < now]
    if not before:
        raise LakeError(f"{name} has no former version")
    switch(spark, Version(name, before[-1], 0))
    return before[-1]


def expire(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Drop all versions but the published one and the `keep` - 1 before it; returns the dropped numbers.

    Versions newer than the published one are builds whose checks are not over, and stay.
    """
    now = published(spark, name)
    if now is None:
        return []
    old = [v for v in versions(spark, name) if v <= now][: -max(keep, 1)]
    for number in old:
        drop(spark, Version(name, number, 0))
    return old
