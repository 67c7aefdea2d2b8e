"""Silver builds: write a version, check it, and let it take over only if no error check failed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.operators.checks import enforce, store_failures
from rimstone.sinks.versions import Version, drop, expire, stage, switch


@dataclass(frozen=True)
class Built:
    """A published build: its version, the checks of severity `warn` that found rows, and where those rows are."""

    version: Version
    warnings: dict[str, int] = field(default_factory=dict)
    failures: str | None = None


def write_audit_publish(
    df: DataFrame,
    table: str,
    declared: T.StructType,
    summary: Callable[[DataFrame], DataFrame],
    failing: Callable[[DataFrame], DataFrame] | None = None,
    *,
    schema: str = "silver",
    catalog: str | None = None,
    description: str = "",
    keep: int = 2,
    audit_schema: str = "audit",
) -> Built:
    """Build a table and publish it under its name once its checks have passed.

    `summary` gives one line per check of the written version, `failing` the rows that fail them. If any check found
    something, those rows are kept in `<audit_schema>.<table>_failures`. A failed error check then drops the version
    and raises: the name still stands for the former version. A warning is logged and does not stop the build. The
    published version and the `keep` - 1 before it stay.
    """
    spark = df.sparkSession
    version = stage(df, table, declared, schema=schema, catalog=catalog)
    kept = None
    try:
        written = spark.table(version.table)
        lines = spark.createDataFrame(summary(written).collect(), SUMMARY)  # one line per declared check
        if failing is not None and not lines.where("failures > 0").isEmpty():
            rows = failing(written).withColumn("_version", F.lit(version.number))
            kept = store_failures(rows, f"{table}_failures", audit_schema)
        found = {r["check"]: r["failures"] for r in enforce(lines)}
    except Exception:
        drop(spark, version)
        raise
    switch(spark, version, description)
    expire(spark, version.name, keep)
    return Built(version, found, kept)


SUMMARY = "check string, kind string, column string, severity string, failures long"
