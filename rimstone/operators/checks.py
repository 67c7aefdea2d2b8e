"""Data checks: a check names rows (or groups of rows) that break a rule; no such row means it passes.

A row rule fails a row only when it is FALSE, so NULL passes unless the rule itself is null-safe.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimstone.errors import ChecksFailed
from rimstone.functions import trimmed
from rimstone.operators.skew import spread_join
from rimstone.session import materialize

log = logging.getLogger(__name__)

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class RowCheck:
    """A check that can be decided for each row on its own; `rule` is SQL text that must not be FALSE."""

    name: str
    kind: str
    rule: str
    column: str | None = None
    severity: str = ERROR

    def fails(self) -> Column:
        """TRUE for failing rows, otherwise FALSE; never NULL."""
        return F.coalesce(~F.expr(self.rule), F.lit(False))


def _quoted(column: str) -> str:
    return f"`{column}`"


def not_null(column: str, severity: str = ERROR) -> RowCheck:
    return RowCheck(f"not_null_{column}", "not_null", f"{_quoted(column)} is not null", column, severity)


def length_is(column: str, n: int, severity: str = ERROR) -> RowCheck:
    return RowCheck(f"length_{column}", "length_equal_to", f"length({_quoted(column)}) = {n}", column, severity)


def in_range(column: str, low: float, high: float, severity: str = WARN) -> RowCheck:
    rule = f"{_quoted(column)} between {low} and {high}"
    return RowCheck(f"range_{column}", "accepted_range", rule, column, severity)


def in_values(column: str, values: Sequence[str], severity: str = ERROR) -> RowCheck:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return RowCheck(f"values_{column}", "accepted_values", f"{_quoted(column)} in ({listed})", column, severity)


def holds(name: str, rule: str, column: str | None = None, severity: str = ERROR) -> RowCheck:
    """Rule in free SQL; with `column`, the column is the left operand of the rule."""
    text = f"{_quoted(column)} {rule}" if column else rule
    return RowCheck(name, "expression_is_true", text, column, severity)


def summarize(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Failing rows per check, all checks in one pass over `df`."""
    counts = df.agg(*[F.count_if(check.fails()).alias(f"c{i}") for i, check in enumerate(checks)])
    lines = [
        F.struct(
            F.lit(check.name).alias("check"),
            F.lit(check.kind).alias("kind"),
            F.lit(check.column).cast("string").alias("column"),
            F.lit(check.severity).alias("severity"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*lines)))


def summarize_failing(name: str, failing: DataFrame, kind: str = "table", severity: str = ERROR) -> DataFrame:
    """Summary line of a check given by its failing rows or groups."""
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check"),
        F.lit(kind).alias("kind"),
        F.lit(None).cast("string").alias("column"),
        F.lit(severity).alias("severity"),
        "failures",
    )


def failing_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    """Rows that break one row check."""
    return df.where(check.fails())


@dataclass(frozen=True)
class GroupCheck:
    """A check that finds groups: `groups` holds the `keys` of those that break it."""

    name: str
    kind: str
    keys: tuple[str, ...]
    groups: DataFrame
    severity: str = ERROR


# Attributes of a check that its lines show, and the names of their columns.
_LINE_PARTS = {"name": "check", "kind": "kind", "severity": "severity"}


def failing_check_rows(df: DataFrame, checks: Sequence[RowCheck], groups: Sequence[GroupCheck] = ()) -> DataFrame:
    """One line per row and check that it fails: `check`, `kind`, `severity` and the row's columns.

    All row checks are decided in one pass over `df`, which is not shuffled for them. The groups that break a group
    check, few in a sound table, are written first, so that their size is known before `df` meets them (NULL keys match
    NULL keys): few are broadcast, and only for many is `df` shuffled, each time with the columns asked for alone. All
    rows of such a group fail the check. `df` is read once for the row checks and once for each group check.
    """
    numbers = F.array_compact(F.array(*[F.when(check.fails(), F.lit(i + 1)) for i, check in enumerate(checks)]))
    lines = df.select(F.explode(numbers).alias("_check"), *df.columns)
    about = {
        part: F.element_at(F.lit([getattr(check, part) for check in checks]), F.col("_check"))
        for part in ("name", "kind", "severity")
    }
    found = []
    if checks:
        found.append(lines.select(*[about[p].alias(n) for p, n in _LINE_PARTS.items()], *df.columns))
    for group in groups:
        keys = {k: f"_key{j}" for j, k in enumerate(group.keys)}
        broken = group.groups.select(*[F.col(f"`{k}`").alias(name) for k, name in keys.items()]).distinct()
        same = [F.col(f"`{k}`").eqNullSafe(F.col(name)) for k, name in keys.items()]
        rows = df.join(materialize(broken, "broken-groups"), reduce(Column.__and__, same), "left_semi")
        found.append(rows.select(*[F.lit(getattr(group, p)).alias(n) for p, n in _LINE_PARTS.items()], *df.columns))
    return reduce(DataFrame.unionByName, found)


def value_counts_outside(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """How often each value outside the allowed list occurs."""
    return df.where(~F.col(column).isin(*allowed)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def groups_breaking(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], rule: str
) -> DataFrame:
    """Groups whose aggregates make `rule` FALSE."""
    grouped = df.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures.items()])
    return grouped.where(F.coalesce(~F.expr(rule), F.lit(False)))


def not_latest(table: DataFrame, source: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Rows of `table` whose stamp differs from the greatest stamp of their key in `source`.

    Ids in `source` are trimmed first. A NULL key never matches, as in any equi-join.
    """
    latest = source.groupBy(*[trimmed(k).alias(k) for k in keys]).agg(F.max(stamp).alias("_latest"))
    joined = spread_join(table, latest, keys)
    return joined.where(F.col("_latest") != F.col(stamp)).drop("_latest").select(*table.columns)


def store_failures(failing: DataFrame, check: str, schema: str = "audit") -> str:
    """Keep the failing rows of a check as a table and return its name."""
    spark = failing.sparkSession
    spark.sql(f"create database if not exists {schema}")
    name = f"{schema}.{check}"
    failing.write.mode("overwrite").saveAsTable(name)
    return name


def enforce(summary: DataFrame) -> list:
    """Raise if a check of severity `error` failed, log those of severity `warn`; returns the failed lines.

    The summary has one row per declared check, so collecting it is bounded.
    """
    failed = summary.where("failures > 0").collect()
    for row in failed:
        if row["severity"] == WARN:
            log.warning("check %s: %d failing rows", row["check"], row["failures"])
    errors = [row for row in failed if row["severity"] == ERROR]
    if errors:
        raise ChecksFailed(", ".join(f"{row['check']} ({row['failures']})" for row in errors))
    return failed
