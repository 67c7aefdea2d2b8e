"""Interval join: points with the intervals that hold them, by bins that follow the intervals' lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 4.0  # bins of one level are so many times wider than those of the level below
SHORTEST = 1e-3


def on_scale(df: DataFrame, column: str) -> Column:
    """A number or time as a double that never falls where the column rises; times in seconds."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind == "timestamp_ntz":
        return F.unix_date(c.cast("date")) * 86400.0 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if kind == "date":
        return F.unix_date(c).cast("double")
    return c.cast("double")


def interval_join(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, low: str, high: str
) -> DataFrame:
    """Every pair of a point and an interval of the same keys with `low` <= `at` <= `high`.

    An interval goes to the bins it touches on the level whose bins are as wide as it is, two or three in all; a point
    goes to one bin on each level that any interval is on, a few dozen at most. Pairs meet in an equality join on keys,
    level and bin and are then compared exactly, so no group is gathered and adaptive execution can split a crowded
    bin. NULL keys or ends, and intervals that end before they begin, match nothing. Columns other than the keys must
    have different names in both tables.
    """
    keys = list(keys)
    both = (set(points.columns) & set(intervals.columns)) - set(keys)
    if both:
        raise ValueError(f"columns in both tables: {sorted(both)}")
    start, end = on_scale(intervals, low), on_scale(intervals, high)
    length = F.greatest(end - start, F.lit(SHORTEST))
    held = intervals.where(F.col(low) <= F.col(high)).withColumn("_level", F.ceil(F.log(length) / F.log(F.lit(STEP))).cast("int"))
    levels = [r["_level"] for r in held.select("_level").distinct().collect()]  # a few dozen, whatever the data

    def bin_of(scale: Column) -> Column:
        return F.floor(scale / F.pow(F.lit(STEP), F.col("_level"))).cast("long")

    binned = held.withColumn("_bin", F.explode(F.sequence(bin_of(start), bin_of(end))))
    asked = F.array(*[F.lit(level) for level in levels]) if levels else F.array().cast("array<int>")
    placed = points.withColumn("_level", F.explode(asked)).withColumn("_bin", bin_of(on_scale(points, at)))
    met = placed.join(binned, [*keys, "_level", "_bin"])
    return met.where((F.col(low) <= F.col(at)) & (F.col(at) <= F.col(high))).drop("_level", "_bin")
