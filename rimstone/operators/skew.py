"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of the smaller side. One gives each side its own exchange without doubling anything, which lets adaptive
# execution split hot keys; a side that is tiny next to the other can afford more.
DEFAULT_SPREAD = 1
TINY_SIDE_SPREAD = 8


def slot(columns: Sequence[str], spread: int) -> Column:
    """Slot number of a row, the same whenever its task is run again.

    The task's partition id is hashed with the columns, so rows of one key, and even copies of one row, that
    come from different partitions get different slots. Unlike `rand`, a lost task that is run again sends
    every row to the slot it had before.
    """
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(spread)).cast("int")


def spread_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    spread: int = DEFAULT_SPREAD,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Join `many` to `one`, which has at most one row per key.

    Each key's rows in `many` are spread over `spread` tasks and `one` is copied to each of them. Because the
    join key then differs from the key `one` was grouped by, both sides get their own exchange directly below
    the join, so adaptive execution can split what is still skewed, and can broadcast `one` if it turns out
    to be small at run time. `by` names columns that differ between the rows of a key, where there are any, to
    spread rows within a partition too. `how` may be any join that keeps or drops rows of `many` only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot run a {how} join")
    keys = list(keys)
    spread_rows = many.withColumn("_slot", slot(list(by or keys), spread))
    copies = one.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return spread_rows.join(copies, [*keys, "_slot"], how).drop("_slot")
