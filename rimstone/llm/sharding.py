"""Contiguous shards of nearly equal byte size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import global_positions


def balanced_shards(df: DataFrame, n_shards: int, order_by: list[str], size: Column) -> DataFrame:
    """`df` with `shard` (0 to n_shards - 1) and `slot` (0, 1, ... within the shard), contiguous in `order_by`.

    Global prefix sums of `size` come from per-partition totals; a row goes to the shard in which its middle byte
    falls when the total is cut at equal targets, so a shard misses the target by half a row at each end at most.
    Nulls sort first. Rows that tie in `order_by` may swap places. Rows without size take the shard of the place
    where they stand. Columns named shard or slot are replaced. An empty table gives no rows.
    """
    placed, _, total = global_positions(df.drop("shard", "slot"), order_by, F.coalesce(size, F.lit(0)))
    if total:
        # Whole numbers only: the doubled middle of the row over the doubled target.
        middle = F.expr(f"(2 * __before + __size) * {n_shards}L div {2 * total}L")
        shard = F.least(middle, F.lit(n_shards - 1)).cast("int")
    else:
        shard = F.lit(0)
    placed = placed.withColumn("shard", shard)
    first = placed.groupBy("shard").agg(F.min("__row").alias("__first"))  # n_shards rows
    slotted = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("__row") - F.col("__first"))
    return slotted.drop("__first", "__row", "__before", "__size")
