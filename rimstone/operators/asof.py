"""As-of join: for each row the latest row of another table at or before its time, whatever the size of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rimstone.session import materialize


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, partitions: int | None = None
) -> DataFrame:
    """Every row of `left` with the columns of the last row of `right` that has its keys and is not later.

    Of rows of `right` at one time the greatest by its columns in order counts. A row without such a row, a NULL key or a
    NULL time gets NULLs. Columns other than the keys must have different names in both tables.

    Both tables are dealt together to range partitions by key and time, so one key may fill many partitions. In each
    partition the last row of `right` is carried forward per key; what a partition hands on to the next ones is one row
    for each partition that begins within a key, which is at most one per partition. No group is larger than a partition.
    """
    keys = list(keys)
    mine = [c for c in left.columns if c not in keys]
    theirs = [c for c in right.columns if c not in keys]
    if set(mine) & set(theirs):
        raise ValueError(f"columns in both tables: {sorted(set(mine) & set(theirs))}")
    n = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    on_left = F.struct(*mine).alias("_left")
    on_right = F.struct(right_time, *[c for c in theirs if c != right_time]).alias("_right")
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*keys, right_time]])
    found = right.where(whole).select(*keys, F.col(right_time).alias("_time"), F.lit(0).alias("_side"), on_right)
    asking = left.select(*keys, F.col(left_time).alias("_time"), F.lit(1).alias("_side"), on_left)
    both = asking.unionByName(found, allowMissingColumns=True)
    dealt = both.repartitionByRange(n, *keys, "_time").withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "asof")
    before = Window.partitionBy("_part", *keys).orderBy("_time", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    filled = dealt.withColumn("_found", F.last("_right", ignorenulls=True).over(before)).where("_side = 1")
    ends = dealt.groupBy("_part", *keys).agg(F.max("_right").alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(earlier)).where("_carried is not null")
    carried = carried.select(F.col("_part").alias("_to"), "_carried", *[F.col(k).alias(f"_to_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_to_{k}") for k in keys], F.col("_part") == F.col("_to"))
    # At most one row for each partition.
    joined = filled.join(F.broadcast(carried), same, "left").withColumn("_found", F.coalesce("_found", "_carried"))
    return joined.select(*[F.col(c) if c in keys else F.col(f"_left.{c}") for c in left.columns], *[F.col(f"_found.{c}") for c in theirs])
