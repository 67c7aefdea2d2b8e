"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], *, tie: Sequence[str] | None = None
) -> DataFrame:
    """The row of each key that is greatest by `newest`; rows whose key is NULL count as one key.

    Ties fall to `tie`, by default all other columns in turn, so a rerun picks the same row; a sort looks at
    them only when the columns before are equal. Spark trims each input partition to one row per key before
    the shuffle, so a key with very many rows stays cheap.
    """
    if tie is None:
        tie = [c for c, dtype in df.dtypes if c not in {*keys, *newest} and "map<" not in dtype]
    order = [F.col(c).desc() for c in [*newest, *tie]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")
