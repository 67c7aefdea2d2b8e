"""Projections that turn landed rows into typed, keyed rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimstone.errors import MissingColumn
from rimstone.functions import hash_key, snake_names, trimmed


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` itself, or an error naming what is missing before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumn(f"{missing} not found, columns: {df.columns}")
    return df


def clean(
    df: DataFrame,
    *,
    trims: Sequence[str] = (),
    casts: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Trimmed text columns, typed columns and pass-through columns, in that order; others are dropped."""
    casts = casts or {}
    return df.select(
        *[trimmed(F.col(f"`{c}`")).alias(c) for c in trims],
        *[F.col(f"`{c}`").cast(t).alias(c) for c, t in casts.items()],
        *[F.col(f"`{c}`") for c in keep],
    )


def with_hash_keys(df: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Add surrogate keys, given as new name to id column."""
    return df.withColumns({name: hash_key(source) for name, source in keys.items()})


def tag_source(df: DataFrame, name: str, column: str = "source_name") -> DataFrame:
    """Add the constant name of the source the rows came from."""
    return df.withColumn(column, F.lit(name))


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake case."""
    return df.toDF(*snake_names(df.columns))
