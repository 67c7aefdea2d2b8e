"""Names, paths and keys of datasets, worked out as columns from a table of declarations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.errors import MissingSuffix
from rimstone.functions import kebab

DEFAULT_SCHEMA = "default"


@dataclass(frozen=True)
class Declared:
    """A dataset by its parts: the words of its source name and the folders it lies in, below the lake's root."""

    prefix: str
    suffixes: tuple[object, ...]
    folders: tuple[object, ...]


@dataclass(frozen=True)
class Target:
    """Name, path and key under which one dataset is published."""

    source_name: str
    path: str
    s3_key: str


def named(declared: DataFrame) -> DataFrame:
    """`declared(prefix, suffixes, folders)` with `source_name` and `s3_key`, the place below the lake's root."""
    with_name = declared.withColumn("source_name", kebab("prefix", F.array_join("suffixes", "-")))
    file = F.concat("source_name", F.lit(".parquet"))
    return with_name.withColumn("s3_key", F.concat_ws("/", "folders", file))


def targets(spark: SparkSession, root: str, declared: Sequence[Declared]) -> list[Target]:
    """Naming of declared datasets, in their order. An empty folder stands for one that is filled in on the day: today."""
    for d in declared:
        if not d.suffixes:
            raise MissingSuffix(f"a dataset of {d.prefix!r} is told from others by its suffixes; it has none")
        if not d.folders:
            raise ValueError(f"dataset {d.prefix!r} is in no folder")
    rows = [(i, d.prefix, [str(x) for x in d.suffixes], [str(x) for x in d.folders]) for i, d in enumerate(declared)]
    table = spark.createDataFrame(rows, "n int, prefix string, suffixes array<string>, folders array<string>")
    today = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd")
    filled = table.withColumn("folders", F.transform("folders", lambda f: F.when(f == "", today).otherwise(f)))
    path = F.concat_ws("/", F.rtrim(F.lit(root), F.lit("/")), "s3_key").alias("path")
    made = named(filled).orderBy("n").select("source_name", path, "s3_key")
    return [Target(*row) for row in made.collect()]


def report_folder(root: str, folder: str, year: int, tier: str) -> str:
    """`root/<folder>/<year>/<tier>`; the tier is `raw` or `parsed`."""
    return f"{root.rstrip('/')}/{folder}/{year}/{tier}"


def wanted_targets(
    prefix: str, variants: dict[str, Sequence[str]], seasons: DataFrame, periods: Sequence[str]
) -> DataFrame:
    """Every (season, variant, dataset) with its source name and key, to be compared with the ledger.

    One row per season and declared dataset, so it stays small.
    """
    listed = [(v, d) for v, names in variants.items() for d in names]
    pairs = F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(d).alias("dataset")) for v, d in listed])
    rows = seasons.select("season", F.inline(pairs)).withColumns(
        {
            "prefix": F.lit(prefix),
            "suffixes": F.array(
                *[F.lit(p) for p in periods], F.col("variant"), F.replace("dataset", F.lit("_"), F.lit("-"))
            ),
            "folders": F.array("season"),
        }
    )
    return named(rows).select("season", "variant", "dataset", "source_name", "s3_key")


def qualified(table: str, schema: str | None = None, catalog: str | None = None) -> str:
    """Table name with its schema as given, or the default one."""
    return ".".join(part for part in (catalog, (schema or "").strip() or DEFAULT_SCHEMA, table) if part)
