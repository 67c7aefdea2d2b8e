"""Parquet, file and table scans, and the lineage that a file's path carries."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.functions import file_stem
from rimstone.session import filesystem

log = logging.getLogger(__name__)

# A dataset is a file or a folder named <source name>.parquet; a season folder looks like 2025-26.
DATASET_PATH = r"^(.*?\.parquet)(?:/.*)?$"
SEASON_PART = r"/([0-9]{4}-[0-9]{2})/"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet dataset."""
    return spark.read.parquet(path)


def scan_prefix(spark: SparkSession, folder: str, prefix: str) -> DataFrame | None:
    """All Parquet datasets of a folder whose name starts with `prefix`; None, with a warning, if there is none."""
    try:
        return spark.read.parquet(f"{folder.rstrip('/')}/{prefix}*.parquet")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no file %s*.parquet in %s", prefix, folder)
        return None


def read_table(spark: SparkSession, table: str, *, schema: str, catalog: str | None = None) -> DataFrame:
    """A catalog table: a source in `bronze`, or another model in `silver`."""
    return spark.table(".".join(part for part in (catalog, schema, table) if part))


def file_path() -> Column:
    return F.col("_metadata.file_path")


def dataset_path(path: Column) -> Column:
    """Path of the dataset a data file belongs to: the file itself, or the folder named like one."""
    return F.regexp_extract(path, DATASET_PATH, 1)


def source_name_of(path: Column) -> Column:
    """Source name in a data file's path."""
    return file_stem(dataset_path(path))


def season_of(path: Column) -> Column:
    """Season folder in a data file's path; NULL when it is not season-scoped."""
    return F.nullif(F.regexp_extract(path, SEASON_PART, 1), F.lit(""))


def with_source_name(df: DataFrame) -> DataFrame:
    """Rows of a file scan with the name of the source each came from."""
    return df.select("*", source_name_of(file_path()).alias("source_name"))


def with_lineage(df: DataFrame) -> DataFrame:
    """Rows of a file scan with the columns of a bronze table: season, path, source name and load time.

    The load time is the file's modification time.
    """
    return df.select(
        "*",
        season_of(file_path()).alias("season"),
        file_path().alias("_bronze_path"),
        source_name_of(file_path()).alias("_source_name"),
        F.col("_metadata.file_modification_time").alias("_ingested_at"),
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Path, time and length of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime", "length")
    )


def read_raw_files(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """Raw report files with their bytes."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
    )


def object_keys(spark: SparkSession, root: str, folders: Sequence[str] = ()) -> DataFrame:
    """Keys stored below a root, one per dataset or raw file: `(s3_key)`; with `folders`, only below those."""
    base = root.rstrip("/")
    listed = [f"{base}/{folder}" for folder in folders] or [base]
    files = union_by_name([list_files(spark, path) for path in listed])
    dataset = F.coalesce(F.nullif(dataset_path(F.col("path")), F.lit("")), F.col("path"))
    inside = F.regexp_replace(dataset, "^[a-z0-9]+:/*", "/")
    above = "/" + root.split("://")[-1].removeprefix("file:").strip("/") + "/"
    return files.select(F.substring_index(inside, above, -1).alias("s3_key")).distinct()


def stored_among(keys: DataFrame, root: str) -> DataFrame:
    """Keys stored in the top folders that `keys(s3_key)` name; the rest of the store is not listed.

    Top folders are seasons and dataset kinds, so there are few.
    """
    spark = keys.sparkSession
    tops = keys.select(F.substring_index("s3_key", "/", 1).alias("top")).distinct().collect()
    there = []
    for top in sorted(r["top"] for r in tops):
        store, path = filesystem(spark, f"{root.rstrip('/')}/{top}")
        if store.exists(path):
            there.append(top)
    return object_keys(spark, root, there) if there else keys.where("false").select("s3_key")


def object_exists(spark: SparkSession, root: str, key: str) -> bool:
    """Whether a key is stored; a key that is only a folder of other keys is not."""
    keys = stored_among(spark.createDataFrame([(key,)], "s3_key string"), root)
    return not keys.where(F.col("s3_key") == key).isEmpty()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones NULL; duplicates stay."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
