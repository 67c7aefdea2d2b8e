"""Bronze load of datasets whose physical types differ from season to season."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rimstone.session import filesystem
from rimstone.sources.files import dataset_path, list_files, source_name_of, union_by_name, with_lineage


def expand(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the datasets that a pattern names, in order; none if there is none. One row per dataset, not per file."""
    store, path = filesystem(spark, pattern)
    found = store.globStatus(path)
    return sorted(f.getPath().toString() for f in found) if found is not None else []


def cannot_merge(exc: Exception) -> bool:
    """Whether Spark says that the types of one column differ; it comes as a Spark error or as the JVM's own."""
    return "CANNOT_MERGE" in str(exc)


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """Datasets grouped so that each group has one type per column, with the columns of all its files.

    Tasks read the footers of all files of a group side by side and merge them, at any address that Spark reads; the
    driver gets one schema per group. A group whose types disagree is halved, so seasons of one era take one job,
    however many they are. Groups that turn out alike are put together. A dataset whose own files disagree is refused.
    """
    paths = list(paths)
    if not paths:
        return []
    try:
        found = [(paths, spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as exc:
        if len(paths) == 1 or not cannot_merge(exc):
            raise
        half = len(paths) // 2
        found = schema_groups(spark, paths[:half]) + schema_groups(spark, paths[half:])
    alike: dict[str, tuple[list[str], T.StructType]] = {}
    for group, schema in found:
        alike.setdefault(schema.simpleString(), ([], schema))[0].extend(group)
    return list(alike.values())


def load_datasets(
    spark: SparkSession,
    paths: Sequence[str],
    types: Mapping[str, str],
    shape: Callable[[DataFrame], DataFrame] = with_lineage,
) -> DataFrame:
    """Rows of all datasets, the named columns brought to one type; one scan for each group of schemas.

    `shape` is given each scan and may add what the path of a file tells, or leave out columns. Columns that a dataset
    lacks are NULL; columns not named keep their type.
    """
    if not paths:
        raise FileNotFoundError("no dataset to load")
    frames = []
    for group, schema in schema_groups(spark, paths):
        rows = shape(spark.read.schema(schema).parquet(*group))
        frames.append(rows.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items() if c in rows.columns}))
    return union_by_name(frames)


def dataset_paths(spark: SparkSession, folder: str, glob: str = "*.parquet", prefix: str = "") -> list[str]:
    """Datasets below a folder whose source name starts with `prefix`, those of one source side by side.

    A dataset is a Parquet file or a folder named like one. There are as many as seasons and sources.
    """
    dataset = F.coalesce(F.nullif(dataset_path(F.col("path")), F.lit("")), F.col("path")).alias("path")
    found = list_files(spark, folder, glob).select(dataset).distinct()
    name = source_name_of(F.col("path"))
    return [r["path"] for r in found.where(F.startswith(name, F.lit(prefix))).orderBy(name, "path").collect()]


def file_groups(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """Datasets below a folder with the schema they are read with: `(path, signature)`."""
    groups = schema_groups(spark, dataset_paths(spark, folder, glob))
    rows = [(path, schema.simpleString()) for paths, schema in groups for path in paths]
    return spark.createDataFrame(rows, "path string, signature string")


def read_with_drift(
    spark: SparkSession, folder: str, types: Mapping[str, str], glob: str = "*.parquet", prefix: str = ""
) -> DataFrame:
    """Rows of all datasets below a folder with lineage, the named columns brought to one type; see `load_datasets`."""
    paths = dataset_paths(spark, folder, glob, prefix)
    if not paths:
        raise FileNotFoundError(f"no {prefix}{glob} below {folder}")
    return load_datasets(spark, paths, types)
