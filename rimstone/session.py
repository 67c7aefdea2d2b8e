"""Session set-up for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = 8, name: str = "rimstone") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only a local master, where driver and executors are one process, falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="rimstone-")
    return _LOCAL_FOLDERS[app]


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    Cuts the lineage, survives the loss of executors, and later readers prune its columns. The table is
    removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    store, written = filesystem(spark, path)
    store.deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame, label: str) -> None:
    """Remove the tables written under `label` that `df` reads; neither `df` nor anything made of it can be read again."""
    folders = {file.rsplit("/", 1)[0] for file in df.inputFiles()}
    for folder in folders:
        if folder.rsplit("/", 1)[1].startswith(f"{label}-"):
            store, written = filesystem(df.sparkSession, folder)
            store.delete(written, True)
