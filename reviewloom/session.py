"""Spark session and the shared working folder.

Every job keeps its intermediate tables in the folder the cluster names in
``spark.checkpoint.dir``.  A machine-local folder is used only for a local
master, where driver and executors are one process.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "reviewloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on; keyword arguments override.

    Shuffle parallelism is left to the cluster configuration: adaptive execution
    coalesces small partitions and splits skewed join partitions at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for written intermediate tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="reviewloom-")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so reruns cannot mix."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Shuffle files otherwise stay until the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What plans made and run in this block shuffle is removed as soon as they have run; a plan is to run once."""
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANED, before)


def written(df: DataFrame, label: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, cutting lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    read = spark.read.schema(df.schema).parquet(path)
    read._written_path = path
    return read


def discard(df: DataFrame) -> None:
    """Delete the files of a frame from ``written`` that nothing will read any more."""
    path = getattr(df, "_written_path", None)
    if path is not None:
        spark = df.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    The driver zips its own source and Spark's file server hands it out; workers need no shared copy.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="reviewloom-code-"), "reviewloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def small_or_as_is(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Broadcast ``df`` only after its row count has been checked; otherwise return it unhinted."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give costly work one partition per core when the scan ``df`` has fewer.

    Apply it to scans only: on a plan with shuffles, asking for partitions would run them.

    ``keys`` should be unique or close to it; hashing them is cheaper than a round-robin
    spread.  A scan of many files already has more partitions than cores and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
