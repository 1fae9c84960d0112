"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings the plans are tuned for.  AQE re-plans joins from measured sizes,
#: splits skewed join partitions and coalesces small ones, so no operator in
#: this package forces a broadcast of data whose size it has not checked.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


#: How much a task takes up: of a file when tables are scanned, of a shuffle when AQE merges its
#: partitions.  Compressed rows grow tenfold and more in a sort; at Spark's own sizes (128 and 64 MB)
#: one task's sort is some gigabytes.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def bound_tasks(spark: SparkSession) -> None:
    """Give a session that leaves :data:`TASK_SIZES` open those sizes; what it sets itself stays."""
    for key, value in TASK_SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def build_session(master: str | None = None, app: str = "tallyline", **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` uses ``_`` for ``.`` in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # how files are cut into splits must not follow the number of executors (see `number_rows`)
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    bound_tasks(spark)
    return spark


def use_local_scratch(spark: SparkSession) -> None:
    """Give a session in local mode a shared folder where it has none (tests, bench, driver).

    One machine runs all of such a session.  On a cluster nothing is set: there
    a machine-local folder would be invisible to the other executors.
    """
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyline-"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`; never reused, so a retry cannot mix runs."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Whether Spark removes the shuffle files of a query as soon as it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the writes inside go with each write; otherwise they stay until the driver's garbage collector meets them.

    Meant for tables written and read back: nobody runs the plan of such a write again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def written_once(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table that several branches of a plan read, and read it back.

    Meant for folded intermediate tables.  The copy lies in the shared folder,
    so it outlives any executor and the work below it runs once.  ``codec`` is for
    copies of whole tables: zstd makes them about a quarter smaller than the default.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
