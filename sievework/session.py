"""Session helpers: tables by name, the shared folder, lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings for local tests and the bench; a cluster brings its own.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", memory)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only in a local session that names none (tests) a temporary folder takes its place; on a
    cluster a missing setting is an error, for each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"sievework-{context.applicationId}")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the session's process ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


#: Rows of a table that may be broadcast once they are counted.
BROADCAST_ROWS = 200_000


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows; else as it is, for Spark to join by shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df.hint("merge")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there (reliable checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions within are deleted as each ends, not when the driver collects its garbage; for results that are stored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a ``scratch`` path and go on from there: smaller than a checkpoint by far. Its shuffle files are deleted; ``discard`` ends it."""
    with released(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete what ``store`` wrote."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
