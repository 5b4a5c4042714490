"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folders staged within `released`, innermost; None outside of it.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def build_session(app: str = "perennial", cores: str | None = None, **conf: str) -> SparkSession:
    """A local session with the settings the jobs are written for.

    On a cluster the session comes from the submit command; nothing in the
    library needs this function there.
    """
    cores = cores or str(os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. On one machine it lies in
    the session's warehouse without that setting; executors on other machines
    would not see that, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.conf.get("spark.master", "local")
    if not named and master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have Hadoop delete a folder when the driver's JVM ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where a result is read several times or feeds a lookup join. The
    written files survive lost executors, and their size is what Catalyst
    compares with ``spark.sql.autoBroadcastJoinThreshold``: a staged table is
    broadcast when its measured size allows it and shuffled when not. The files
    are deleted when the driver's JVM ends, or with the ``released`` around the call.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    delete_on_exit(spark, path)
    if (folders := _staged.get()) is not None:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """Reads that are planned inside open many small files in a task.

    Spark counts a file as 4 MB at least, and looks named files up in a task
    each: with tens of thousands of images it starts tasks that do next to
    nothing. Large files are dealt out as before.
    """
    wanted = {
        "spark.sql.files.openCostInBytes": "64k",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside when the block ends, e.g. after each batch of a stream."""
    folders: list[str] = []
    outer = _staged.set(folders)
    try:
        yield
    finally:
        _staged.reset(outer)
        for path in folders:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
