"""Disk space of finished jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perennial.session import stage


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for table in staged:
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        for folder in folders:
            place = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def stage_and_release(df: DataFrame, name: str) -> DataFrame:
    """Stage a table and let Spark delete the shuffle files that made it.

    Spark deletes a finished job's shuffle files once the driver's JVM has
    collected the job's plan. A driver with memory to spare may not collect for
    hours, while the executors' disks fill.
    """
    staged = stage(df, name)
    df.sparkSession._jvm.System.gc()
    return staged
