"""Tables stored in buckets of a key, so that repeated joins on it need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from perennial.session import delete_on_exit, fresh_path


def store(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> str:
    """Write ``df`` in buckets of ``keys`` below the shared folder; returns the name of the table.

    Two tables stored with the same number of buckets join on their keys bucket
    by bucket, without an exchange. Each bucket is one sorted file, written by
    one task after one shuffle. The number of buckets is that of the session's
    shuffle partitions unless given. The table is in the session's catalog
    until ``drop``, its files stay until the driver ends.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(table)
    delete_on_exit(spark, path)
    return table


def drop(spark: SparkSession, *tables: str) -> None:
    """Take tables out of the catalog; what still reads them fails from then on."""
    for table in tables:
        spark.sql(f"drop table if exists {table}")
