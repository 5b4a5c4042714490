"""Confusion matrices as rows and in packed text ``true:predicted:count|...``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennial.operators.joins import join_groups


def build(log: DataFrame, by: list[str]) -> DataFrame:
    return log.groupBy(*by, "actual", "predicted").agg(F.count("*").alias("n"))


def pack(matrix: DataFrame, by: list[str]) -> DataFrame:
    """One text per group; a group has at most classes x classes entries."""
    entry = F.concat_ws(":", "actual", "predicted", F.col("n").cast("string"))
    return matrix.groupBy(*by).agg(
        F.array_join(F.array_sort(F.collect_list(entry)), "|").alias("confusion_matrix")
    )


# Entries of one chunk, about.
CHUNK_ENTRIES = 100_000


def pack_chunks(matrix: DataFrame, by: list[str], entries: int = CHUNK_ENTRIES) -> DataFrame:
    """The same in chunks, for groups with very many classes: ``chunk`` numbers them from 0.

    A chunk holds whole matrix rows, in the order of the true labels, up to
    ``entries`` entries and those of one more label. Only the labels' entry
    counts, one row for each true label, are put in order.
    """
    counts = matrix.groupBy(*by, "actual").agg(F.count("*").alias("k_"))
    before = Window.partitionBy(*by).orderBy("actual").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(
        *by,
        "actual",
        F.floor(F.coalesce(F.sum("k_").over(before), F.lit(0)) / entries).cast("int").alias("chunk"),
    )
    return pack(join_groups(matrix, placed, [*by, "actual"]), [*by, "chunk"])


def unpack(packed: DataFrame, by: list[str], lenient: bool = False) -> DataFrame:
    """Rows of packed matrices, whole or in chunks. A broken entry fails the query unless ``lenient``."""
    entries = packed.select(*by, F.explode(F.split("confusion_matrix", "[|]")).alias("entry"))
    parts = entries.select(*by, F.split("entry", ":").alias("parts"))
    if lenient:
        cells = [F.get("parts", F.lit(i)) for i in range(3)]
        count = cells[2].try_cast("bigint")
    else:
        cells = [F.col("parts")[i] for i in range(3)]
        count = cells[2].cast("bigint")
    return parts.select(
        *by, cells[0].alias("true_label"), cells[1].alias("predicted_label"), count.alias("count")
    )
