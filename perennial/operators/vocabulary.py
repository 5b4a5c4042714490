"""The label vocabulary ``class_name -> label_id``.

Its size is the width of the classifier's output layer, so windows over the
whole vocabulary are small whatever the number of examples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perennial.functions import paths


def from_json(docs: DataFrame, column: str = "value") -> DataFrame:
    """Explode documents ``{class_name: id}`` into rows."""
    return docs.select(
        F.explode(F.from_json(F.col(column), "map<string,int>")).alias("class_name", "label_id")
    )


def to_json(label_map: DataFrame) -> DataFrame:
    """One document ``{class_name: id}``, entries in id order."""
    entries = F.array_sort(F.collect_list(F.struct("label_id", "class_name")))
    pairs = F.transform(entries, lambda e: F.struct(e["class_name"], e["label_id"]))
    return label_map.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))


def from_csv(docs: DataFrame, column: str = "value") -> DataFrame:
    """Header-less list of names, one per line, in one document: the line number is the id.

    The document is one row because line numbers need the whole text in order.
    """
    lines = docs.select(
        F.posexplode(F.split(F.regexp_replace(F.col(column), r"\r?\n\s*$", ""), r"\r?\n"))
    )
    return lines.select(
        F.btrim(F.col("col"), F.lit(" \t")).alias("class_name"), F.col("pos").alias("label_id")
    ).filter(F.col("class_name") != "")


def names_of(label_map: DataFrame) -> DataFrame:
    """The inverse map; an id used twice fails, since it would hide a class."""
    once = label_map.groupBy("label_id").agg(
        F.min("class_name").alias("label_name"), F.count("*").alias("n")
    )
    return once.select(
        "label_id",
        F.when(F.col("n") == 1, F.col("label_name"))
        .otherwise(
            F.raise_error(F.concat(F.lit("label id used twice: "), F.col("label_id").cast("string")))
        )
        .alias("label_name"),
    )


def new_labels(objects: DataFrame, label_map: DataFrame, path: str = "path") -> DataFrame:
    """Labels named by the files but missing from the vocabulary."""
    seen = objects.select(paths.label_in_name(F.col(path)).alias("class_name")).distinct()
    return seen.join(label_map.select("class_name"), "class_name", "left_anti")


def extend(label_map: DataFrame, fresh: DataFrame) -> DataFrame:
    """Add labels with the next free ids, in label order; existing ids stay."""
    base = label_map.agg(
        F.coalesce(F.max("label_id") + 1, F.lit(0)).cast("int").alias("base")
    ).scalar()
    order = Window.partitionBy(F.lit(0)).orderBy("class_name")
    added = fresh.select(
        "class_name", (base + F.row_number().over(order) - 1).cast("int").alias("label_id")
    )
    return label_map.select("class_name", "label_id").unionByName(added)
