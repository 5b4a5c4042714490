"""Object trees ``root/{version}/{outcome}/...``: listings, label documents and images.

Tasks list the objects and read label documents (see ``object_store``); the
driver holds folder names. Images are read through Spark's image source, for
named paths only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.functions import paths
from perennial.sources import object_store


def relative(path: Column) -> Column:
    """The last three segments ``version/outcome/file`` of a full path."""
    return F.substring_index(path, "/", -3)


def _unescaped(uri: Column) -> Column:
    """File URIs escape blanks; a plus sign stands for itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def discover(spark: SparkSession, pattern: str, name_filter: str | None = None) -> DataFrame:
    """Files matched by a glob, searched below matched folders; empty when nothing matches."""
    return object_store.list_below(spark, pattern, name_filter)


def glob_report(spark: SparkSession, pattern: str, preview: int = 30) -> tuple[int, list[str]]:
    """Number of matched files and the first few paths."""
    files = discover(spark, pattern).select("path")
    shown = [row.path for row in files.orderBy("path").limit(preview).collect()]
    return files.count() if len(shown) == preview else len(shown), shown


def list_objects(
    spark: SparkSession,
    root: str,
    family: str = "*",
    outcomes: Iterable[str] = (paths.CORRECT, paths.INCORRECT),
    name_filter: str | None = None,
) -> DataFrame:
    """Objects below the version folders of a family, path relative to the root.

    The folder glob keeps other versions and outcomes from being listed at all.
    """
    found = None
    for outcome in outcomes:
        part = discover(spark, f"{root}/{family}/{outcome}", name_filter)
        found = part if found is None else found.unionByName(part)
    return found.withColumn("path", relative(F.col("path")))


def list_example_files(spark: SparkSession, root: str) -> DataFrame:
    """Stored example files of all versions: ``path`` below ``processed/`` and ``version``."""
    found = discover(spark, f"{root}/processed/*/data", "*.parquet")
    inside = F.substring_index("path", "/", -3)
    return found.select(inside.alias("path"), paths.version_of(inside).alias("version"))


def list_json(objects: DataFrame, max_files: int | None = None) -> DataFrame:
    """JSON objects whatever the case of the suffix; 0 or None lists all of them."""
    found = objects.filter(paths.is_json(F.col("path"))).select("path")
    return found.orderBy("path").limit(max_files) if max_files else found


def read_label_files(
    spark: SparkSession,
    root: str,
    family: str = "*",
    outcomes: Iterable[str] = (paths.CORRECT, paths.INCORRECT),
) -> DataFrame:
    """Label documents as ``(label_path, value)``, listed and read by tasks."""
    found = None
    for outcome in outcomes:
        part = discover(spark, f"{root}/{family}/{outcome}", "*" + paths.LABEL_SUFFIX)
        found = part if found is None else found.unionByName(part)
    return object_store.contents(found.select("path")).select(
        relative(F.col("path")).alias("label_path"), F.decode("content", "UTF-8").alias("value")
    )


# Fields of the image source.
_IMAGE = "origin string, height int, width int, nChannels int, mode int, data binary"


def read_images(
    spark: SparkSession,
    root: str,
    family: str = "*",
    outcomes: Iterable[str] = (paths.INCORRECT,),
) -> DataFrame:
    """Decoded images of whole folders with their relative path; files that cannot be decoded are left out.

    Pixels are in the source's own channel order, see ``operators.images``.
    """
    found = None
    for outcome in outcomes:
        reader = (
            spark.read.format("image")
            .option("dropInvalid", True)
            .option("pathGlobFilter", "*" + paths.IMAGE_SUFFIX)
            .option("recursiveFileLookup", True)
        )
        try:
            part = reader.load(f"{root}/{family}/{outcome}").select("image.*")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            part = spark.createDataFrame([], _IMAGE)
        found = part if found is None else found.unionByName(part)
    return _decoded(found)


def read_images_at(spark: SparkSession, root: str, wanted: list[str]) -> DataFrame:
    """The images of these relative paths; one that cannot be decoded has a height of -1, an empty file no row.

    Only these files are opened. The driver holds their paths, so callers pass
    a bounded number at a time.
    """
    if not wanted:
        return _decoded(spark.createDataFrame([], _IMAGE))
    # names are plain text here, not patterns
    plain = [f"{root}/" + re.sub(r"([\\\[\]{}*?])", r"\\\1", path) for path in wanted]
    return _decoded(spark.read.format("image").option("dropInvalid", False).load(plain).select("image.*"))


def _decoded(rows: DataFrame) -> DataFrame:
    return rows.select(
        relative(_unescaped(F.col("origin"))).alias("path"),
        F.col("height"),
        F.col("width"),
        F.col("nChannels").alias("n_channels"),
        F.col("data"),
    )
