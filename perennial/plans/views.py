"""The given tables seen as the tables the engine works on (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perennial.functions.binding import let
from perennial.operators import confusion, vocabulary
from perennial.session import stage


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is inferred once, which saves a job per later read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def prediction_log(events: DataFrame) -> DataFrame:
    """Prediction rows from event rows; also used on a stream of events."""
    slot = F.col("user_id") % 12
    wrong = F.col("event_id") % (slot + 2) == 0
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("v3_"), slot.cast("string")).alias("model_version"),
        F.col("event_type").alias("actual"),
        F.when(wrong, F.lit("view")).otherwise(F.col("event_type")).alias("predicted"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("boolean"))
        .otherwise(~wrong | (F.col("event_type") == "view"))
        .alias("is_correct"),
        (F.abs("value") / 100).alias("latency"),
        ((F.col("event_id") % 97 + 1).cast("double") / F.lit(98.0)).alias("confidence"),
    )


def prediction_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_log(table(spark, sf_dir, "events"))


def image_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return (
        table(spark, sf_dir, "documents")
        .select(
            "doc_id",
            F.concat(F.lit("v3_"), (doc % 12).cast("string")).alias("version"),
            F.when(doc % 5 < 2, F.lit("correct_predictions"))
            .otherwise(F.lit("incorrect_predictions"))
            .alias("outcome"),
            F.concat_ws(" ", "source", "lang").alias("class_name"),
        )
        .withColumn(
            "path",
            F.concat(
                F.concat_ws("/", "version", "outcome", "class_name"),
                F.lit("_"),
                doc.cast("string"),
                F.when(doc % 11 == 0, F.lit(".png")).otherwise(F.lit(".jpg")),
            ),
        )
    )


def label_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    good = F.concat(
        F.lit('{"model_label": "x", "api_label": "'), F.col("class_name"), F.lit('"}')
    )
    return (
        image_objects(spark, sf_dir)
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .select(
            "doc_id",
            F.concat(
                F.concat_ws("/", "version", "outcome", "class_name"),
                F.lit("_"),
                doc.cast("string"),
                F.lit("_labels.json"),
            ).alias("label_path"),
            F.when((F.col("toxic") == 1) & (F.col("quality") == 0), F.lit("{bad"))
            .when(doc % 13 == 0, F.lit('{"model_label": "x"}'))
            .otherwise(good)
            .alias("value"),
        )
    )


def _numbered(names: DataFrame) -> DataFrame:
    """Ids by name order (vocabulary-sized)."""
    order = Window.partitionBy(F.lit(0)).orderBy("class_name")
    return names.select("class_name", (F.row_number().over(order) - 1).cast("int").alias("label_id"))


def _class_names(documents: DataFrame) -> DataFrame:
    return documents.select(F.concat_ws(" ", "source", "lang").alias("class_name")).distinct()


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All class names."""
    return _numbered(_class_names(table(spark, sf_dir, "documents")))


def earlier_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary before the French classes came, for the queries about unknown labels."""
    return _numbered(_class_names(table(spark, sf_dir, "documents").filter(F.col("lang") != "fr")))


def stored_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label map as a stored table, so that joins know its size."""
    return stage(label_map(spark, sf_dir), "label-map")


def stored_earlier_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(earlier_label_map(spark, sf_dir), "label-map")


def label_map_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.to_json(label_map(spark, sf_dir))


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.concat(F.lit("v3_"), (F.col("o_custkey") % 12).cast("string")).alias("model_version"),
            F.col("o_orderpriority").alias("class_label"),
            (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("label_id"),
            month.alias("run_timestamp"),
        )
        .agg(F.count("*").alias("example_count"))
    )


def label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, key = F.col("p_name"), F.col("p_partkey") % 4
    swapped = F.concat_ws(
        "_", F.split_part(name, F.lit(" "), F.lit(2)), F.split_part(name, F.lit(" "), F.lit(1))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        name.alias("actual"),
        F.when(key == 0, F.replace(name, F.lit(" "), F.lit("_")))
        .when(key == 1, swapped)
        .when(key == 2, F.concat_ws(" ", name, "p_brand"))
        .otherwise(F.substring(name, F.lit(1), F.length(name) - 1))
        .alias("predicted"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten classes: softmax of the sums of every tenth dimension, so that all dimensions count."""

    def summed(c):
        # every tenth place from c on; a row of fewer places has an empty sum
        places = F.when(F.size("embedding") > c, F.sequence(c, F.size("embedding") - 1, F.lit(10)))
        total = F.aggregate(places, F.lit(0.0), lambda acc, i: acc + F.get("embedding", i).cast("double"))
        return F.exp(F.coalesce(total, F.lit(0.0)))

    weights = F.transform(F.sequence(F.lit(0), F.lit(9)), summed)

    def shares(e):
        total = F.aggregate(e, F.lit(0.0), lambda a, y: a + y)
        return let(total, lambda t: F.transform(e, lambda x: x / t))

    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", let(weights, shares).alias("scores")
    )


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = prediction_metrics(spark, sf_dir).withColumn(
        "ts", F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    )
    by = ["model_version", "ts"]
    return confusion.pack(confusion.build(log, by), by)


def _bitmap(vector: Column) -> Column:
    """A gray 8 x 8 image in the uncompressed bitmap format, from 64 numbers."""
    # fixed values of the format: file header, then size 8 x 8, 24 bits a pixel, no compression
    head = "424DF60000000000000036000000" "28000000" "08000000" "08000000" "01001800" "00000000" "C0000000" + "00" * 16
    # rows come from the bottom up, three equal bytes for each pixel
    rows = F.transform(F.sequence(F.lit(7), F.lit(0)), lambda r: F.substring(F.hex(vector), r * 16 + 1, F.lit(16)))
    return F.unhex(F.concat(F.lit(head), F.regexp_replace(F.array_join(rows, ""), "(..)", "$1$1$1")))


def as_image(vector: Column) -> Column:
    """All 64 numbers, stretched to bytes, as the pixels of an 8 x 8 gray image."""

    def pixels(v: Column) -> Column:
        span = F.struct(F.array_min(v).alias("low"), (F.array_max(v) - F.array_min(v)).alias("width"))

        def hexed(s: Column) -> Column:
            levels = F.transform(v, lambda x: F.floor((x - s["low"]) / s["width"] * 255).cast("int"))
            return F.transform(levels, lambda n: F.lpad(F.hex(n), 2, "0"))

        return F.unhex(F.array_join(let(span, hexed), ""))

    return let(F.transform(vector, lambda x: x.cast("double")), pixels)


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The object tree with contents ``(path, content)``: images, label documents and the label map.

    An image shows the embedding of its document's number modulo 500; every
    17th is broken.
    """
    # numbers that no remainder reaches need no bitmap
    shown = table(spark, sf_dir, "embeddings").where(F.col("vec_id").between(-499, 499)).select(
        "vec_id", _bitmap(as_image(F.col("embedding"))).alias("bitmap")
    )
    pictures = image_objects(spark, sf_dir).withColumn("vec_id", F.col("doc_id") % 500).join(shown, "vec_id")
    broken = F.lit("no image").cast("binary")
    return (
        pictures.select("path", F.when(F.col("doc_id") % 17 == 0, broken).otherwise(F.col("bitmap")).alias("content"))
        .unionByName(
            label_objects(spark, sf_dir).select(F.col("label_path").alias("path"), F.col("value").cast("binary").alias("content"))
        )
        .unionByName(
            vocabulary.to_json(earlier_label_map(spark, sf_dir)).toDF("value").select(
                F.lit("processed/metadata/label_map.json").alias("path"), F.col("value").cast("binary").alias("content")
            )
        )
    )
