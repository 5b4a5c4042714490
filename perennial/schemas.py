"""Fixed schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL_JSON = T.StructType(
    [
        T.StructField("model_label", T.StringType()),
        T.StructField("api_label", T.StringType()),
    ]
)

LABEL_MAP = T.StructType(
    [
        T.StructField("class_name", T.StringType(), False),
        T.StructField("label_id", T.IntegerType(), False),
    ]
)

TRAINING_EXAMPLE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("image", T.BinaryType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("n_channels", T.IntegerType()),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("label_path", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("class_name", T.StringType()),
        T.StructField("label", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)

CLASS_DISTRIBUTION = T.StructType(
    [
        T.StructField("model_version", T.StringType(), False, {"comment": "version trained on the examples"}),
        T.StructField("class_label", T.StringType(), False, {"comment": "name of the class"}),
        T.StructField("label_id", T.LongType(), False, {"comment": "id of the class"}),
        T.StructField("example_count", T.LongType(), False, {"comment": "examples of the class"}),
        T.StructField("run_timestamp", T.TimestampType(), False, {"comment": "start of the run"}),
    ]
)

PREDICTION_METRICS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("actual", T.StringType()),
        T.StructField("predicted", T.StringType()),
        T.StructField("is_correct", T.BooleanType()),
        T.StructField("latency", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("model_version", T.StringType()),
    ]
)

TRAINING_METRICS = T.StructType(
    [
        T.StructField("model_version", T.StringType(), False),
        T.StructField("accuracy", T.DoubleType(), False),
        T.StructField("top_k_accuracy", T.DoubleType(), False),
    ]
)

_SLOT = T.StructType(
    [
        T.StructField("model_version", T.StringType()),
        T.StructField("deployed_at", T.StringType()),
    ]
)
PROMOTION_STATE = T.StructType(
    [T.StructField("champion", _SLOT), T.StructField("challenger", _SLOT)]
)

DATASET_SIZE = T.StructType([T.StructField("dataset_size", T.LongType())])

# Warehouse names of the column types, as schema reports show them.
_TYPE_NAMES = {
    "string": "STRING",
    "boolean": "BOOLEAN",
    "tinyint": "INTEGER",
    "smallint": "INTEGER",
    "int": "INTEGER",
    "bigint": "INTEGER",
    "float": "FLOAT",
    "double": "FLOAT",
    "binary": "BYTES",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "DATETIME",
}


def warehouse_type(data_type: T.DataType) -> str:
    name = data_type.simpleString()
    return _TYPE_NAMES.get(name, name.upper())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; a null in a required column fails the job.

    The check sits in the projection, so it costs no pass of its own and stops
    the write before anything is committed.
    """

    def cell(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"required column {field.name} is null"))
            )
        return value.alias(field.name)

    return df.select(*[cell(f) for f in schema.fields])
