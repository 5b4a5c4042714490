"""JSON and time formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_label_json(value: Column) -> Column:
    """Strict parse of a label document: ``(valid, model_label, api_label)``.

    One parse serves all three; broken text gives ``valid = false`` and nulls.
    Spark's parser stops after the first value, so the text is parsed as the only
    element of an array: anything after the document then shows.
    """
    docs = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    valid = (
        F.try_variant_get(docs, "$[0]", "variant").isNotNull()
        & F.try_variant_get(docs, "$[1]", "variant").isNull()
    )

    def field(name: str) -> Column:
        return F.when(valid, F.try_variant_get(docs, f"$[0].{name}", "string")).alias(name)

    return F.struct(valid.alias("valid"), field("model_label"), field("api_label"))


def label_json(model_label: Column, api_label: Column) -> Column:
    return F.to_json(F.struct(model_label.alias("model_label"), api_label.alias("api_label")))


def run_name(prefix: str, at: Column) -> Column:
    """``prefix-YYYYMMDD-HHMMSS`` in lower case."""
    return F.lower(F.concat(F.lit(prefix + "-"), F.date_format(at, "yyyyMMdd-HHmmss")))


def hour_folder(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd-HH")


def experiment_name(version: Column) -> Column:
    return F.replace(version, F.lit("_"), F.lit("-"))


def rfc3339(at: Column) -> Column:
    """UTC text of a timestamp, with microseconds and a closing ``Z``."""
    utc = F.to_utc_timestamp(at, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def deployed_text(at: Column) -> Column:
    """ISO time with a closing ``Z``; microseconds only where there are any."""
    seconds = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.date_format(at, "SSSSSS") != "000000", F.date_format(at, ".SSSSSS")).otherwise("")
    return F.concat(seconds, fraction, F.lit("Z"))


def percent(ratio: Column) -> Column:
    """Percentage with two places, half to even; an absent ratio is 0."""
    return F.coalesce(F.bround(ratio * 100, 2), F.lit(0.0))
