"""Object paths: ``{version}/{outcome}/{label}_{suffix}.jpg`` and its label file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CORRECT = "correct_predictions"
INCORRECT = "incorrect_predictions"
IMAGE_SUFFIX = ".jpg"
LABEL_SUFFIX = "_labels.json"


def version_of(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def outcome_of(path: Column) -> Column:
    return F.substring_index(F.substring_index(path, "/", 2), "/", -1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """Base name up to its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def label_in_name(path: Column) -> Column:
    """Base name up to its first underscore; spaces belong to the label."""
    return F.substring_index(base_name(path), "_", 1)


def label_path(image_path: Column) -> Column:
    """Every ``.jpg`` in the path becomes the label suffix."""
    return F.replace(image_path, F.lit(IMAGE_SUFFIX), F.lit(LABEL_SUFFIX))


def is_image(path: Column) -> Column:
    return F.endswith(path, F.lit(IMAGE_SUFFIX))


def is_label_file(path: Column) -> Column:
    return F.endswith(path, F.lit(LABEL_SUFFIX))


def is_json(path: Column) -> Column:
    return F.endswith(F.lower(path), F.lit(".json"))


def label_in_url(url: Column) -> Column:
    """Fifth ``/`` field of an image address, hyphens as spaces."""
    return F.replace(F.split_part(url, F.lit("/"), F.lit(5)), F.lit("-"), F.lit(" "))


def as_utc(ts: Column) -> Column:
    """A zone-less timestamp read as UTC, whatever the session zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def outcome_for(is_correct: Column) -> Column:
    return F.when(is_correct, F.lit(CORRECT)).otherwise(F.lit(INCORRECT))


def stored_stem(
    version: Column, is_correct: Column, predicted: Column, actual: Column, at: Column, row_id: Column
) -> Column:
    """Where a scored image is kept, without its suffix.

    Seconds alone collide, so the row id is appended.
    """
    label = F.when(is_correct, predicted).otherwise(actual)
    name = F.concat_ws(
        "_", label, F.unix_seconds(at).cast("string"), row_id.cast("string")
    )
    return F.concat_ws("/", version, outcome_for(is_correct), name)
