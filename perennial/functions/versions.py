"""Version strings ``v<major>_<minor>``; always ordered as numbers, never as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def job_version(version: str) -> tuple[str, int]:
    """Split the version a job was started with, e.g. ``v3_10`` into ``("v3", 10)``."""
    parts = version.split("_")
    if len(parts) != 2:
        raise ValueError(f"version {version!r} is not of the form v<major>_<minor>")
    return parts[0], int(parts[1])


def strict(version: Column) -> Column:
    """The same split of a column as a struct ``prefix, number``; null fields for other spellings."""
    parts = F.split(version, "_")
    number = F.get(parts, F.lit(1)).try_cast("int")
    good = (F.size(parts) == 2) & number.isNotNull()
    return F.struct(
        F.when(good, F.get(parts, F.lit(0))).alias("prefix"), F.when(good, number).alias("number")
    )


def major(version: Column) -> Column:
    """Leading ``v(digits)_(digits)``; text after it is allowed. Null when absent."""
    return F.regexp_extract(version, r"^v(\d+)_(\d+)", 1).try_cast("int")


def minor(version: Column) -> Column:
    return F.regexp_extract(version, r"^v(\d+)_(\d+)", 2).try_cast("int")


def directory_number(version: Column) -> Column:
    """Second ``_`` field of a directory name as a number, null when malformed."""
    return F.substring_index(F.substring_index(version, "_", 2), "_", -1).try_cast("int")


def is_earlier(version: Column, current: str) -> Column:
    """True for directories of the same major whose number is below the current one."""
    prefix, number = job_version(current)
    return F.startswith(version, F.lit(prefix + "_")) & F.coalesce(
        directory_number(version) < F.lit(number), F.lit(False)
    )


def next_version(version: Column) -> Column:
    """Same major, minor plus one; null when the text is not a version."""
    parts = F.split(F.btrim(version, F.lit("v")), "_")
    first = F.get(parts, F.lit(0)).try_cast("int")
    second = F.get(parts, F.lit(1)).try_cast("int")
    return F.when(
        (F.size(parts) == 2) & first.isNotNull() & second.isNotNull(),
        F.concat(F.lit("v"), first.cast("string"), F.lit("_"), (second + 1).cast("string")),
    )


def training_mode(previous: Column) -> Column:
    """``warm_start`` only from a parsable version other than the base one."""
    base = (major(previous) == 3) & (minor(previous) == 0)
    return F.when(major(previous).isNull() | base, F.lit("new")).otherwise(F.lit("warm_start"))


# Accepted spelling of the job parameters.
VERSION_ID = "^[a-zA-Z0-9_-]+$"
WHOLE_NUMBER = "^[0-9]+$"


def is_valid_id(value: Column) -> Column:
    return F.coalesce(value.rlike(VERSION_ID), F.lit(False))


def is_whole_number(value: Column) -> Column:
    return F.coalesce(value.rlike(WHOLE_NUMBER), F.lit(False))
