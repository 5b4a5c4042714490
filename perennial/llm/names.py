"""Column names that cannot clash with those of the input, compared without case as Spark does."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(taken: Iterable[str]) -> Iterator[str]:
    """Names that none of ``taken`` bears."""
    used = {name.lower() for name in taken}
    number = 0
    while True:
        name = f"c{number}_"
        number += 1
        if name not in used:
            yield name


def without(df: DataFrame, made: Iterable[str]) -> DataFrame:
    """``df`` without the columns that made ones replace."""
    gone = {name.lower() for name in made}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def aside(df: DataFrame, internal: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that bear an internal name renamed, and how to rename them back."""
    used = {name.lower() for name in internal}
    spare = fresh([*df.columns, *used])
    back = {next(spare): c for c in df.columns if c.lower() in used}
    return df.withColumnsRenamed({own: name for name, own in back.items()}), back
