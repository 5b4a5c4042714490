"""Joins on group keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``by`` with null equal to null, as grouping treats it; keys come from the left."""
    renamed = right.withColumnsRenamed({c: f"{c}__right" for c in by})
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}__right")) for c in by]
    )
    return left.join(renamed, same, how).drop(*[f"{c}__right" for c in by])
