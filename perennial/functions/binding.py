"""Evaluate an expression once inside higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression used inside a lambda is evaluated for every element; a lambda
    variable holds its value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
