"""Score vectors and pixel arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perennial.functions.binding import let

# Fixed value: probabilities are clipped to [EPSILON, 1 - EPSILON] before the logarithm.
EPSILON = 1e-7


def best_index(scores: Column) -> Column:
    """Position of the largest score; the first one wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def best_score(scores: Column) -> Column:
    return F.array_max(scores)


def is_top_1(scores: Column, label: Column) -> Column:
    return best_index(scores) == label


def is_top_k(scores: Column, label: Column, k: int = 5) -> Column:
    """Fewer than ``k`` scores are strictly above the true one."""
    return let(F.get(scores, label), lambda t: F.size(F.filter(scores, lambda x: x > t)) < k)


def cross_entropy(scores: Column, label: Column) -> Column:
    p = F.get(scores, label)
    return -F.ln(F.greatest(F.least(p, F.lit(1 - EPSILON)), F.lit(EPSILON)))


def to_unit_range(pixels: Column) -> Column:
    """Pixel values 0..255 to -1..1."""
    return F.transform(pixels, lambda x: x / F.lit(127.5) - F.lit(1.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, p: acc + p)
