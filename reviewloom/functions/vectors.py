"""Vector columns held as ``array<float>`` or ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def dot(left: Column | str, right: Column | str) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(_col(left).cast("array<double>"), _col(right).cast("array<double>"), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column | str) -> Column:
    return F.sqrt(dot(vector, vector))


def l2_normalize(vector: Column | str) -> Column:
    """Unit-length vector; a zero vector has no direction and gives null."""
    norm = l2_norm(vector)
    return F.when(norm > 0, F.transform(_col(vector).cast("array<double>"), lambda x: x / norm))


def cosine(left: Column | str, right: Column | str) -> Column:
    """Cosine similarity; null when either vector is null or zero."""
    scale = l2_norm(left) * l2_norm(right)
    return F.when(scale > 0, dot(left, right) / scale)


def or_zero_vector(vector: Column | str, dim: int) -> Column:
    """Replace a missing or empty vector by zeros of the declared length."""
    value = _col(vector)
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return F.when(F.size(value) > 0, value.cast("array<float>")).otherwise(zeros)


def sigmoid(value: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(value)))
