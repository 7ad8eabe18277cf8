"""Scalar and array formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def log_loss(z: Column, y: Column) -> Column:
    """Loss of one row with score ``z`` and label ``y`` in {0, 1}."""
    p = sigmoid(z)
    return F.when(y == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def angle(a: Column, b: Column) -> Column:
    """Angle in radians; rounding may push the cosine past 1, hence the clamp."""
    cosine = dot(a, b) / (norm(a) * norm(b))
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def linear_score(cols: list[Column], weights: list[float], bias: float) -> Column:
    """``bias + sum(w * x)`` over plain columns."""
    total = F.lit(float(bias))
    for c, w in zip(cols, weights):
        total = total + c.cast("double") * F.lit(float(w))
    return total
