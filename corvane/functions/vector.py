"""Vectors as arrays; sums are doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column) -> Column:
    size = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: x.cast("double") / size)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(1e-12)) * F.greatest(norm(b), F.lit(1e-12)))


def squared_l2(a: Column, b: Column) -> Column:
    return dot(a, a) + dot(b, b) - F.lit(2.0) * dot(a, b)
