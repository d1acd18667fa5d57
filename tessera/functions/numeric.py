"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cube(x: Column) -> Column:
    return x * x * x


def cube_root(x: Column) -> Column:
    """Real cube root (negative for negative input)."""
    return F.cbrt(x)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """round(100 * part / whole, digits); NULL when ``whole`` is 0."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def sum_of_cubes(values: Column) -> Column:
    """Sum of the cubes of an array's elements, in doubles and in their order; null
    elements are left out, an empty array gives 0 and a null one null."""
    cubes = F.transform(F.array_compact(values), lambda x: cube(x.cast("double")))
    return F.aggregate(cubes, F.lit(0.0), lambda total, x: total + x)
