"""Numeric column expressions that are safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, or 0.0 when the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def finite(value: Column) -> Column:
    """NaN and the infinities become 0.0; NULL stays NULL. (NaN sorts above every number.)"""
    return F.when(F.abs(value) >= INFINITY, F.lit(0.0)).otherwise(value)


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def as_int(text: Column) -> Column:
    """Text to INT; a fraction is cut off, anything unreadable is NULL."""
    return text.try_cast("double").try_cast("int")


def percent_1(value: Column) -> Column:
    """A 0..1 share as a percentage with one decimal, rounded half up on the decimal digits."""
    return F.round(value.cast("decimal(18,15)") * F.lit(100), 1).cast("double")


def band(value: Column, levels, default: str) -> Column:
    """The name of the first level whose threshold ``value`` exceeds."""
    expr = None
    for threshold, name in levels:
        hit, label = value > F.lit(threshold), F.lit(name)
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(F.lit(default))
