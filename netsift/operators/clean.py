"""Cleaning of feature columns. Each variant is one projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.numbers import INFINITY, finite
from netsift.schema import BENIGN_NAMES, FEATURES, LABEL, RATE_FEATURES


def _apply(df: DataFrame, columns, rule: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: rule(F.col(c)) for c in columns})


def add_missing_features(df: DataFrame) -> DataFrame:
    """Add every absent feature column as 0.0."""
    present = set(df.columns)
    missing = {c: F.lit(0.0) for c in FEATURES if c not in present}
    return df.withColumns(missing) if missing else df


def fill_nulls(df: DataFrame) -> DataFrame:
    """NULL to 0.0 in all features but the two rates; NaN and the infinities stay."""
    return _apply(df, [c for c in FEATURES if c not in RATE_FEATURES], lambda c: F.coalesce(c, F.lit(0.0)))


def fill_rates(df: DataFrame) -> DataFrame:
    """NULL and +Infinity to 0.0 in the two rates; NaN and -Infinity stay."""
    return _apply(
        df, RATE_FEATURES, lambda c: F.when(c.isNull() | (c == F.lit(INFINITY)), F.lit(0.0)).otherwise(c)
    )


def clean_stream(df: DataFrame) -> DataFrame:
    """The streaming variant: missing columns, NULLs and infinite rates."""
    return fill_rates(fill_nulls(add_missing_features(df)))


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and the infinities to 0.0; NULL stays."""
    return _apply(df, FEATURES, finite)


def clean_all(df: DataFrame) -> DataFrame:
    """NULL, NaN and the infinities to 0.0, in every feature; absent features are added.

    One list of SQL expressions: a stream builds this plan for every micro-batch,
    and building it column by column takes longer than running it.
    """
    present = df.columns
    kept = [f"`{c}`" for c in present if c not in FEATURES]
    cleaned = [
        f"CASE WHEN abs({c}) < double('Infinity') THEN {c} ELSE 0D END AS {c}" if c in present else f"0D AS {c}"
        for c in FEATURES
    ]
    return df.selectExpr(*kept, *cleaned)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column."""
    return df.na.drop()


def label_text(df: DataFrame) -> DataFrame:
    """Labelled rows with ``label`` Attack/Normal instead of the numeric label."""
    return (
        df.filter(F.col(LABEL).isNotNull())
        .withColumn("label", F.when(F.col(LABEL) == 1.0, "Attack").otherwise("Normal"))
        .drop(LABEL)
    )


def binary_label(df: DataFrame) -> DataFrame:
    """Free-form class names to Attack/Normal; rows without a class are dropped."""
    benign = F.trim("label").isin(*BENIGN_NAMES)
    return df.filter(F.col("label").isNotNull()).withColumn(
        "label", F.when(benign, "Normal").otherwise("Attack")
    )


def training_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Features and label of the labelled rows, after the columns in ``keep``."""
    return df.filter(F.col(LABEL).isNotNull()).select(*keep, *FEATURES, LABEL)
