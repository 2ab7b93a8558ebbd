"""Data-quality profiles of flow and training tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.schema import LABEL

# Columns looked at by the profiles.
CHECKED = ("flow_bytes_per_sec", "syn_flag_count", "flow_duration", "total_fwd_packets", LABEL)
PROFILED = ("flow_bytes_per_sec", "syn_flag_count")
CLASS_PROFILED = (
    "flow_bytes_per_sec", "flow_packets_per_sec", "syn_flag_count",
    "flow_duration", "total_fwd_packets", "total_backward_packets",
)


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(LABEL).agg(F.count("*").alias("cnt"))


def feature_profile(df: DataFrame, columns: Iterable[str] = PROFILED) -> DataFrame:
    """Smallest, largest and mean value of each column, in one pass."""
    parts = [
        f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max), ("avg", F.avg))
    ]
    return df.agg(*parts)


def class_profile(df: DataFrame, columns: Iterable[str] = CLASS_PROFILED) -> DataFrame:
    """Mean and sample standard deviation of each column per label."""
    parts = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("avg", F.avg), ("std", F.stddev))]
    return df.filter(F.col(LABEL).isNotNull()).groupBy(LABEL).agg(*parts)


def null_counts(df: DataFrame, columns: Iterable[str] = CHECKED) -> DataFrame:
    """NULLs per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def nonnull_counts(df: DataFrame, columns: Iterable[str] = CHECKED) -> DataFrame:
    """Non-NULL values per column and all rows, in one pass."""
    return df.agg(*[F.count(c).alias(c) for c in columns], F.count("*").alias("total"))


def nonnull_sample(df: DataFrame, column: str = "flow_bytes_per_sec", limit: int = 5) -> DataFrame:
    """A few rows in which a column is set: those with the smallest ids."""
    return df.filter(F.col(column).isNotNull()).orderBy("flow_id").limit(limit)


def missing_addresses(df: DataFrame) -> DataFrame:
    """Rows whose source or destination address is NULL or empty."""

    def absent(c: str):
        return F.coalesce(F.col(c) == "", F.lit(True))

    return df.agg(
        F.count_if(absent("src_ip")).alias("missing_src_ip"), F.count_if(absent("dst_ip")).alias("missing_dst_ip")
    )
