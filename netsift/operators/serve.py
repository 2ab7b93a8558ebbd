"""Serving queries over the alert, location and statistics tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.times import minutes_before, moment
from netsift.operators.rollups import attacks
from netsift.schema import LISTING
from netsift.sinks.tables import DATE
from netsift.sinks.tables import since as since_moment


def newest_first(df: DataFrame) -> DataFrame:
    """Total order: newest first, then the highest id."""
    return df.orderBy(F.desc("timestamp"), F.desc("flow_id"))


def latest_moment(df: DataFrame, column: str = "timestamp") -> Column:
    """The newest timestamp of a table, as a scalar subquery.

    In a table partitioned by date, only the newest date is read for it.
    """
    if DATE in df.columns:
        df = df.filter(F.col(DATE) == df.agg(F.max(DATE)).scalar())
    return df.agg(F.max(column)).scalar()


def alert_page(alerts: DataFrame, page: int = 0, size: int = 50) -> DataFrame:
    """One page of the listing. Costs grow with the page number; see :func:`alert_page_after`."""
    return newest_first(alerts.select(*LISTING)).offset(page * size).limit(size)


def alert_page_after(alerts: DataFrame, last_time: datetime, last_id: int, size: int = 50) -> DataFrame:
    """The page that follows the row (last_time, last_id); costs the same at any depth."""
    last = moment(last_time)
    after = (F.col("timestamp") < last) | ((F.col("timestamp") == last) & (F.col("flow_id") < last_id))
    # The first condition is implied, but lets the scan skip files by timestamp.
    rest = alerts.filter(F.col("timestamp") <= last).filter(after)
    return newest_first(rest.select(*LISTING)).limit(size)


def page_info(alerts: DataFrame, page: int = 0, size: int = 50) -> DataFrame:
    """Totals that go with a page."""
    pages = F.ceil(F.col("total_elements") / size).cast("bigint")
    return alerts.agg(F.count("*").alias("total_elements")).select(
        "total_elements",
        pages.alias("total_pages"),
        F.lit(page).cast("bigint").alias("number"),
        F.lit(size).cast("bigint").alias("size"),
    )


def alerts_where(alerts: DataFrame, column: str, value: str) -> DataFrame:
    """All alerts of one attack type or severity, newest first."""
    return newest_first(alerts.select(*LISTING).filter(F.col(column) == value))


def alerts_selected_types(alerts: DataFrame, selected: Iterable[str] | None) -> DataFrame:
    """Alerts of the selected types, newest first; None selects all."""
    rows = alerts.select(*LISTING)
    return newest_first(rows if selected is None else rows.filter(F.col("attack_type").isin(*selected)))


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("cnt"))


def recent_counts(alerts: DataFrame, as_of: Column | datetime, minutes: int = 60) -> DataFrame:
    """Alerts of the last hour and day, and high-severity ones of the last ``minutes``."""
    hour, day, window = (F.col("timestamp") >= minutes_before(as_of, m) for m in (60, 1_440, minutes))
    # Only the longest span is scanned, so the scan can skip older files.
    recent = since_moment(alerts, minutes_before(as_of, max(1_440, minutes)))
    return recent.agg(
        F.count_if(hour).alias("alerts_last_hour"),
        F.count_if(day).alias("alerts_last_24h"),
        F.count_if(window & (F.col("severity") == "high")).alias("high_severity"),
    )


def count_by_type(rows: DataFrame, attack_type: str) -> DataFrame:
    """Rows of one attack type, in the alert or the location table."""
    return rows.filter(F.col("attack_type") == attack_type).agg(F.count("*").alias("cnt"))


def unique_attackers(alerts: DataFrame) -> DataFrame:
    return attacks(alerts).agg(F.countDistinct("src_ip").alias("cnt"))


def approx_attackers(alerts: DataFrame, error: float = 0.02) -> DataFrame:
    """Like :func:`unique_attackers` in constant memory, for streams."""
    return attacks(alerts).agg(F.approx_count_distinct("src_ip", error).alias("cnt"))


def attack_types(alerts: DataFrame) -> DataFrame:
    """The attack types that occur."""
    return attacks(alerts).select("attack_type").distinct().orderBy("attack_type")


def recent_alerts(alerts: DataFrame, limit: int = 25) -> DataFrame:
    """The newest alerts in six columns."""
    newest = newest_first(alerts.select(*LISTING)).limit(limit)
    return newest.select("flow_id", "timestamp", "attack_type", "src_ip", "dst_ip", "protocol", "severity")


def geo_recent(geo_rows: DataFrame, limit: int = 500) -> DataFrame:
    """The newest locations."""
    return newest_first(geo_rows).limit(limit)


def geo_since(geo_rows: DataFrame, since: Column | datetime) -> DataFrame:
    """Locations since a moment, newest first."""
    return newest_first(since_moment(geo_rows, moment(since)))


def geo_after_batch(geo_rows: DataFrame, batch_id: int) -> DataFrame:
    """Locations written after a batch. Unlike a clock, batch numbers miss no row that is written late."""
    return geo_rows.filter(F.col("batch_id") > batch_id)
