"""Counts over alerts: rollups, timelines and pivots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.times import bucket, minutes_before, trunc
from netsift.schema import ATTACK_TYPES, BENIGN_NAMES, GENERIC_NAMES, HOURLY_SERIES
from netsift.sinks.tables import since as since_moment

TOP_IPS = 50


def attacks(alerts: DataFrame) -> DataFrame:
    """Alerts of an attack class; rows without a class are left out too."""
    return alerts.filter(~F.col("attack_type").isin(*BENIGN_NAMES))


def _count(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("cnt"))


def _hour() -> Column:
    return trunc("hour", F.col("timestamp")).alias("hour")


def _minute() -> Column:
    return trunc("minute", F.col("timestamp")).alias("minute")


def ranked(counts: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Largest counts first, ties by key (NULL last)."""
    ordered = counts.orderBy(F.desc("cnt"), F.asc_nulls_last(key))
    return ordered if limit is None else ordered.limit(limit)


def attack_distribution(alerts: DataFrame) -> DataFrame:
    return ranked(_count(attacks(alerts), "attack_type"), "attack_type")


def top_attack_ips(alerts: DataFrame, limit: int = TOP_IPS) -> DataFrame:
    return ranked(_count(attacks(alerts), "src_ip"), "src_ip", limit)


def attack_hourly(alerts: DataFrame) -> DataFrame:
    return _count(attacks(alerts), _hour(), "attack_type").orderBy(F.desc("hour"), "attack_type")


def protocol_stats(alerts: DataFrame) -> DataFrame:
    known = attacks(alerts).filter(F.col("protocol").isNotNull())
    return ranked(_count(known, "protocol"), "protocol")


def severity_timeline(alerts: DataFrame) -> DataFrame:
    known = attacks(alerts).filter(F.col("severity").isNotNull())
    return _count(known, _hour(), "severity").orderBy(F.desc("hour"), "severity")


def attack_cube(alerts: DataFrame, *keys: str) -> DataFrame:
    """Attack counts by hour, class, protocol and severity.

    A few thousand rows per month of data, from which every rollup but the one by
    address follows without reading the alerts again.
    """
    return _count(attacks(alerts), *keys, _hour(), "attack_type", "protocol", "severity")


def attack_ips(alerts: DataFrame, *keys: str) -> DataFrame:
    """Attack counts by source address."""
    return _count(attacks(alerts), *keys, "src_ip")


def rollups_from(cube: DataFrame, ips: DataFrame) -> dict[str, DataFrame]:
    """The five rollups, out of (partial) counts as made by :func:`attack_cube` and :func:`attack_ips`."""

    def summed(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("cnt").alias("cnt"))

    protocols = summed(cube.filter(F.col("protocol").isNotNull()), "protocol")
    severities = summed(cube.filter(F.col("severity").isNotNull()), "hour", "severity")
    return {
        "attack_distribution": ranked(summed(cube, "attack_type"), "attack_type"),
        "top_ips": ranked(summed(ips, "src_ip"), "src_ip", TOP_IPS),
        "attack_hourly": summed(cube, "hour", "attack_type").orderBy(F.desc("hour"), "attack_type"),
        "protocol_stats": ranked(protocols, "protocol"),
        "severity_timeline": severities.orderBy(F.desc("hour"), "severity"),
    }


# Keys that must be unique in each rollup.
ROLLUP_KEYS = {
    "attack_distribution": ("attack_type",),
    "top_ips": ("src_ip",),
    "attack_hourly": ("hour", "attack_type"),
    "protocol_stats": ("protocol",),
    "severity_timeline": ("hour", "severity"),
}


def top_types_all(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent classes, benign ones included."""
    return ranked(_count(alerts, "attack_type"), "attack_type", limit)


def top_ips_all(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent source addresses over all alerts."""
    return ranked(_count(alerts, "src_ip"), "src_ip", limit)


def attack_breakdown(alerts: DataFrame, limit: int = 10) -> DataFrame:
    """Named attack classes by count, without the generic class."""
    named = alerts.filter(~F.col("attack_type").isin(*GENERIC_NAMES))
    return ranked(_count(named, "attack_type"), "attack_type", limit)


def severity_distribution(alerts: DataFrame) -> DataFrame:
    known = attacks(alerts).filter(F.col("severity").isNotNull())
    return ranked(_count(known, "severity"), "severity")


def attack_timeline(alerts: DataFrame, as_of: Column | datetime, minutes: int) -> DataFrame:
    """Attacks per minute and class over the last ``minutes``, oldest first."""
    recent = since_moment(attacks(alerts), minutes_before(as_of, minutes))
    return _count(recent, _minute(), "attack_type").orderBy("minute", "attack_type")


def alert_rate(alerts: DataFrame) -> DataFrame:
    """Alerts per minute, benign ones included."""
    return _count(alerts, _minute()).orderBy("minute")


def rate_by_interval(alerts: DataFrame, seconds: int) -> DataFrame:
    """Alerts per bucket of any width."""
    return _count(alerts, bucket(F.col("timestamp"), seconds).alias("bucket")).orderBy("bucket")


def series_name(attack_type: str) -> str:
    return attack_type.lower().replace(" - ", "_").replace(" ", "_")


def _pivot(timeline: DataFrame, key: str, classes) -> DataFrame:
    wide = timeline.groupBy(key).pivot("attack_type", list(classes)).agg(F.sum("cnt"))
    return wide.toDF(key, *[series_name(c) for c in classes])


def timeline_pivot(timeline: DataFrame, last: int = 60) -> DataFrame:
    """Newest minutes of an attack timeline with one column per class, oldest first; 0 where nothing happened."""
    newest = _pivot(timeline, "minute", ATTACK_TYPES).orderBy(F.desc("minute")).limit(last)
    return newest.na.fill(0).orderBy("minute")


def hourly_pivot(hourly: DataFrame) -> DataFrame:
    """The four hourly series side by side; NULL where a series has no point."""
    drawn = hourly.filter(F.col("attack_type").isin(*HOURLY_SERIES))
    return _pivot(drawn, "hour", HOURLY_SERIES).orderBy("hour")
