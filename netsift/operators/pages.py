"""Pages of the alert listing at any depth.

A directory counts the alerts of each minute. The counts tell in which minutes a
page lies and how many rows of them come before it, so only those minutes are read,
however deep the page is. Minutes and dates are read from the newest on, as listed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions.times import moment, trunc
from netsift.operators.serve import newest_first
from netsift.schema import LISTING
from netsift.sinks.tables import DATE


def minute_counts(alerts: DataFrame, *keys: str) -> DataFrame:
    """Alerts of each minute: the page directory, or a part of it for one batch."""
    minute = trunc("minute", F.col("timestamp"))
    return alerts.groupBy(*keys, minute.alias("minute")).agg(F.count("*").alias("cnt"))


@dataclass(frozen=True)
class Span:
    """Minutes in which a page lies (``oldest`` to ``newest``), and the rows of them that come before it."""

    oldest: datetime
    newest: datetime
    skip: int


def _cut(counts: list[tuple], skip: int, size: int) -> tuple[list, int]:
    """Of (key, count) in listing order, the keys that rows skip to skip + size lie in, and the rows to skip in them."""
    found, left = [], None
    for key, n in counts:
        if skip + size <= 0:
            break
        if skip < n:
            left = max(skip, 0) if left is None else left
            found.append(key)
        skip -= n
    return found, left or 0


def page_span(directory: DataFrame, offset: int, size: int) -> Span | None:
    """Where the rows from ``offset`` on lie; None beyond the last row.

    Two small reads: a count for each date, then one for each minute of the dates
    that the page touches, of which there are ``size`` at most.
    """
    day = F.col("minute").cast("date")
    days = directory.groupBy(day.alias("day")).agg(F.sum("cnt").alias("n")).orderBy(F.desc_nulls_last("day")).collect()
    touched, skip = _cut([(r["day"], r["n"]) for r in days], offset, size)
    if not touched:
        return None
    inside = directory.filter(day.between(F.lit(touched[-1]), F.lit(touched[0])))
    minutes = inside.groupBy("minute").agg(F.sum("cnt").alias("n")).orderBy(F.desc("minute")).collect()
    found, skip = _cut([(r["minute"], r["n"]) for r in minutes], skip, size)
    return Span(found[-1], found[0], skip)


def alert_page_deep(alerts: DataFrame, directory: DataFrame, page: int = 0, size: int = 50) -> DataFrame:
    """One page of the listing, as :func:`netsift.operators.serve.alert_page` gives it, out of the page's minutes.

    ``directory`` (:func:`minute_counts`, or the sum of its parts) must count the same
    alerts. What is read and sorted is bounded by the page and its busiest minute.
    """
    span = page_span(directory, page * size, size)
    rows = alerts if span else alerts.limit(0)
    if span:
        end = span.newest + timedelta(minutes=1)
        if DATE in alerts.columns:
            rows = rows.filter(F.col(DATE).between(F.lit(span.oldest.date()), F.lit(span.newest.date())))
        rows = rows.filter((F.col("timestamp") >= moment(span.oldest)) & (F.col("timestamp") < moment(end)))
    return newest_first(rows.select(*LISTING)).offset(span.skip if span else 0).limit(size)
