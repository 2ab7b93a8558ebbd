"""Time buckets on TIMESTAMP_NTZ columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc(unit: str, when: Column) -> Column:
    """``date_trunc`` that keeps the column's zoneless type."""
    return F.date_trunc(unit, when).cast("timestamp_ntz")


def bucket(when: Column, seconds: int) -> Column:
    """Start of the ``seconds``-wide bucket, counted from the epoch."""
    epoch = F.unix_micros(when.cast("timestamp"))
    width = F.lit(seconds * 1_000_000)
    return F.timestamp_micros(epoch - F.pmod(epoch, width)).cast("timestamp_ntz")


def moment(as_of: Column | datetime) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


def minutes_before(as_of: Column | datetime, minutes: int) -> Column:
    return moment(as_of) - F.make_dt_interval(mins=F.lit(minutes))


def wire_time(when: Column) -> Column:
    """ISO-8601 instant with microseconds, as carried in flow records."""
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def read_wire_time(text: Column) -> Column:
    return text.try_cast("timestamp").cast("timestamp_ntz")
