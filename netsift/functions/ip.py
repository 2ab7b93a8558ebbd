"""IP literals as column expressions: numbers, groups and the derived hash.

Everything is built from Spark functions. Only literals are read; names are never
resolved.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_V4_TEXT = 15


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _number(ip: Column, parts: Column) -> Column:
    n = F.size(parts)
    a, b, c, d = (F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4))
    # With fewer than four parts, the last one fills the remaining bytes: 10.1 is 10.0.0.1.
    full = F.when(F.greatest(a, b, c, d) <= 255, ((a * 256 + b) * 256 + c) * 256 + d)
    three = F.when((F.greatest(a, b) <= 255) & (c < 65_536), (a * 256 + b) * 65_536 + c)
    two = F.when((a <= 255) & (b < 16_777_216), a * 16_777_216 + b)
    one = F.when(a < 4_294_967_296, a)
    number = F.when(n == 4, full).when(n == 3, three).when(n == 2, two).when(n == 1, one)
    return F.when((F.length(ip) <= MAX_V4_TEXT) & ip.rlike(r"^\d+(\.\d+){0,3}$"), number)


def ipv4_number(ip: Column) -> Column:
    """IPv4 literal to BIGINT, else NULL."""
    return _let(F.split(ip, "[.]"), lambda parts: _number(ip, parts))


def with_ipv4_number(df: DataFrame, ip: str, into: str) -> DataFrame:
    """:func:`ipv4_number` as a column, in two projections that stay in generated code."""
    parts = df.withColumn("_parts", F.split(ip, "[.]"))
    return parts.withColumn(into, _number(F.col(ip), F.col("_parts"))).drop("_parts")


def _hash_v4(number: Column) -> Column:
    octets = [F.shiftrightunsigned(number, s).bitwiseAND(F.lit(255)) for s in (24, 16, 8, 0)]
    return ((octets[0] * 31 + octets[1]) * 31 + octets[2]) * 31 + octets[3]


def _wrap32(value: Column) -> Column:
    """The value that a signed 32-bit integer would hold."""
    return F.pmod(value + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)


def _hex_tail(ip: Column) -> Column:
    """The address with a dotted tail written as two groups; NULL if the tail is no full IPv4 literal."""
    tail = F.regexp_extract(ip, r"([^:]*)$", 1)

    def rewritten(number: Column) -> Column:
        groups = [F.hex(F.shiftrightunsigned(number, 16)), F.hex(number.bitwiseAND(F.lit(65_535)))]
        return F.concat(F.regexp_replace(ip, r"[^:]*$", ""), groups[0], F.lit(":"), groups[1])

    return F.when(tail.rlike(r"^\d+(\.\d+){3}$"), _let(ipv4_number(tail), rewritten))


def _side(halves: Column, i: int) -> Column:
    text = F.coalesce(F.get(halves, F.lit(i)), F.lit(""))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def _filled(halves: Column) -> Column:
    """Eight groups as text, from the parts left and right of ``::``."""

    def join(sides: Column) -> Column:
        left, right = F.get(sides, F.lit(0)), F.get(sides, F.lit(1))
        missing = F.lit(8) - F.size(left) - F.size(right)
        full = F.concat(left, F.array_repeat(F.lit("0"), missing), right)
        return F.when((F.size(halves) == 2) & (missing >= 1), full).when(
            (F.size(halves) == 1) & (missing == 0), left
        )

    return _let(F.array(_side(halves, 0), _side(halves, 1)), join)


def ipv6_groups(ip: Column) -> Column:
    """IPv6 literal to an array of eight 16-bit numbers, else NULL."""
    text = F.when(F.contains(ip, F.lit(".")), _hex_tail(ip)).otherwise(ip)
    whole = _let(F.split(text, "::", -1), _filled)
    one = lambda g: F.when(g.rlike("^[0-9a-fA-F]{1,4}$"), F.conv(g, 16, 10).try_cast("bigint"))
    numbers = _let(
        F.transform(whole, one), lambda a: F.when(F.forall(a, lambda g: g.isNotNull()), a)
    )
    return F.when(F.contains(ip, F.lit(":")), numbers)


def _hash_groups(groups: Column) -> Column:
    """Hash over sixteen bytes; an IPv4-mapped address counts as its four bytes."""

    def step(acc: Column, group: Column) -> Column:
        high = _wrap32(acc * 31 + F.shiftrightunsigned(group, 8))
        return _wrap32(high * 31 + group.bitwiseAND(F.lit(255)))

    mapped = F.forall(F.slice(groups, 1, 5), lambda g: g == 0) & (F.get(groups, F.lit(5)) == 65_535)
    v4 = F.get(groups, F.lit(6)) * 65_536 + F.get(groups, F.lit(7))
    return F.when(mapped, _hash_v4(v4)).otherwise(F.aggregate(groups, F.lit(0).cast("bigint"), step))


def ipv6_hash(ip: Column) -> Column:
    return _let(ipv6_groups(ip), _hash_groups)


@lru_cache
def _ipv6_hash_of(application: str, ip: str) -> Column:
    """The expression is long to build and does not depend on the data, so a stream builds it once."""
    return F.when(F.contains(F.col(ip), F.lit(":")), ipv6_hash(F.col(ip)))


def with_ip_hash(df: DataFrame, ip: str, into: str) -> DataFrame:
    """Add the signed 32-bit rolling hash (factor 31) over the address bytes; NULL for anything but a literal."""
    numbered = with_ipv4_number(df, ip, "_v4")
    v6 = _ipv6_hash_of(df.sparkSession.sparkContext.applicationId, ip)
    return numbered.withColumn(into, F.coalesce(_hash_v4(F.col("_v4")), v6)).drop("_v4")


def _hex(number: Column, digits: int) -> Column:
    return F.lpad(F.hex(number), digits, "0")


@lru_cache
def _ipv6_hex_of(application: str, ip: str) -> Column:
    groups = F.array_join(F.transform(ipv6_groups(F.col(ip)), lambda g: _hex(g, 4)), "")
    return F.when(F.contains(F.col(ip), F.lit(":")), F.when(F.length(groups) == 32, groups))


def with_ip_key(df: DataFrame, ip: str, into: str) -> DataFrame:
    """Add the address as 16 bytes in the order of the addresses, IPv4 in its mapped block; NULL for anything but a literal."""
    numbered = with_ipv4_number(df, ip, "_v4")
    v6 = _ipv6_hex_of(df.sparkSession.sparkContext.applicationId, ip)
    v4 = F.concat(F.lit("0" * 20 + "FFFF"), _hex(F.col("_v4"), 8))
    return numbered.withColumn(into, F.unhex(F.coalesce(v4, v6))).drop("_v4")
