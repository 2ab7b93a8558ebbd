"""Address ranges: keys, pieces and lookups against brute force."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from netsift.config import GeoSettings
from netsift.functions.ip import with_ip_key
from netsift.operators import geo, ranges

RANGES = "ip_from string, ip_to string, latitude double, longitude double"


def number(text):
    address = ipaddress.ip_address(text)
    return int(address) if address.version == 6 else int(address) + (0xFFFF << 32)


def text_of(n):
    return str(ipaddress.IPv4Address(n - (0xFFFF << 32))) if n >> 32 == 0xFFFF else str(ipaddress.IPv6Address(n))


def innermost(n, rows):
    """The range that starts last, of these the one that ends first, of equal ones the smallest place."""
    held = [(-a, b, lat, lon) for a, b, lat, lon in rows if a <= n <= b]
    return min(held)[2:] if held else None


def test_keys(spark):
    texts = ["1.2.3.4", "::ffff:1.2.3.4", "10.1", "::", "2001:db8::1", "2001:DB8:0:0::0:1", "ffff:" * 7 + "ffff", "x", "", None, "1.2.3.4.5", ":::1"]
    df = with_ip_key(spark.createDataFrame([(t,) for t in texts], "ip string"), "ip", "key")
    got = [r["key"] and int.from_bytes(r["key"], "big") for r in df.collect()]
    known = [number("1.2.3.4")] * 2 + [number("10.0.0.1"), 0] + [number("2001:db8::1")] * 2 + [2**128 - 1]
    assert got == known + [None] * 5


def test_sweep_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        rows = []
        for _ in range(rng.randrange(12)):
            a = rng.randrange(60)
            rows.append((a, rng.randrange(a, 60), float(rng.randrange(5)), 0.0))
        low = rng.randrange(30)
        high = rng.randrange(low, 60)
        pieces = list(ranges.sweep(rows, low, high))
        assert all(a <= b for a, b, *_ in pieces) and all(p[1] < q[0] for p, q in zip(pieces, pieces[1:]))
        found = {n: (lat, lon) for a, b, lat, lon in pieces for n in range(a, b + 1)}
        assert found == {n: innermost(n, rows) for n in range(low, high + 1) if innermost(n, rows)}


@pytest.fixture(scope="module")
def world():
    """Nested, crossing, equal and single-address ranges of both versions, and addresses in and around them."""
    rng = random.Random(7)
    rows = []
    for base, width in ((number("10.0.0.0"), 2**24), (number("2001:db8::"), 2**80), (number("1.0.0.0"), 2**10)):
        for _ in range(60):
            a = base + rng.randrange(width)
            rows.append((a, min(a + rng.choice([0, 5, width // 50, width]), base + 2 * width), rng.randrange(80) * 1.0, 1.0))
    rows += [rows[0], (*rows[1][:2], 89.0, 3.0), (0, 2**128 - 1, 5.0, 6.0), (number("255.255.255.255"),) * 2 + (7.0, 8.0)]
    ends = [n for r in rows for n in (r[0], r[1], max(r[0] - 1, 0), min(r[1] + 1, 2**128 - 1))]
    numbers = ends + [rng.randrange(2**128) for _ in range(50)]
    return rows, sorted({text_of(n) for n in numbers})


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("block", [100_000, 20])
def test_lookups_equal_brute_force(spark, world, small, block, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK_ROWS", block)
    rows, texts = world
    table = spark.createDataFrame([(text_of(a), text_of(b), lat, lon) for a, b, lat, lon in rows], RANGES)
    df = spark.createDataFrame([(t,) for t in [*texts, texts[0], "no address", None]], "src_ip string")
    got = geo.geo_range_join(df, table, small=small).collect()
    assert len(got) == len(texts) + 3
    for r in got:
        place = innermost(number(r["src_ip"]), rows) if r["src_ip"] in texts else None
        assert (r["geo_source"] == "range") == (place is not None), r
        if place:
            assert (r["latitude"], r["longitude"]) == place, r


def test_numbers_and_bad_ranges(spark):
    rows = [(2**24, 2**24 + 9, 1.0, 1.0), (2**24 + 20, 2**24 + 10, 2.0, 2.0), (None, 5, 3.0, 3.0), (-5, 2**24 + 300, 4.0, 4.0), (0, 2**33, 4.0, 4.0)]
    table = spark.createDataFrame(rows, "ip_from long, ip_to long, latitude double, longitude double")
    df = spark.createDataFrame([("1.0.0.5",), ("1.0.0.15",), ("0.0.0.3",)], "src_ip string")
    got = {r["src_ip"]: r["geo_source"] for r in geo.geo_range_join(df, table).collect()}
    assert got == {"1.0.0.5": "range", "1.0.0.15": "hash", "0.0.0.3": "hash"}


def test_empty_sides(spark):
    table = spark.createDataFrame([("1.0.0.0", "1.0.0.9", 1.0, 1.0)], RANGES)
    df = spark.createDataFrame([("1.0.0.5",), (None,)], "src_ip string")
    for small in (True, False):
        got = sorted(r["geo_source"] for r in geo.geo_range_join(df, table.limit(0), small=small).collect())
        assert got == ["default", "hash"]
        assert geo.geo_range_join(df.limit(0), table, small=small).count() == 0


def test_size_is_always_checked(spark):
    table = spark.createDataFrame([(f"1.0.{i}.0", f"1.0.{i}.9", 1.0, 1.0) for i in range(20)], RANGES)
    assert ranges.RangeIndex.build(table, 20).table is not None
    assert ranges.RangeIndex.build(table, 19).table is None
    df = spark.createDataFrame([("1.0.3.5",), ("1.0.3.15",)], "src_ip string")
    few = GeoSettings(broadcast_rows=5)
    for small in (True, None):
        assert sorted(r["geo_source"] for r in geo.geo_range_join(df, table, geo=few, small=small).collect()) == ["hash", "range"]


def test_rows_do_not_move_in_memory(spark, folder):
    index = ranges.RangeIndex.build(spark.createDataFrame([("1.0.0.0", "1.0.0.9", 1.0, 1.0)], RANGES), 10)
    df = spark.range(10).select(F.format_string("1.0.0.%d", "id").alias("src_ip"))
    plan = geo.geo_range_join(df, index)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
