"""Column functions: addresses, numbers, names and times."""

import datetime
import ipaddress
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from netsift.functions import names, numbers, times
from netsift.functions.ip import with_ip_hash, with_ipv4_number
from netsift.operators.geo import geo_hash


def wrapped_hash(data: bytes) -> int:
    value = 0
    for byte in data:
        value = (value * 31 + byte + 2**31) % 2**32 - 2**31
    return value


def expected_hash(text: str) -> int:
    address = ipaddress.ip_address(text)
    mapped = getattr(address, "ipv4_mapped", None)
    return wrapped_hash((mapped or address).packed)


def hashes(spark, texts):
    df = with_ip_hash(spark.createDataFrame([(t,) for t in texts], "ip string"), "ip", "h")
    return {r["ip"]: r["h"] for r in df.collect()}


def test_hash_of_random_addresses(spark):
    rng = random.Random(7)
    texts = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(500)]
    for _ in range(500):
        address = ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128) & rng.getrandbits(128))
        texts += [str(address), address.exploded]
    # Runs of zero groups, to get every form of "::".
    for _ in range(300):
        start, length = rng.randrange(8), rng.randrange(1, 8)
        groups = [0 if start <= i < start + length else rng.randrange(1, 65536) for i in range(8)]
        texts.append(str(ipaddress.IPv6Address(sum(g << (16 * (7 - i)) for i, g in enumerate(groups)))))
    assert hashes(spark, texts) == {t: expected_hash(t) for t in texts}


def test_hash_of_special_forms(spark):
    texts = ["::", "::1", "1::", "::ffff:192.168.1.100", "::FFFF:c0a8:164", "64:ff9b::10.1.2.3", "FE80::1"]
    assert hashes(spark, texts) == {t: expected_hash(t) for t in texts}


def test_short_ipv4_forms(spark):
    df = spark.createDataFrame([(t,) for t in ("10.1", "10.1.2", "167772161", "1.2.3.4")], "ip string")
    got = {r["ip"]: r["n"] for r in with_ipv4_number(df, "ip", "n").collect()}
    assert got == {
        "10.1": 10 * 2**24 + 1, "10.1.2": 10 * 2**24 + 2**16 + 2, "167772161": 167772161, "1.2.3.4": 16909060
    }


@pytest.mark.parametrize(
    "text",
    ["", "not-an-ip", "1.2.3", "256.1.1.1", "1.2.3.4.5", "1.2.3.-4", ":", ":::", "1::2::3", "1:2:3:4:5:6:7:8:9",
     "1:2:3:4:5:6:7::8", "12345::", "::1.2.3", "::1.2.3.400", "g::", "1:2", "1.2.3.4:80"],
)
def test_unreadable_addresses(spark, text):
    readable = text == "1.2.3"  # a short form
    assert (hashes(spark, [text])[text] is not None) == readable


def test_missing_address(spark):
    assert hashes(spark, [None]) == {None: None}


def test_known_locations(spark):
    df = spark.createDataFrame([("0.0.0.0",), ("192.168.1.100",), ("not-an-ip",), (None,)], "src_ip string")
    got = {r["src_ip"]: (round(r["latitude"], 4), round(r["longitude"], 4), r["geo_source"]) for r in geo_hash(df).collect()}
    assert got == {
        "0.0.0.0": (33.5731, -7.5898, "hash"),
        "192.168.1.100": (35.0241, -6.7498, "hash"),
        "not-an-ip": (33.5731, -7.5898, "default"),
        None: (33.5731, -7.5898, "default"),
    }


def test_negative_hash_truncates_toward_zero(spark):
    texts = [f"{4096 + 97 * i:x}:db8::{i:x}" for i in range(200)]
    df = geo_hash(spark.createDataFrame([(t,) for t in texts], "src_ip string"))
    negative = 0
    for row in df.collect():
        h = expected_hash(row["src_ip"])
        negative += h < 0
        sign = -1 if h < 0 else 1
        lat = 33.5731 + sign * (abs(h) % 7000) / 1000
        lon = -7.5898 + sign * (abs(h) // 7000 % 7000) / 1000
        assert row["latitude"] == pytest.approx(lat, abs=1e-9)
        assert row["longitude"] == pytest.approx(lon, abs=1e-9)
    assert negative


@pytest.mark.parametrize(
    "title, name",
    [
        (" Flow Bytes/s", "flow_bytes_per_sec"),
        ("Flow Packets/s", "flow_packets_per_sec"),
        ("Init_Win_bytes_forward", "init_win_bytes_forward"),
        ("Average Packet Size\r", "avg_packet_size"),
        (" Label", "label"),
        ("__Fwd  Header.Length__", "fwd_header_length"),
    ],
)
def test_column_names(title, name):
    assert names.normalize_all([title]) == [name]


def test_colliding_names_stay_apart():
    assert names.normalize_all(["Fwd Header Length", "fwd header-length", "FWD_HEADER_LENGTH"]) == [
        "fwd_header_length", "fwd_header_length_2", "fwd_header_length_3"
    ]


@given(st.text(max_size=30))
def test_normalised_names_are_stable(text):
    once = names.normalize(text)
    assert names.normalize(once) == once
    assert set(once) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")
    assert "__" not in once and once == once.strip("_")


def test_lenient_casts(spark):
    df = spark.createDataFrame([("80.5",), ("abc",), ("7",), (None,), ("1e400",)], "t string")
    got = df.select(numbers.as_int(F.col("t")).alias("i"), numbers.as_double(F.col("t")).alias("d")).collect()
    assert [r["i"] for r in got] == [80, None, 7, None, None]
    assert [r["d"] for r in got] == [80.5, None, 7.0, None, float("inf")]


def test_percent_rounds_half_up_on_digits(spark):
    df = spark.createDataFrame([(0.9725,), (0.97249,), (1.0,), (0.0005,)], "x double")
    assert [r[0] for r in df.select(numbers.percent_1(F.col("x"))).collect()] == [97.3, 97.2, 100.0, 0.1]


def test_buckets(spark):
    moment = datetime.datetime(2024, 1, 2, 3, 44, 59, 123456)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    row = df.select(
        *[times.bucket(F.col("t"), s).alias(str(s)) for s in (10, 30, 60, 300, 600, 1800, 3600, 10800, 21600, 43200, 86400)],
        times.trunc("hour", F.col("t")).alias("hour"),
    ).first()
    assert row["10"] == datetime.datetime(2024, 1, 2, 3, 44, 50)
    assert row["300"] == datetime.datetime(2024, 1, 2, 3, 40)
    assert row["10800"] == datetime.datetime(2024, 1, 2, 3)
    assert row["86400"] == datetime.datetime(2024, 1, 2)
    assert row["hour"] == row["3600"]


def test_wire_time_round_trip(spark):
    moment = datetime.datetime(2024, 1, 2, 3, 4, 5, 6)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    row = df.select(times.wire_time(F.col("t")).alias("w")).withColumn("back", times.read_wire_time(F.col("w"))).first()
    assert row["w"] == "2024-01-02T03:04:05.000006Z" and row["back"] == moment
