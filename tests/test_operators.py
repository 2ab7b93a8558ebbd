"""Operators on small hand-made inputs."""

import datetime
import json
import math

import pytest
from pyspark.sql import functions as F

from netsift.config import DEFAULTS, GeoSettings, ReportSettings
from netsift.operators import clean, detect, geo, lookups, metrics, parse, report, rollups, serve
from netsift.schema import COLUMN_TO_WIRE, DOUBLE_COLUMNS, FEATURES, PACKED_SCHEMA, WIRE_TO_COLUMN

EPSILON = 0.001
NAN, INF = float("nan"), float("inf")


def feature_rows(spark, rows):
    """Flows with the given feature values, 0.0 elsewhere, numbered in order."""
    data = [(i, *[float(r[c]) if r.get(c, 0.0) is not None else None for c in FEATURES])
            for i, r in enumerate([dict.fromkeys(FEATURES, 0.0) | r for r in rows])]
    return spark.createDataFrame(data, "flow_id int, " + ", ".join(f"{c} double" for c in FEATURES))


def column(df, name):
    return [r[name] for r in df.orderBy("flow_id").collect()]


def test_there_are_39_features_and_46_fields():
    assert len(set(FEATURES)) == 39 and len(WIRE_TO_COLUMN) == 46
    assert COLUMN_TO_WIRE["flow_bytes_per_sec"] == "flowBytesPerSec" and WIRE_TO_COLUMN["label"] == "true_label"


@pytest.mark.parametrize("feature, limit", detect.ATTACK_LIMITS.items())
def test_detector_limits_are_strict(spark, feature, limit):
    df = feature_rows(spark, [{feature: limit - EPSILON}, {feature: limit}, {feature: limit + EPSILON}])
    assert column(detect.rule_detector(df), "prediction") == [0.0, 0.0, 1.0]


def test_detector_missing_iat_needs_duration(spark):
    df = feature_rows(
        spark, [{"fwd_iat_mean": None, "flow_duration": 1}, {"fwd_iat_mean": None}, {"flow_duration": 1}]
    )
    assert column(detect.rule_detector(df), "prediction") == [1.0, 0.0, 0.0]


@pytest.mark.parametrize(
    "values, name",
    [
        ({"flow_bytes_per_sec": 500_000.1, "flow_packets_per_sec": 50_000.1}, "DDoS"),
        ({"flow_bytes_per_sec": 500_000, "flow_packets_per_sec": 50_000.1}, "Infiltration"),
        ({"flow_bytes_per_sec": 600_000, "flow_packets_per_sec": 60_000, "total_fwd_packets": 6_000}, "DDoS"),
        ({"total_fwd_packets": 5_000.1, "flow_bytes_per_sec": 200_000.1}, "DoS Hulk"),
        ({"total_fwd_packets": 5_000, "flow_bytes_per_sec": 200_000.1}, "Infiltration"),
        ({"syn_flag_count": 201, "flow_duration": 999.9}, "PortScan"),
        ({"syn_flag_count": 200, "flow_duration": 999.9}, "Infiltration"),
        ({"syn_flag_count": 201, "flow_duration": 1000}, "Infiltration"),
        ({"fin_flag_count": 101}, "Brute Force"),
        ({"rst_flag_count": 51}, "Brute Force"),
        ({"total_backward_packets": 5_001, "packet_length_mean": 99.9}, "Bot"),
        ({"total_backward_packets": 5_001, "packet_length_mean": 100}, "Infiltration"),
        ({"total_fwd_packets": 3_001, "fwd_psh_flags": 51, "syn_flag_count": 101}, "Web Attack - XSS"),
        ({"total_fwd_packets": 3_001, "fwd_psh_flags": 50, "syn_flag_count": 101}, "Infiltration"),
    ],
)
def test_class_rules(spark, values, name):
    df = feature_rows(spark, [values]).withColumn("prediction", F.lit(1.0))
    assert column(detect.classify(df), "attack_type") == [name]
    assert column(detect.classify(df.withColumn("prediction", F.lit(0.0))), "attack_type") == ["BENIGN"]


def test_severity(spark):
    df = spark.createDataFrame([(0, None), (1, 0.0), (2, 1.0), (3, 2.0)], "flow_id int, prediction double")
    assert column(df.withColumn("s", detect.severity()), "s") == ["low", "low", "high", "low"]


def test_derived_flows_meet_every_class_and_outcome(spark, folder):
    from netsift.plans.flows import scored

    rows = scored(spark, folder.replace("0.001", "0.01"))
    classes = {r["attack_type"] for r in rows.select("attack_type").distinct().collect()}
    assert classes == {*detect.OTHER_CLASS.split("|"), "BENIGN", *(name for name, _ in detect.CLASS_RULES)}
    outcomes = {(r["true_label"], r["prediction"]) for r in rows.select("true_label", "prediction").distinct().collect()}
    assert outcomes == {(a, b) for a in (0.0, 1.0) for b in (0.0, 1.0)}


def test_many_ranges_in_one_prefix(spark):
    base = 167_772_160
    ranges = spark.range(30_000).select(
        (F.col("id") * 2 + base).alias("ip_from"), (F.col("id") * 2 + base).alias("ip_to"),
        F.col("id").cast("double").alias("latitude"), F.lit(1.0).alias("longitude"),
    )
    wide = spark.createDataFrame([(base + 65_536, base + 200_000, -5.0, 2.0)], ranges.schema)
    texts = ["10.0.0.0", "10.0.0.1", "10.0.0.8", "10.0.200.4", "10.1.0.0", "10.3.13.64", "10.3.13.65", "9.255.255.255", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts * 2], "src_ip string")
    got = {
        small: sorted(((r["src_ip"] or "", r["latitude"], r["geo_source"]) for r in geo.geo_range_join(rows, ranges.union(wide), small=small).collect()))
        for small in (True, False)
    }
    assert got[True] == got[False] and len(got[True]) == 20
    found = {t: v for t, v, source in got[False] if source == "range"}
    assert found == {"10.0.0.0": 0.0, "10.0.0.8": 4.0, "10.0.200.4": 25_602.0, "10.1.0.0": -5.0, "10.3.13.64": -5.0}


# Cleaning

SAMPLE = [NAN, INF, -INF, None, 1.5]


def sample(spark, name):
    return feature_rows(spark, [{name: v} for v in SAMPLE])


def same(got, expected):
    return all(a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b)) for a, b in zip(got, expected))


@pytest.mark.parametrize(
    "function, name, expected",
    [
        (clean.fill_nulls, "flow_duration", [NAN, INF, -INF, 0.0, 1.5]),
        (clean.fill_nulls, "flow_bytes_per_sec", SAMPLE),
        (clean.fill_rates, "flow_bytes_per_sec", [NAN, 0.0, -INF, 0.0, 1.5]),
        (clean.fill_rates, "flow_duration", SAMPLE),
        (clean.clean_nonfinite, "flow_duration", [0.0, 0.0, 0.0, None, 1.5]),
        (clean.clean_all, "flow_duration", [0.0, 0.0, 0.0, 0.0, 1.5]),
        (clean.clean_all, "flow_bytes_per_sec", [0.0, 0.0, 0.0, 0.0, 1.5]),
    ],
)
def test_cleaning(spark, function, name, expected):
    assert same(column(function(sample(spark, name)), name), expected)


def test_drop_incomplete_drops_null_and_nan(spark):
    assert column(clean.drop_incomplete(sample(spark, "idle_mean")), "idle_mean") == [INF, -INF, 1.5]


def test_missing_features_are_added(spark):
    df = clean.clean_all(spark.createDataFrame([(1, 2.0)], "flow_id int, syn_flag_count double"))
    row = df.first()
    assert row["syn_flag_count"] == 2.0 and sum(row[c] for c in FEATURES) == 2.0


def test_labels(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.0), (2, None)], "flow_id int, true_label double")
    assert column(clean.label_text(df), "label") == ["Attack", "Normal"]
    named = spark.createDataFrame([(0, "BENIGN"), (1, " Normal "), (2, "Bot"), (3, None)], "flow_id int, label string")
    assert column(clean.binary_label(named), "label") == ["Normal", "Normal", "Attack"]


# Wire format

def test_parse_tolerates_bad_records(spark):
    records = [
        json.dumps({"srcIp": "10.0.0.1", "srcPort": "80.5", "dstPort": "x", "flowDuration": "12.5", "label": 1, "extra": 3}),
        '{"flowBytesPerSec": 1e400, "synFlagCount": true, "activeMean": "Infinity"}',
        "{bad",
        "",
        None,
    ]
    df = parse.parse_flows(spark.createDataFrame([(r,) for r in records], "raw_value string"))
    assert df.columns == list(WIRE_TO_COLUMN.values())
    rows = df.collect()
    assert (rows[0]["src_ip"], rows[0]["src_port"], rows[0]["dst_port"]) == ("10.0.0.1", 80, None)
    assert rows[0]["flow_duration"] == 12.5 and rows[0]["true_label"] == 1.0
    # A number too large for DOUBLE has no value; a text that names infinity has.
    assert rows[1]["flow_bytes_per_sec"] is None and rows[1]["syn_flag_count"] is None and rows[1]["active_mean"] == INF
    for row in rows[2:]:
        assert set(row) == {None}


def test_encode_uses_wire_names_and_key(spark, flows):
    row = parse.encode_flows(flows.filter("flow_id = 5")).first()
    record = json.loads(row["value"])
    assert set(record) == set(COLUMN_TO_WIRE.values()) and row["key"] == record["srcIp"]


def test_packed_features_round_trip(spark, flows):
    packed = flows.select("flow_id", *DOUBLE_COLUMNS, parse.packed_features().alias("raw_features"))
    back = parse.unpack_features(packed, "flow_id")
    assert back.exceptAll(flows.select("flow_id", *DOUBLE_COLUMNS)).count() == 0
    assert back.schema[1].name == PACKED_SCHEMA[0].name


# Metrics

def scored_rows(spark, pairs):
    rows = [(0, datetime.datetime(2024, 1, 1), p, t) for p, t in pairs]
    return spark.createDataFrame(rows, "batch_id long, timestamp timestamp_ntz, prediction double, true_label double")


def test_metrics(spark):
    pairs = [(1.0, 1.0)] * 3 + [(1.0, 0.0)] + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 3 + [(1.0, None)]
    row = metrics.model_metrics(scored_rows(spark, pairs)).first()
    assert (row["true_positives"], row["true_negatives"], row["false_positives"], row["false_negatives"]) == (3, 3, 1, 2)
    assert row["total_samples"] == 10 and row["accuracy"] == 0.6
    assert row["precision"] == 0.75 and row["recall"] == 0.6
    assert row["f1_score"] == pytest.approx(2 * 0.75 * 0.6 / 1.35)


def test_metrics_without_positives(spark):
    row = metrics.model_metrics(scored_rows(spark, [(0.0, 0.0), (2.0, 0.0)])).first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)
    stats = metrics.traffic_stats(scored_rows(spark, [(0.0, 0.0), (2.0, 0.0)])).first()
    assert (stats["total_packets"], stats["normal_count"], stats["attack_count"]) == (2, 1, 0)


def test_totals_of_nothing(spark):
    empty = metrics.traffic_stats(scored_rows(spark, [(0.0, 0.0)])).limit(0)
    assert tuple(metrics.traffic_totals(empty).first()) == (0, 0, 0)
    assert tuple(metrics.traffic_means(empty).first()) == (0.0, 0.0, 0.0)
    since = F.lit(datetime.datetime(2020, 1, 1)).cast("timestamp_ntz")
    assert metrics.avg_attack_pct(empty, since).first()[0] == 0.0


# Locations

def brute_force(addresses, ranges):
    import ipaddress

    found = {}
    for text in addresses:
        try:
            number = int(ipaddress.IPv4Address(text))
        except ValueError:
            continue
        for low, high, lat, lon in ranges:
            if low <= number <= high:
                found[text] = (lat, lon)
    return found


@pytest.mark.parametrize("small", [True, False, None])
def test_range_join_equals_brute_force(spark, small):
    import random

    rng = random.Random(3)
    edges = sorted(rng.sample(range(2**32), 400))
    # A range over many prefixes, ranges of one address, and gaps.
    ranges = [(a, b, float(i), float(-i)) for i, (a, b) in enumerate(zip(edges[::2], edges[1::2])) if b - a < 2**24]
    ranges += [(edges[-1] + 5, edges[-1] + 5, 77.0, 77.0)]
    import ipaddress

    some = [str(ipaddress.IPv4Address(rng.randrange(2**32))) for _ in range(300)]
    bounds = [str(ipaddress.IPv4Address(n)) for r in ranges for n in (r[0], r[1], max(r[0] - 1, 0), min(r[1] + 1, 2**32 - 1))]
    inside, outside = bounds[0], "not-an-ip"
    # One located and one unlocated address hold a third of the rows each, and many rows have none.
    rows = some + bounds + [inside] * 2000 + [outside] * 2000 + [None] * 1000 + ["", "::1"]
    df = spark.createDataFrame(list(enumerate(rows)), "flow_id int, src_ip string")
    table = spark.createDataFrame(ranges, "ip_from long, ip_to long, latitude double, longitude double")
    got = geo.geo_range_join(df, table, geo=GeoSettings(hot_fraction=10), small=small).collect()
    expected = brute_force(set(filter(None, rows)), ranges)
    assert len(got) == len(rows) and len({r["flow_id"] for r in got}) == len(rows)
    for row in got:
        located = expected.get(row["src_ip"])
        assert (row["geo_source"] == "range") == (located is not None), row
        if located:
            assert (row["latitude"], row["longitude"]) == located
    assert {r["geo_source"] for r in got} == {"range", "hash", "default"}


def test_geo_defaults_and_point(spark):
    rows = [(1, None, "Bot", "high"), (2, "", None, None), (3, "1.2.3.4", "Bot", "low")]
    df = spark.createDataFrame(rows, "flow_id int, src_ip string, attack_type string, severity string")
    got = [tuple(r) for r in geo.geo_defaults(df).orderBy("flow_id").collect()]
    assert got == [(2, "0.0.0.0", "Unknown", "medium"), (3, "1.2.3.4", "Bot", "low")]
    point = geo.geo_point(spark.createDataFrame([(1.5, -2.25)], "latitude double, longitude double")).first()
    assert tuple(point["geom"]) == (-2.25, 1.5, 4326) and point["geom_ewkt"] == "SRID=4326;POINT(-2.25 1.5)"


# Rollups and serving

def test_rollups_from_partial_counts_equal_direct_ones(spark, folder):
    from netsift.plans.tables import alerts as stored

    alerts = stored(spark, folder)
    parts = rollups.rollups_from(rollups.attack_cube(alerts, "batch_id"), rollups.attack_ips(alerts, "batch_id"))
    direct = {
        "attack_distribution": rollups.attack_distribution(alerts), "top_ips": rollups.top_attack_ips(alerts),
        "attack_hourly": rollups.attack_hourly(alerts), "protocol_stats": rollups.protocol_stats(alerts),
        "severity_timeline": rollups.severity_timeline(alerts),
    }
    for name, keys in rollups.ROLLUP_KEYS.items():
        rows = parts[name].collect()
        assert rows == direct[name].collect()
        assert len({tuple(r[k] for k in keys) for r in rows}) == len(rows)


def test_unclassified_alerts_are_no_attacks(spark):
    df = spark.createDataFrame([("BENIGN",), ("Normal",), ("Attack",), ("Bot",), (None,)], "attack_type string")
    assert {r[0] for r in rollups.attacks(df).collect()} == {"Attack", "Bot"}
    assert [r[0] for r in rollups.attack_breakdown(df).collect()] == ["Bot"]


def test_keyset_pages_equal_offset_pages(spark, folder):
    from netsift.plans.tables import alerts as stored

    alerts = stored(spark, folder)
    page = serve.alert_page(alerts, 0, 30).collect()
    for number in (1, 2):
        last = page[-1]
        page = serve.alert_page_after(alerts, last["timestamp"], last["flow_id"], 30).collect()
        assert page == serve.alert_page(alerts, number, 30).collect()


def test_page_totals(spark):
    df = spark.range(101)
    assert tuple(serve.page_info(df, 0, 50).first()) == (101, 3, 0, 50)
    assert tuple(serve.page_info(df.limit(0), 0, 50).first()) == (0, 0, 0, 50)


def test_approximate_count_is_close(spark, folder):
    from netsift.plans.tables import alerts as stored

    exact = serve.unique_attackers(stored(spark, folder)).first()[0]
    assert serve.approx_attackers(stored(spark, folder)).first()[0] == pytest.approx(exact, rel=0.1)


# Report

@pytest.mark.parametrize(
    "value, level", [(35, "High"), (35.01, "Critical"), (25, "Medium"), (25.01, "High"), (15, "Low"), (15.01, "Medium")]
)
def test_risk_level(spark, value, level):
    assert spark.range(1).select(report.risk_level(F.lit(value))).first()[0] == level


@pytest.mark.parametrize(
    "count, level",
    [(200_001, "Critical"), (200_000, "High"), (100_000, "Medium"), (50_000, "Low"), (10_001, "Low"), (10_000, "Info")],
)
def test_type_risk(spark, count, level):
    assert spark.range(1).select(report.type_risk(F.lit(count))).first()[0] == level


def test_rate_bands_start_at_their_threshold(spark):
    bands = DEFAULTS.report.attack_bands
    got = spark.range(1).select(*[report.rate_band(F.lit(v), bands) for v in (14.9, 15.0, 29.9, 30.0)]).first()
    assert tuple(got) == ("green", "amber", "amber", "red")


def facts_of(spark, percentages, attacks=3, benign=10):
    start = datetime.datetime(2024, 1, 1)
    stats = spark.createDataFrame(
        [(start + datetime.timedelta(minutes=i), i, float(p)) for i, p in enumerate(percentages)],
        "timestamp timestamp_ntz, batch_id long, attack_percentage double",
    )
    alerts = spark.createDataFrame(
        [(start, "Bot", "10.0.0.1")] * attacks + [(start, "BENIGN", "10.0.0.2")] * benign,
        "timestamp timestamp_ntz, attack_type string, src_ip string",
    )
    return report.report_facts(alerts, stats, start + datetime.timedelta(hours=1))


def expected_volatility(values):
    if len(values) <= 5:
        return 0.0
    mean = sum(values[-5:]) / 5
    return math.floor(math.sqrt(sum((v - mean) ** 2 for v in values[-10:]) / 10) * 100 + 0.5) / 100


@pytest.mark.parametrize(
    "values", [[], [30], [30, 20], [20, 30], [10, 20, 30, 40, 50], [50, 10, 20, 30, 40, 49], list(range(0, 60, 5)), [40] * 7]
)
def test_trend_and_volatility(spark, values):
    facts = facts_of(spark, values)
    last = values[-5:]
    trend = "increasing" if len(last) > 1 and last[-1] > last[0] else "stable"
    assert report.attack_trend(facts).first()[0] == trend
    assert report.attack_volatility(facts).first()[0] == pytest.approx(expected_volatility(values))


def test_all_recommendations(spark):
    rules = ReportSettings(dominant_type=2, benign_ratio=2)
    facts = facts_of(spark, [0, 10, 90, 10, 90, 100])
    got = report.recommendations(facts, rules).orderBy("ord").collect()
    assert [r["priority"] for r in got] == ["high", "high", "medium", "medium", "low"]
    assert "Bot attacks exceed 100K" in got[0]["text"] and "50.0%" in got[1]["text"]


def test_no_recommendations(spark):
    assert report.recommendations(facts_of(spark, [20, 20], attacks=5, benign=10)).count() == 0


def test_report_without_data(spark):
    facts = facts_of(spark, [], attacks=0, benign=0)
    assert report.alert_rate_per_point(facts).first()[0] == 0
    assert "unknown" in report.summary_text(facts).first()[0]
    assert report.threat_report(facts).first()["risk_level"] == "Low"


def test_lookups(spark):
    df = spark.createDataFrame([("Bot", "high"), ("Other", "odd")], "attack_type string, severity string")
    rows = lookups.with_severity_label(lookups.with_description(df)).collect()
    assert rows[0]["severity_label"] == "HAUTE" and rows[0]["description"] == lookups.DESCRIPTIONS["Bot"]
    assert rows[1]["severity_label"] == "odd" and rows[1]["description"] == lookups.OTHER_DESCRIPTION
