"""Mergeable summaries and deep pages."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from netsift.operators import pages, quality, rollups, serve, sketches
from netsift.operators.clean import clean_all
from netsift.operators.detect import detect
from netsift.schema import LABEL
from netsift.sinks.tables import DATE, read_table, write_table

ALERTS = "flow_id bigint, batch_id bigint, timestamp timestamp_ntz, attack_type string, src_ip string"


@pytest.fixture(scope="module")
def alerts(spark):
    """Batches with frequent, rare and missing addresses; some never are among the first of a batch."""
    rng = random.Random(2)
    start, rows = datetime.datetime(2024, 3, 1), []
    for b in range(12):
        for _ in range(600):
            ip = rng.choice([f"10.0.0.{int(rng.paretovariate(0.6)) % 250}", f"10.1.{rng.randrange(250)}.{b}", None])
            kind = rng.choice(["Bot", "DDoS", "BENIGN"])
            rows.append((len(rows), b, start + datetime.timedelta(minutes=rng.randrange(60 * 24 * 3)), kind, ip))
    return spark.createDataFrame(rows, ALERTS).repartition(5).persist()


@pytest.mark.parametrize("keep", [1, 5, 30, 10_000])
@pytest.mark.parametrize("limit", [1, 10, 50])
def test_frequent_addresses_are_exact(spark, alerts, keep, limit):
    summaries = sketches.frequent_ips(alerts, "batch_id", keep=keep)
    expected = [tuple(r) for r in rollups.top_attack_ips(alerts, limit).collect()]
    assert [tuple(r) for r in sketches.top_ips_of(summaries, alerts, limit).collect()] == expected


def test_bounds_hold(spark, alerts):
    exact = {r["src_ip"]: r["cnt"] for r in rollups.attack_ips(alerts).collect()}
    summaries = sketches.frequent_ips(alerts, "batch_id", keep=8)
    assert summaries.groupBy("batch_id").count().agg(F.max("count")).first()[0] == 9
    bounds = {r["src_ip"]: (r["low"], r["high"]) for r in sketches.frequent_bounds(summaries).collect()}
    assert all(low <= exact[ip] <= high for ip, (low, high) in bounds.items())


def test_one_batch_keeps_the_same(spark, alerts):
    one = alerts.filter("batch_id = 3")
    alone = sorted(map(tuple, sketches.frequent_ips(one.drop("batch_id"), keep=7).collect()), key=str)
    assert alone == sorted((tuple(r)[1:] for r in sketches.frequent_ips(one, "batch_id", keep=7).collect()), key=str)


def test_verification_reads_lossy_batches_only(spark, alerts, tmp_path):
    alerts.write.partitionBy("batch_id").parquet(f"{tmp_path}/alerts")
    stored = read_table(spark, f"{tmp_path}/alerts")
    lossy = sketches.frequent_ips(alerts.filter("batch_id >= 9"), "batch_id", keep=60)
    whole = sketches.frequent_ips(alerts.filter("batch_id < 9"), "batch_id", keep=10_000)
    for b in range(9):
        for part in (tmp_path / "alerts" / f"batch_id={b}").glob("part-*"):
            part.write_bytes(b"unreadable")
    expected = [tuple(r) for r in rollups.top_attack_ips(alerts, 10).collect()]
    got = sketches.top_ips_of(lossy.unionByName(whole), stored, 10)
    assert [tuple(r) for r in got.collect()] == expected


def test_distinct_attackers(spark, alerts):
    parts = sketches.attackers_by_hour(alerts, "batch_id").persist()
    start = F.lit(datetime.datetime(2024, 3, 1, 6)).cast("timestamp_ntz")
    end = F.lit(datetime.datetime(2024, 3, 2, 18)).cast("timestamp_ntz")
    got = sketches.attackers_in_range(parts, start, end)
    exact = serve.unique_attackers(alerts.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end))).first()[0]
    assert abs(got.first()["cnt"] - exact) <= sketches.DISTINCT_ERROR * exact and exact > 500
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "attack_type" not in plan.split("InMemoryRelation")[0]


def test_profiles_merge(spark, flows):
    scored = detect(clean_all(flows)).withColumn("batch", F.col("flow_id") % 7)
    parts = sketches.profile_parts(scored, "batch")
    whole = {r[LABEL]: r.asDict() for r in quality.class_profile(scored).collect()}
    for r in sketches.class_profile_of(parts).collect():
        assert r.asDict() == pytest.approx(whole[r[LABEL]], rel=1e-9)
    assert len(whole) == sketches.class_profile_of(parts).count()
    some = scored.filter(f"{LABEL} = 1").select("flow_duration").toPandas()["flow_duration"]
    for r in sketches.quantiles_of(parts).filter(f"{LABEL} = 1 AND name = 'flow_duration'").collect():
        assert (some < r["value"]).mean() - sketches.QUANTILE_ERROR <= r["share"] <= (some <= r["value"]).mean() + sketches.QUANTILE_ERROR


def test_profile_of_one_row_and_none(spark, flows):
    scored = detect(clean_all(flows)).limit(1)
    row = sketches.class_profile_of(sketches.profile_parts(scored)).first()
    assert row["std_flow_duration"] is None and row["avg_flow_duration"] is not None
    assert sketches.class_profile_of(sketches.profile_parts(scored.limit(0))).count() == 0


def listing(spark, flows):
    return detect(clean_all(flows)).withColumn("severity", F.lit("low"))


@pytest.mark.parametrize("size", [1, 7, 50])
def test_deep_pages_equal_offsets(spark, flows, tmp_path, size):
    """Over busy and empty minutes, at both ends, in the middle and beyond the last page."""
    step = F.when(F.col("flow_id") < 300, F.lit(0)).otherwise(F.col("flow_id") * 977)
    at = F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=step.cast("decimal(18,6)"))
    write_table(listing(spark, flows).withColumn("timestamp", at), str(tmp_path / "alerts"))
    alerts = read_table(spark, str(tmp_path / "alerts"))
    directory = pages.minute_counts(alerts, (F.col("flow_id") % 3).alias("part")).drop("part").persist()
    last = -(-alerts.count() // size) - 1
    for page in (0, 1, last // 2, last - 1, last, last + 1):
        expected = [tuple(r) for r in serve.alert_page(alerts, page, size).collect()]
        assert [tuple(r) for r in pages.alert_page_deep(alerts, directory, page, size).collect()] == expected
    assert pages.alert_page_deep(alerts.limit(0), directory.limit(0), 0, size).count() == 0


def test_deep_page_reads_its_dates_only(spark, flows, tmp_path):
    at = F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("flow_id").cast("int"))
    write_table(listing(spark, flows).withColumn("timestamp", at), str(tmp_path / "alerts"))
    alerts = read_table(spark, str(tmp_path / "alerts"))
    directory = pages.minute_counts(alerts).persist()
    directory.count()
    expected = [tuple(r) for r in serve.alert_page(alerts, 20, 10).collect()]
    dates = {r[1].date().isoformat() for r in expected}
    for part in (tmp_path / "alerts").glob(f"{DATE}=*/part-*"):
        if part.parent.name.removeprefix(f"{DATE}=") not in dates:
            part.write_bytes(b"unreadable")
    assert [tuple(r) for r in pages.alert_page_deep(alerts, directory, 20, 10).collect()] == expected
