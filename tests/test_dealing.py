"""Stored tables are written by many tasks, and shuffled before their rows grow wide."""

import datetime
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from netsift.functions.times import trunc
from netsift.plans import flows as base, jobs, tables
from netsift.sinks.tables import DATE, dealt_by_date, read_table, write_batch, write_table
from netsift.streaming import fanout as stream

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sparse(spark, tmp_path_factory):
    """Events whose keys leave gaps: of the six ranges of offsets one has many rows, one has three and others none."""
    folder = str(tmp_path_factory.mktemp("sparse"))
    keys = [*range(4_000), *range(40_000, 40_003), 60_000, None]
    rows = [(k, START + datetime.timedelta(minutes=7 * n), n % 90) for n, k in enumerate(keys)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
    events.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_PART", 100)


def below_exchange(df) -> str:
    """What a plan does before its first shuffle (the last one in the text)."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for mark in ("RebalancePartitions", "RepartitionByExpression"):
        if mark in plan:
            return plan[plan.rindex(mark):]
    raise AssertionError(plan)


def test_ranges_of_the_topic_have_as_many_files(spark, sparse, small_parts, tmp_path):
    files = tables.topic_files(spark, sparse)
    assert files > 1
    assert tables.files_in(spark, tables.topic(spark, sparse), "parquet") == files * tables.TOPIC_RANGES
    size = 60_000 // tables.TOPIC_RANGES + 1
    seen = []

    def keep(batch, number):
        seen.append((number, {r["flow_id"] for r in batch.select("flow_id").collect()}))

    raw = jobs.topic_stream(spark, sparse)
    writer = raw.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    keys = [*range(4_000), *range(40_000, 40_003), 60_000]
    assert [ids for _, ids in sorted(seen)] == [{k for k in keys if k // size == n} for n in range(tables.TOPIC_RANGES)]


def test_batches_of_the_wire_do_not_grow_in_number(spark, sparse, small_parts, tmp_path):
    batches, rows = [], []
    raw = jobs.wire_stream(spark, sparse)
    assert tables.files_in(spark, tables.wire(spark, sparse)) > 8

    def keep(batch, number):
        batches.append(number)
        rows.append(batch.count())

    writer = raw.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == 2
    assert sum(rows) == 4_005
    assert jobs.share_of(3, 4, 8) == {"maxFilesPerTrigger": "4"}
    assert jobs.share_of(400, 3, 8) == {"maxFilesPerTrigger": "150"}


def test_stored_alerts_shuffle_events_only(spark, sparse, small_parts):
    before = below_exchange(tables.dealt_alerts(spark, sparse))
    assert "event_id" in before and "to_json" not in before and "flow_duration" not in before
    stored = tables.alerts(spark, sparse)
    plain = base.alerts(spark, sparse)
    columns = [c for c in plain.columns]
    assert stored.select(columns).exceptAll(plain).isEmpty() and plain.exceptAll(stored.select(columns)).isEmpty()
    assert stored.filter(F.col(DATE) != F.col("timestamp").cast("date")).isEmpty()


def test_stream_alerts_are_dealt_before_they_are_packed(spark, sparse, tmp_path):
    fan = stream.FanOut(spark, str(tmp_path))
    batch = tables.stored_flows(spark, sparse)
    scored = batch.withColumns({"prediction": F.lit(1.0), "attack_type": F.lit("Bot"), "attack_probability": F.lit(0.5)})
    one = spark.createDataFrame([(0,)], "batch_id bigint")
    counts = one.select(*[F.lit(0).cast("bigint").alias(c) for c in (
        "batch_id", "timestamp", "total_samples", "true_positives", "true_negatives", "false_positives", "false_negatives",
        "normal_count", "attack_count",
    )])
    before = below_exchange(fan._tables(scored, counts, 1)["alerts"])
    assert "flow_duration" in before and "to_json" not in before


def test_dealt_rows_are_written_whole(spark, tmp_path):
    times = [START + datetime.timedelta(hours=n % 70) for n in range(500)] + [None]
    rows = spark.createDataFrame([(n if n % 9 else None, t) for n, t in enumerate(times)], "k bigint, timestamp timestamp_ntz")
    write_table(dealt_by_date(rows, 7, "k"), f"{tmp_path}/whole", dealt=True)
    write_batch(dealt_by_date(rows), f"{tmp_path}/batch", 3, dealt=True)
    for name in ("whole", "batch"):
        back = read_table(spark, f"{tmp_path}/{name}").select("k", "timestamp")
        assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    days = trunc("day", F.col("timestamp"))
    assert read_table(spark, f"{tmp_path}/whole").filter(days.cast("date") != F.col(DATE)).isEmpty()


def test_topic_and_quantiles_are_made_out_of_events(spark, sparse, small_parts, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "_PATHS", {})
    monkeypatch.setattr(tables, "stored_flows", lambda *_: pytest.fail("wide rows were stored and read again"))
    topic = spark.read.parquet(tables.topic(spark, sparse))
    plain = base.flows(spark, sparse).filter("flow_id IS NOT NULL")
    messages = tables.encode_flows(plain, "flow_id").select("key", "value", F.lit(0).alias("partition"), F.col("flow_id").alias("offset"))
    assert topic.exceptAll(messages).isEmpty() and messages.exceptAll(topic).isEmpty()
    once, stored = tables.scored_once(spark, sparse), base.scored(spark, sparse)
    assert once.exceptAll(stored).isEmpty() and stored.exceptAll(once).isEmpty()


def test_damaged_records_are_made_out_of_events_and_compressed(spark, sparse, small_parts, monkeypatch):
    monkeypatch.setattr(tables, "_PATHS", {})
    monkeypatch.setattr(tables, "stored_flows", lambda *_: pytest.fail("wide rows were stored and read again"))
    got = sorted(r["value"] for r in spark.read.schema(tables.RECORD).parquet(tables.damaged(spark, sparse)).collect())
    whole = tables.encode_flows(base.flows(spark, sparse), "flow_id").select("flow_id", "value").collect()

    def planted(k, text):
        if k is None:
            return text
        if k % 97 == 5:
            return text[: len(text) // 2]
        moment = "2999-01-01" if k % 89 == 7 else "1970-01-02" if k % 83 == 3 else None
        return re.sub('"timestamp":"[^"]*"', f'"timestamp":"{moment}T00:00:00Z"', text) if moment else text

    assert got == sorted(planted(r["flow_id"], r["value"]) for r in whole)
    assert tables.damaged_files(spark, sparse) == len(whole) // 100 + 1
    stored = sum(f.stat().st_size for f in Path(tables.damaged(spark, sparse)).glob("part-*"))
    assert stored < sum(map(len, got)) / 2


def test_stored_tables_are_written_by_compiled_methods(spark, sparse, monkeypatch):
    monkeypatch.setattr(tables, "_PATHS", {})
    limit = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(limit), []
    tables._stored(spark, sparse, "limit", lambda _: seen.append(spark.conf.get(limit)))
    with pytest.raises(ZeroDivisionError):
        tables._stored(spark, sparse, "failing", lambda _: 1 / 0)
    assert seen == ["8000"] and spark.conf.get(limit) == before != "8000"
