"""Sources, sinks, streams and training."""

import datetime
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.config import ForestSettings, StreamSettings
from netsift.operators import forest
from netsift.operators.clean import clean_all
from netsift.operators.detect import detect
from netsift.operators.parse import encode_flows
from netsift.operators.rollups import attack_timeline
from netsift.plans import tables
from netsift.schema import FEATURES, LABEL
from netsift.session import scratch_dir
from netsift.sinks import jdbc
from netsift.sinks.tables import DATE, read_table, since, write_batch, write_table
from netsift.sinks.versions import Versions
from netsift.sources import audit, streams
from netsift.sources.audit import parquet_audit
from netsift.sources.tables import jdbc_read_options, read_table as read_source, read_training_csv
from netsift.streaming import fanout as stream
from netsift.streaming.timeline import read_timeline, start_timeline, windowed_counts

QUICK = ForestSettings(trees=5, depth=4)
ALERT = ("timestamp", "attack_type", "src_ip", "dst_ip", "src_port", "severity", "prediction", "true_label")


def lake_rows(flows):
    return flows.select(*FEATURES, LABEL)


# Sources and sinks

def test_topic_options():
    options = streams.topic_options("host:9092", "network-traffic", StreamSettings(max_offsets_per_trigger=7))
    assert options == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "network-traffic", "startingOffsets": "latest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "7",
    }


def test_relational_options():
    """Options only: no database may be started here."""
    read = jdbc_read_options("jdbc:x", "alerts", "id", 0, 1000, 8, user="u")
    assert read["partitionColumn"] == "id" and read["numPartitions"] == "8" and read["user"] == "u"
    assert "partitionColumn" not in jdbc_read_options("jdbc:x", "alerts")
    append = jdbc.jdbc_write_options("jdbc:x", "alerts")
    assert append["batchsize"] == "500" and append["isolationLevel"] == "NONE" and "truncate" not in append
    assert jdbc.jdbc_write_options("jdbc:x", "attack_summary", truncate=True)["truncate"] == "true"


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_audit_finds_bad_files(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/good.parquet")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/empty.parquet")
    (tmp_path / "long.parquet").write_bytes(b"PAR1" + b"x" * 20 + b"\xff\xff\xff\x7fPAR1")
    (tmp_path / "bad.parquet").write_bytes(b"no parquet at all")
    (tmp_path / "cut.parquet").write_bytes(b"PAR1")
    got = {r["file"].rsplit("/", 1)[-1]: (r["status"], r["row_count"]) for r in parquet_audit(spark, str(tmp_path)).collect()}
    assert got.pop("bad.parquet") == ("BAD", None) and got.pop("cut.parquet") == ("BAD", None)
    assert got.pop("long.parquet") == ("BAD", None)
    assert sorted(got.values()) == [("OK", 0), ("OK", 5)]


def test_audit_opens_no_large_file_whole(spark, tmp_path):
    spark.range(20_000).coalesce(1).write.parquet(f"{tmp_path}/good.parquet")
    # Without rows and with a footer of more than the bytes that are read at once.
    wide = T.StructType([T.StructField(f"c{n}" + "x" * 60, T.LongType()) for n in range(900)])
    spark.createDataFrame([], wide).coalesce(1).write.parquet(f"{tmp_path}/wide.parquet")
    body = b"x" * 100_000
    (tmp_path / "junk.parquet").write_bytes(body)
    (tmp_path / "head.parquet").write_bytes(b"PAR1" + body)
    (tmp_path / "long.parquet").write_bytes(b"PAR1" + body + b"\xff\xff\xff\xffPAR1")
    (tmp_path / "just over.parquet").write_bytes(b"PAR1" + body + (len(body) + 1).to_bytes(4, "little") + b"PAR1")
    files = list(tmp_path.rglob("part-*.parquet")) + list(tmp_path.glob("*.parquet"))
    assert sum(f.is_file() and f.stat().st_size > audit.WHOLE for f in files) == 6
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", audit.WHOLE)
    try:
        found = parquet_audit(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    got = {r["file"].removeprefix(f"file:{tmp_path}/").split("/")[0]: (r["status"], r["row_count"]) for r in found}
    assert got == {
        "good.parquet": ("OK", 20_000), "wide.parquet": ("OK", 0),
        **{f"{name}.parquet": ("BAD", None) for name in ("junk", "head", "long", "just over")},
    }


def test_csv_with_odd_titles(spark, tmp_path):
    path = tmp_path / "flows.csv"
    path.write_text(" Flow Bytes/s, Flow Duration,Label,Note\r\n1.5,Infinity,BENIGN,a\nNaN,2,Bot,b\n")
    for infer in (False, True):
        df = read_training_csv(spark, str(path), infer)
        assert df.columns == ["flow_bytes_per_sec", "flow_duration", "label", "note"]
        assert dict(df.dtypes)["flow_bytes_per_sec"] == dict(df.dtypes)["flow_duration"] == "double"
        assert df.filter("label = 'Bot' AND isnan(flow_bytes_per_sec) AND flow_duration = 2").count() == 1


def test_tables_by_name_and_path(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    spark.range(4).write.parquet(f"{tmp_path}/four")
    assert read_source(spark, "three").count() == 3 and read_source(spark, f"{tmp_path}/four").count() == 4


def stamped(spark, start, n):
    return spark.range(n).select(
        F.col("id"), (F.lit(start) + F.make_dt_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("timestamp")
    )


def test_batches_replace_themselves_only(spark, tmp_path):
    path, start = f"{tmp_path}/t", datetime.datetime(2024, 1, 1)
    for batch in (0, 1, 0, 1, 1):
        write_batch(stamped(spark, start, 50), path, batch)
    table = read_table(spark, path)
    assert table.count() == 100 and dict(table.dtypes)["batch_id"] == "bigint"
    write_batch(stamped(spark, start, 50).filter("id < 10"), f"{tmp_path}/u", 3, dated=False)
    assert [tuple(r) for r in read_table(spark, f"{tmp_path}/u").groupBy("batch_id").count().collect()] == [(3, 10)]


def test_since_prunes_dates(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_table(stamped(spark, datetime.datetime(2024, 1, 1), 24 * 10), path)
    moment = F.lit(datetime.datetime(2024, 1, 9, 12)).cast("timestamp_ntz")
    recent = since(read_table(spark, path), moment)
    assert recent.count() == 36
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert DATE in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_versions(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.latest() is None
    first, second = versions.new_location(), versions.new_location()
    versions.publish(*first, row_count=1)
    versions.publish(*second, row_count=2, score=0.5)
    assert versions.latest()["version"] == second[0] > first[0] and versions.latest()["location"] == second[1]
    assert versions.history().count() == 2


# Streams

def wire_files(flows, path, parts=4):
    """Wire files in order of event time, written one after the other."""
    ordered = flows.withColumn("part", F.ntile(parts).over(Window.orderBy("timestamp")))
    for part in range(1, parts + 1):
        encode_flows(ordered.filter(F.col("part") == part)).select("value").coalesce(1).write.mode("append").text(path)


@pytest.fixture(scope="module")
def wire(spark, flows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wire") / "in")
    wire_files(flows, path)
    return path


def source(spark, path, files=1):
    return streams.read_flow_stream(spark, "text", {"maxFilesPerTrigger": str(files)}, path)


def test_stream_equals_batch(spark, folder, flows, wire, tmp_path):
    root = f"{tmp_path}/out"
    query = stream.start_detection(source(spark, wire), stream.FanOut(spark, root), f"{tmp_path}/cp", once=True)
    query.awaitTermination()
    expected = tables.alerts(spark, folder).select(*ALERT)
    got = read_table(spark, f"{root}/alerts")
    assert got.select("batch_id").distinct().count() == 4
    assert got.select(*ALERT).exceptAll(expected).count() == 0 and got.count() == expected.count()
    observed = [p["observedMetrics"]["flows"] for p in query.recentProgress if "flows" in p["observedMetrics"]]
    assert sum(o["rows"] for o in observed) == got.count() and sum(o["malformed"] for o in observed) == 0
    # Every fifth batch feeds the lake: of four batches, the first.
    assert {r[0] for r in read_table(spark, f"{root}/training").select("batch_id").distinct().collect()} == {0}
    first = got.filter("batch_id = 0").count()
    assert read_table(spark, f"{root}/training").count() == first
    metrics = read_table(spark, f"{root}/model_metrics").agg(F.sum("total_samples"), F.sum("true_positives")).first()
    assert tuple(metrics) == (got.count(), got.filter("prediction = 1 AND true_label = 1").count())
    newest = stream.latest_summary(read_table(spark, f"{root}/attack_summary"))
    assert newest.agg(F.sum("count")).first()[0] == got.filter("batch_id = 3").count()
    polled = [stream.poll_geo(spark, root, after).count() for after in (-1, 1, 3)]
    assert polled[0] == got.filter("src_ip IS NOT NULL").count() and polled[0] > polled[1] > polled[2] == 0
    stages = {r[0] for r in read_table(spark, f"{root}/progress").select("stage").distinct().collect()}
    assert {"score", "alerts", "attacks_geo", "training"} <= stages


def test_restart_continues_from_the_checkpoint(spark, flows, tmp_path):
    path, root = f"{tmp_path}/in", f"{tmp_path}/out"
    wire_files(flows.filter("flow_id < 300"), path, 1)
    for expected in (300, 500):
        stream.start_detection(source(spark, path), stream.FanOut(spark, root), f"{tmp_path}/cp", once=True).awaitTermination()
        assert read_table(spark, f"{root}/alerts").count() == expected
        if expected == 300:
            wire_files(flows.filter("flow_id BETWEEN 300 AND 499"), path, 1)


def test_malformed_records_are_set_apart_and_counted(spark, tmp_path):
    path, root = f"{tmp_path}/in", f"{tmp_path}/out"
    records = ["{bad", json.dumps({"srcIp": "10.0.0.1", "dstIp": "10.0.0.2", "synFlagCount": "lots"})]
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.text(path)
    query = stream.start_detection(source(spark, path), stream.FanOut(spark, root), f"{tmp_path}/cp", once=True)
    query.awaitTermination()
    rows = read_table(spark, f"{root}/alerts").collect()
    assert [(r["src_ip"], r["attack_type"]) for r in rows] == [("10.0.0.1", "BENIGN")]
    assert all(r["timestamp"] == r["ingest_time"] for r in rows)
    assert [(r["reject_reason"], r["raw_value"]) for r in read_table(spark, f"{root}/rejects").collect()] == [("malformed", "{bad")]
    seen = [p["observedMetrics"]["flows"] for p in query.recentProgress if p["observedMetrics"]]
    assert [(m["rows"], m["malformed"], m["rejected"]) for m in seen] == [(2, 1, 1)]
    assert read_table(spark, f"{root}/attacks_geo").count() == 1
    assert read_table(spark, f"{root}/traffic_stats").first()["total_packets"] == 1


def test_empty_batches_write_nothing(spark, flows, tmp_path):
    fan = stream.FanOut(spark, f"{tmp_path}/out")
    fan(flows.withColumn("ingest_time", F.col("timestamp")).limit(0), 0)
    assert stream.poll_geo(spark, f"{tmp_path}/out", -1) is None


def test_rollups_refresh(spark, folder, flows, tmp_path):
    root = f"{tmp_path}/out"
    fan = stream.FanOut(spark, root)
    batch = flows.withColumn("ingest_time", F.col("timestamp"))
    fan(batch.filter("flow_id < 500"), 0)
    stream.refresh_rollups(spark, root)
    before = stream.read_rollup(spark, root, "attack_distribution").agg(F.sum("cnt")).first()[0]
    fan(batch.filter("flow_id >= 500"), 1)
    stream.refresh_rollups(spark, root)
    after = stream.read_rollup(spark, root, "attack_distribution").agg(F.sum("cnt")).first()[0]
    assert 0 < before < after == tables.alerts(spark, folder).filter("attack_type <> 'BENIGN'").count()


def test_timeline_with_watermark_equals_batch(spark, flows, wire, tmp_path):
    """Files come in order of event time, so a short lateness loses nothing."""
    counts = windowed_counts(detect(clean_all(stream.flows_from(source(spark, wire)))), "1 minute")
    start_timeline(counts, f"{tmp_path}/t", f"{tmp_path}/cp", once=True).awaitTermination()
    rows = detect(clean_all(flows))
    newest = rows.agg(F.max("timestamp")).first()[0]
    expected = attack_timeline(rows, newest, 60 * 24 * 60)
    assert read_timeline(spark, f"{tmp_path}/t").collect() == expected.collect()


def test_late_rows_are_dropped_by_the_watermark(spark, flows, tmp_path):
    rows = flows.filter("true_label = 1").orderBy("timestamp")
    newest, oldest = rows.orderBy(F.desc("timestamp")).limit(1), rows.limit(1)
    for part in (newest, newest, oldest):
        wire_files(part, f"{tmp_path}/in", 1)
    counts = windowed_counts(detect(clean_all(stream.flows_from(source(spark, f"{tmp_path}/in")))), "1 hour")
    start_timeline(counts, f"{tmp_path}/t", f"{tmp_path}/cp", once=True).awaitTermination()
    assert [r["cnt"] for r in read_timeline(spark, f"{tmp_path}/t").collect()] == [2]


# Training

def test_training_learns_and_publishes(spark, flows, tmp_path):
    lake_rows(flows).write.parquet(f"{tmp_path}/lake")
    versions = Versions(spark, f"{tmp_path}/models")
    result = forest.retrain(spark, f"{tmp_path}/lake", versions, QUICK)
    assert result.rows == 1000 and result.attacks == flows.filter("true_label = 1").count() and result.holdout_accuracy >= 0.99
    assert versions.latest()["version"] == result.version and versions.latest()["row_count"] == 1000


@pytest.mark.parametrize("condition", ["true", "true_label = 1 OR flow_id % 10 = 0"])
def test_class_meaning_does_not_depend_on_frequency(spark, flows, condition):
    """1.0 is an attack, also when attacks are the majority."""
    model = forest.train(forest.from_lake(lake_rows(flows.filter(condition))), QUICK).model
    scored = forest.score(clean_all(flows), model)
    agreeing = scored.filter(F.col("prediction") == F.col("true_label")).count()
    assert agreeing / scored.count() >= 0.98
    assert scored.filter("attack_probability > 0.5 AND prediction = 0").count() == 0


def test_gates(spark, flows, tmp_path):
    rows = lake_rows(flows)
    assert forest.train(forest.from_lake(rows.limit(99)), QUICK).skipped == forest.TOO_FEW
    assert forest.train(forest.from_lake(rows.filter("true_label = 1")), QUICK).skipped == forest.ONE_CLASS
    rows.drop(LABEL).write.parquet(f"{tmp_path}/lake")
    versions = Versions(spark, f"{tmp_path}/models")
    assert forest.retrain(spark, f"{tmp_path}/lake", versions, QUICK).skipped == forest.NO_LABEL
    assert versions.latest() is None
    unlabelled = rows.limit(200).withColumn(LABEL, F.lit(None).cast("double"))
    assert forest.train(forest.from_lake(unlabelled), QUICK).skipped == forest.TOO_FEW


def test_csv_training(spark, flows, tmp_path):
    named = flows.select(*FEATURES, F.when(F.col(LABEL) == 1, "DDoS").otherwise("BENIGN").alias(" Label"))
    named.withColumnsRenamed({"flow_bytes_per_sec": "Flow Bytes/s", "avg_packet_size": "Average Packet Size"}).write.option(
        "header", True
    ).csv(f"{tmp_path}/csv")
    result = forest.train_csv(spark, f"{tmp_path}/csv", Versions(spark, f"{tmp_path}/models"), QUICK)
    complete = flows.select(*FEATURES).na.drop().count()
    assert result.rows == complete and result.holdout_accuracy >= 0.99
    named.drop(" Label").write.option("header", True).csv(f"{tmp_path}/bare")
    assert forest.train_csv(spark, f"{tmp_path}/bare", Versions(spark, f"{tmp_path}/m2"), QUICK).skipped == forest.NO_LABEL


def test_model_is_replaced_between_batches(spark, flows, tmp_path):
    versions = Versions(spark, f"{tmp_path}/models")
    fan = stream.FanOut(spark, f"{tmp_path}/out", models=versions)
    batch = flows.withColumn("ingest_time", F.col("timestamp"))
    fan(batch, 0)
    assert fan.cache.version is None
    for batch_id in (1, 2):
        published = forest.publish(forest.train(forest.from_lake(lake_rows(flows)), QUICK), versions)
        fan(batch, batch_id)
        assert fan.cache.version == published.version
    loaded = fan.cache.model
    fan(batch, 3)
    assert fan.cache.model is loaded
    by_batch = read_table(spark, f"{tmp_path}/out/alerts").groupBy("batch_id").agg(F.count("attack_probability"))
    assert {tuple(r) for r in by_batch.collect()} == {(0, 0), (1, 1000), (2, 1000), (3, 1000)}


def test_saving_replaces_a_model(spark, flows, tmp_path):
    model = forest.train(forest.from_lake(lake_rows(flows)), QUICK).model
    for _ in range(2):
        forest.save_model(model, f"{tmp_path}/m")
    loaded = forest.PipelineModel.load(f"{tmp_path}/m")
    assert forest.score(clean_all(flows), loaded).filter("prediction = 1").count() > 300


def test_stored_dashboard_has_the_sections_by_batch(spark, folder):
    from netsift.plans import jobs

    batches = {}
    for r in read_table(spark, f"{jobs.detected(spark, folder)}/alerts").select("batch_id", "timestamp", "prediction").collect():
        batches.setdefault(r["batch_id"], []).append((r["timestamp"], r["prediction"]))
    rows = [
        (max(t for t, _ in b), i, len(b), 100 * sum(p == 0 for _, p in b) / len(b), 100 * sum(p == 1 for _, p in b) / len(b))
        for i, b in batches.items()
    ]
    newest = max(rows)
    day = [r for r in rows if r[0] >= newest[0] - datetime.timedelta(days=1)]
    expected = {("latest", n, newest[0]): v for n, v in zip(("total_packets", "normal_percentage", "attack_percentage"), newest[2:])}
    expected |= {("traffic_timeline", str(r[1]), r[0]): r[4] for r in day}
    expected |= {("mean", "avg_attack_percentage_24h", None): sum(r[4] for r in day) / len(day)}
    got = jobs.dashboard_stored_traffic(spark, folder).collect()
    assert len(got) == len(expected)
    assert {(r["section"], r["name"], r["at"]): r["value"] for r in got} == pytest.approx(expected)


def test_totals_of_metrics_and_summary(spark, folder):
    from netsift.plans import jobs

    rows = read_table(spark, f"{jobs.detected(spark, folder)}/alerts").select("attack_type", "timestamp", "prediction", "true_label").collect()
    cells = [sum((r["prediction"], r["true_label"]) == c for r in rows) for c in ((1.0, 1.0), (0.0, 0.0), (1.0, 0.0), (0.0, 1.0))]
    assert list(jobs.fanout_metrics_totals(spark, folder).first()) == [len(rows), *cells]
    seen = {}
    for r in rows:
        seen.setdefault(r["attack_type"], []).append(r["timestamp"])
    got = {r["attack_type"]: (r["count"], r["last_seen"]) for r in jobs.fanout_summary_totals(spark, folder).collect()}
    assert got and got == {k: (len(v), max(v)) for k, v in seen.items() if k in got}
    assert {k for k in seen if k not in got} <= {"BENIGN"}
