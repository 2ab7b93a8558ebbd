"""Named queries that write, train or stream before they return a result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.config import ForestSettings
from netsift.functions.times import minutes_before, wire_time
from netsift.functions.times import trunc
from netsift.operators import clean, forest, geo, pages, rollups, serve, sketches
from netsift.operators.detect import OTHER_CLASS, detect
from netsift.operators.parse import parse_flows
from netsift.plans import dashboard, tables
from netsift.plans.catalog import query, register
from netsift.schema import FEATURES, LABEL
from netsift.session import compiled_methods, scratch_dir
from netsift.sinks.tables import DATE, read_table, write_batch
from netsift.sinks.versions import Versions
from netsift.sources.streams import read_flow_stream
from netsift.sources.tables import read_lake, read_table as read_source, read_training_csv
from netsift.streaming import fanout as stream
from netsift.streaming import feed, late, ledger
from netsift.streaming.incremental import refresh_incremental as refresh_more
from netsift.streaming.progress import ProgressLog
from netsift.streaming.timeline import dropped_rows, read_timeline, start_timeline, windowed_counts

WIRE_ALERT = (
    "timestamp", "attack_type", "src_ip", "dst_ip", "src_port", "dst_port", "protocol",
    "severity", "prediction", "true_label",
)
_ROOTS: dict[tuple[str, str], str] = {}


def share_of(files: int, share: int, shares: int) -> dict[str, str]:
    """Options of a stream over ``files`` files that takes ``share`` of ``shares`` at a time, and as many files at least."""
    return {"maxFilesPerTrigger": str(max(share, -(-files * share // shares)))}


def wire_stream(spark: SparkSession, folder: str, shares: int = 4) -> DataFrame:
    """The wire files in a few batches, however many files there are."""
    path = tables.wire(spark, folder)
    options = share_of(tables.files_in(spark, path), shares, tables.WIRE_SHARES)
    return read_flow_stream(spark, "text", options, path)


def topic_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The topic, one range of its offsets in each batch."""
    options = {"maxFilesPerTrigger": str(tables.topic_files(spark, folder))}
    return read_flow_stream(spark, "parquet", options, tables.topic(spark, folder), schema=tables.TOPIC)


def finish(query) -> None:
    query.awaitTermination()


def detected(spark: SparkSession, folder: str) -> str:
    """Root folder of the tables that the detection stream wrote for all flows."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _ROOTS:
        root = scratch_dir(spark, "stream")
        fan = stream.FanOut(spark, root)
        finish(stream.start_detection(topic_stream(spark, folder), fan, f"{root}/checkpoint", once=True))
        _ROOTS[key] = root
    return _ROOTS[key]


def stream_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: read_table(spark, f"{detected(spark, folder)}/{name}")


# Files and tables

@query
def csv_scan(spark, folder):
    path = scratch_dir(spark, "csv")
    tables.stored_flows(spark, folder).select("flow_id", *FEATURES, LABEL).write.option("header", True).csv(path)
    typed = read_training_csv(spark, path)
    return typed.withColumns({"flow_id": F.col("flow_id").cast("bigint"), LABEL: F.col(LABEL).cast("double")})


@query
def csv_scan_inferred(spark, folder):
    path = scratch_dir(spark, "csv")
    tables.stored_flows(spark, folder).select("flow_id", *FEATURES, LABEL).write.option("header", True).csv(path)
    return read_training_csv(spark, path, infer=True).withColumn("flow_id", F.col("flow_id").cast("bigint"))


@query
def training_scan(spark, folder):
    return read_lake(spark, tables.lake(spark, folder)).select(*FEATURES, LABEL)


@query
def table_read(spark, folder):
    return read_source(spark, f"{folder}/events.parquet").select("event_id", "ts", "user_id", "event_type")


# Streams

@query
def stream_source(spark, folder):
    """All raw records, as read by the streaming source, parsed."""
    root = scratch_dir(spark, "raw")
    raw = wire_stream(spark, folder)
    finish(
        raw.writeStream.format("parquet").option("path", f"{root}/data").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    return parse_flows(spark.read.parquet(f"{root}/data"))


@query
def raw_bridge(spark, folder):
    """All records as the bridge stored them, parsed, and whether they are stamped."""
    root = scratch_dir(spark, "bridge")
    finish(stream.raw_bridge(wire_stream(spark, folder), f"{root}/data", f"{root}/checkpoint", once=True))
    copied = read_table(spark, f"{root}/data").withColumn("stamped", F.col("timestamp").isNotNull())
    return parse_flows(copied, "stamped")


@query
def fanout(spark, folder):
    return stream_table("alerts")(spark, folder).select(*WIRE_ALERT)


@query
def fanout_totals(spark, folder):
    """Rows of all batches in the statistics table."""
    stats = stream_table("traffic_stats")(spark, folder)
    return stats.agg(
        F.sum("total_packets").alias("total_packets"), F.sum("normal_count").alias("normal_count"),
        F.sum("attack_count").alias("attack_count"),
    )


@query
def fanout_metrics_totals(spark, folder):
    """Samples and confusion counts of all batches in the metrics table."""
    names = ("total_samples", "true_positives", "true_negatives", "false_positives", "false_negatives")
    return stream_table("model_metrics")(spark, folder).agg(*[F.sum(n).alias(n) for n in names])


@query
def fanout_summary_totals(spark, folder):
    """Rows and newest moment by attack type over all batches in the summary table."""
    rows = stream_table("attack_summary")(spark, folder)
    return rows.groupBy("attack_type").agg(F.sum("count").alias("count"), F.max("last_seen").alias("last_seen"))


@query
def geo_feed(spark, folder):
    """Everything that a client gets that polls from the first batch on."""
    rows = stream.poll_geo(spark, detected(spark, folder), after_batch=-1)
    return rows.select("src_ip", "attack_type", "severity", "timestamp", "latitude", "longitude", "geo_source")


def served(table: str, function: Callable, *args) -> Callable[[SparkSession, str], DataFrame]:
    """A serving query on a table as the stream wrote it."""
    return lambda spark, folder: function(stream_table(table)(spark, folder), *args).drop("batch_id", "geom", "geom_ewkt", DATE)


for _name, _query in {
    "stream_alert_page": served("alerts", serve.alert_page, 2, 50),
    "stream_recent_alerts": served("alerts", serve.recent_alerts),
    "stream_alerts_by_type": served("alerts", serve.alerts_where, "attack_type", "PortScan"),
    "stream_geo_recent": served("attacks_geo", serve.geo_recent),
    "stream_geo_map": served("attacks_geo", geo.geo_map),
    "stream_geo_bbox": served("attacks_geo", geo.geo_bbox),
}.items():
    register(_name, _query)


@query
def stream_geo_since(spark, folder):
    day = minutes_before(serve.latest_moment(stream_table("alerts")(spark, folder)), 1_440)
    return served("attacks_geo", serve.geo_since, day)(spark, folder)


@query
def stream_geo_points(spark, folder):
    """Points of the stored locations, in their text form."""
    return stream_table("attacks_geo")(spark, folder).select("flow_id", "geom.lon", "geom.lat", "geom.srid")


@query
def training_sink(spark, folder):
    """Batches in the lake or due there (every fifth), and those whose rows are not the batch's labelled alerts."""
    root = detected(spark, folder)
    kept = read_table(spark, f"{root}/training").groupBy("batch_id").agg(F.count("*").alias("kept"))
    due = read_table(spark, f"{root}/alerts").filter("batch_id % 5 = 0 AND true_label IS NOT NULL")
    both = due.groupBy("batch_id").agg(F.count("*").alias("due")).join(kept, "batch_id", "full")
    wrong = F.coalesce(F.col("due") != F.col("kept"), F.lit(True))
    return both.agg(F.count("*").alias("batches"), F.count_if(wrong).alias("wrong"))


@query
def progress(spark, folder):
    """Batches that logged each stage, and the rows that they report."""
    rows = stream_table("progress")(spark, folder)
    return rows.groupBy("stage").agg(F.count("*").alias("batches"), F.sum("batch_rows").alias("batch_rows"))


def published(spark: SparkSession, root: str) -> DataFrame:
    """The five rollups as last published, in one table."""
    parts = []
    for name, keys in rollups.ROLLUP_KEYS.items():
        rollup = stream.read_rollup(spark, root, name)
        shown = [wire_time(F.col(k)) if k == "hour" else F.col(k) for k in keys]
        parts.append(rollup.select(F.lit(name).alias("rollup"), F.concat_ws("|", *shown).alias("name"), "cnt"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query
def refresh_rollups(spark, folder):
    """The five rollups as published by a refresh."""
    root = detected(spark, folder)
    stream.refresh_rollups(spark, root)
    return published(spark, root)


@query
def refresh_incremental(spark, folder):
    """The five rollups after three incremental refreshes; before the second, a batch that was cut short is replayed."""
    root = scratch_dir(spark, "incremental")
    fan, flows = stream.FanOut(spark, root), tables.stored_flows(spark, folder)
    quarter = [flows.filter(F.col("flow_id") % 4 == n) for n in range(4)]
    fan(quarter[0], 0)
    fan(quarter[1].filter("flow_id % 8 = 1"), 1)
    refresh_more(spark, root)
    fan(quarter[1], 1)
    fan(quarter[2], 2)
    refresh_more(spark, root)
    fan(quarter[3], 3)
    refresh_more(spark, root)
    return published(spark, root)


def damaged(spark: SparkSession, folder: str) -> str:
    """Root folder of the stream over records some of which are no flows, with the log of its progress."""
    key = (spark.sparkContext.applicationId, f"damaged {folder}")
    if key not in _ROOTS:
        root = scratch_dir(spark, "damaged-stream")
        log = ProgressLog(spark, f"{root}/batch_progress")
        spark.streams.addListener(log)
        try:
            options = share_of(tables.damaged_files(spark, folder), 2, tables.WIRE_SHARES)
            raw = read_flow_stream(spark, "parquet", options, tables.damaged(spark, folder), schema=tables.RECORD)
            finish(stream.start_detection(raw, stream.FanOut(spark, root), f"{root}/checkpoint", once=True))
            log.close()
        finally:
            spark.streams.removeListener(log)
        _ROOTS[key] = root
    return _ROOTS[key]


@query
def stream_progress(spark, folder):
    """What the listener stored of all batches, summed up."""
    rows = read_table(spark, f"{damaged(spark, folder)}/batch_progress")
    return rows.agg(*[F.sum(c).alias(c) for c in ("rows", "malformed", "missing_src_ip", "rejected", "input_rows")])


@query
def fanout_rejects(spark, folder):
    """Alerts and rejected records by reason; together they are all records."""
    root = damaged(spark, folder)
    rejects = read_table(spark, f"{root}/rejects").filter("raw_value IS NOT NULL")
    alerts = read_table(spark, f"{root}/alerts").groupBy(F.lit("alert").alias("kind"))
    return alerts.agg(F.count("*").alias("cnt")).union(rejects.groupBy("reject_reason").agg(F.count("*")))


@query
def stream_alert_page_deep(spark, folder):
    """The page in the middle of the stored listing, by the directory that the stream keeps."""
    directory = stream_table("alert_minutes")(spark, folder)
    rows = directory.agg(F.sum("cnt")).first()[0]
    return pages.alert_page_deep(stream_table("alerts")(spark, folder), directory, rows // 50 // 2, 50)


@query
def attackers_by_range(spark, folder):
    """Different attackers of each day: exact, and whether the merged sketches are within their error."""
    day = trunc("day", F.col("hour")).alias("day")
    estimated = sketches.distinct_attackers(stream_table("attackers")(spark, folder), day).withColumnRenamed("cnt", "estimate")
    alerts = rollups.attacks(stream_table("alerts")(spark, folder))
    exact = alerts.groupBy(trunc("day", F.col("timestamp")).alias("day")).agg(F.countDistinct("src_ip").alias("cnt"))
    near = F.abs(F.col("estimate") - F.col("cnt")) <= F.greatest(F.lit(1.0), sketches.DISTINCT_ERROR * F.col("cnt"))
    return exact.join(estimated, "day", "left").select("day", "cnt", F.coalesce(near, F.lit(False)).alias("within_error"))


@query
def top_ips_stream(spark, folder):
    """The most frequent attackers, out of what each batch kept."""
    return sketches.top_ips_of(stream_table("frequent_ips")(spark, folder), stream_table("alerts")(spark, folder))


@query
def top_ips_stream_verified(spark, folder):
    """The same from summaries that leave addresses out, so that candidates are verified."""
    alerts = stream_table("alerts")(spark, folder)
    return sketches.top_ips_of(sketches.frequent_ips(alerts, "batch_id", keep=100), alerts)


@query
def class_profile_stored(spark, folder):
    """Mean and deviation by label, out of the profiles of all batches."""
    profile = sketches.class_profile_of(stream_table("profiles")(spark, folder))
    return profile.withColumns({c: F.round(c, 3) for c in profile.columns if c != LABEL})


@query
def class_quantiles_stored(spark, folder):
    """Quartiles by label, out of the sketches of all batches, and whether their ranks are within the sketches' error."""
    found = sketches.quantiles_of(stream_table("profiles")(spark, folder))
    path = scratch_dir(spark, "ranks")
    with compiled_methods(spark):
        sketches.ranks_of(found, tables.scored_once(spark, folder).filter(F.col(LABEL).isNotNull())).write.parquet(path)
    ranks = spark.read.parquet(path)
    error = sketches.QUANTILE_ERROR * F.col("n") + 1
    wanted = F.col("share") * F.col("n")
    return ranks.select(LABEL, "name", "share", ((F.col("below") <= wanted + error) & (F.col("upto") >= wanted - error)).alias("within_error"))


@query
def dashboard_stored(spark, folder):
    """The dashboard as served in a deployment."""
    root = detected(spark, folder)
    stream.refresh_rollups(spark, root)
    return dashboard.stacked(stream.stored_dashboard(spark, root)).withColumn("value", F.round("value", 6))


@query
def dashboard_stored_traffic(spark, folder):
    """The dashboard's sections that follow the stream's batches."""
    return dashboard_stored(spark, folder).filter(F.col("section").isin("latest", "traffic_timeline", "mean"))


@query
def idempotent_replay(spark, folder):
    """Row counts after the batch of all flows replaced attempts with other dates and with other rows."""
    root = scratch_dir(spark, "replay")
    fan = stream.FanOut(spark, root)
    batch = tables.stored_flows(spark, folder)
    shifted = F.col("timestamp") + F.expr("INTERVAL 400 DAYS")
    fan(batch.withColumn("timestamp", shifted), 0)
    fan(batch, 0)
    fan(batch.filter("flow_id % 2 = 0"), 1)
    for table in ("alerts", "attacks_geo", "traffic_stats"):
        # A retry of the second batch that finds no rows any more.
        write_batch(read_table(spark, f"{root}/{table}").limit(0), f"{root}/{table}", 1, dated=table in stream.DATED)
    return counts_of(spark, root)


def counts_of(spark: SparkSession, root: str) -> DataFrame:
    alerts, geo, stats = (read_table(spark, f"{root}/{t}") for t in ("alerts", "attacks_geo", "traffic_stats"))
    return alerts.agg(F.count("*").alias("alerts")).select(
        "alerts", geo.agg(F.count("*")).scalar().alias("attacks_geo"),
        stats.agg(F.sum("total_packets")).scalar().alias("total_packets"),
    )


@query
def recovery(spark, folder):
    """Row counts after the stream failed in the middle of its second batch and was started again."""
    root = scratch_dir(spark, "recovery")

    class Failing(stream.FanOut):
        def __call__(self, batch, batch_id):
            if batch_id == 1:
                write_batch(batch.limit(10), self.path("alerts"), batch_id)
                raise RuntimeError("stopped for the test")
            super().__call__(batch, batch_id)

    source = wire_stream(spark, folder, shares=3)
    try:
        finish(stream.start_detection(source, Failing(spark, root), f"{root}/checkpoint", once=True))
    except Exception as failure:  # noqa: BLE001
        if "stopped for the test" not in str(failure):
            raise
    finish(stream.start_detection(source, stream.FanOut(spark, root), f"{root}/checkpoint", once=True))
    return counts_of(spark, root)


@query
def recovery_without_checkpoint(spark, folder):
    """Row counts after the stream failed in its third batch, lost its checkpoint, and was started with a new one."""
    root = scratch_dir(spark, "lost")

    class Failing(stream.FanOut):
        def __call__(self, batch, batch_id):
            if batch_id == 2:
                write_batch(batch.limit(10), self.path("alerts"), batch_id)
                raise RuntimeError("stopped for the test")
            super().__call__(batch, batch_id)

    try:
        finish(stream.start_detection(topic_stream(spark, folder), Failing(spark, root), f"{root}/first", once=True))
    except Exception as failure:  # noqa: BLE001
        if "stopped for the test" not in str(failure):
            raise
    rest = ledger.unseen(topic_stream(spark, folder), root)
    finish(stream.start_detection(rest, stream.FanOut(spark, root), f"{root}/second", once=True))
    return counts_of(spark, root)


@query
def geo_feed_stream(spark, folder):
    """All locations as a stream of their table hands them on, while a batch is replayed and others follow."""
    root = scratch_dir(spark, "feed")
    fan, flows = stream.FanOut(spark, root), tables.stored_flows(spark, folder)
    third = [flows.filter(F.col("flow_id") % 3 == n) for n in range(3)]

    def hand_on() -> None:
        finish(feed.start_geo_feed(feed.read_geo_feed(spark, root), f"{root}/handed", f"{root}/feed", once=True))

    fan(third[0], 0)
    fan(third[1], 1)
    hand_on()
    fan(third[1], 1)
    fan(third[2], 2)
    hand_on()
    rows = read_table(spark, f"{root}/handed")
    return rows.select("flow_id", "src_ip", "attack_type", "severity", "timestamp", "latitude", "longitude", "geo_source")


@query
def stream_timeline_late(spark, folder):
    """The timeline with a lateness of an hour, far below the span of the rows, and its corrections."""
    root = scratch_dir(spark, "late")
    path = tables.dealt(spark, folder)
    half = share_of(tables.files_in(spark, path), tables.TOPIC_RANGES // 2, tables.TOPIC_RANGES)
    raw = read_flow_stream(spark, "text", half, path)
    alerts = detect(clean.clean_all(stream.accepted(stream.flows_from(raw))))
    finish(late.start_late_timeline(alerts, root, f"{root}/checkpoint", lateness=3_600, once=True))
    if read_table(spark, f"{root}/late").isEmpty():
        raise RuntimeError("no row came late")
    return late.read_windows(spark, root)


@query
def stream_timeline(spark, folder):
    root = scratch_dir(spark, "timeline")
    parsed = stream.accepted(stream.flows_from(wire_stream(spark, folder)))
    # Files arrive in no particular order, so a row can be as late as the table's span.
    span = (F.unix_timestamp(F.max("timestamp")) - F.unix_timestamp(F.min("timestamp"))).alias("seconds")
    seconds = tables.stored_flows(spark, folder).agg(span).first()["seconds"] or 0
    counts = windowed_counts(detect(clean.clean_all(parsed)), f"{seconds + 60} seconds")
    running = start_timeline(counts, f"{root}/data", f"{root}/checkpoint", once=True)
    finish(running)
    if dropped_rows(running):
        raise RuntimeError(f"{dropped_rows(running)} rows came too late")
    return read_timeline(spark, f"{root}/data")


# Training

def as_row(spark: SparkSession, training: forest.Training) -> DataFrame:
    """What a training did; on rows as separable as these it must be right on 99 of 100 held-out ones."""
    accurate = (training.holdout_accuracy or 0.0) >= 0.99
    return spark.createDataFrame(
        [(training.rows, training.attacks, training.skipped, accurate)],
        "rows bigint, attacks bigint, skipped string, accurate boolean",
    )


@query
def train_forest(spark, folder):
    return as_row(spark, forest.train(forest.from_lake(read_lake(spark, tables.lake(spark, folder)))))


@query
def retrain(spark, folder):
    versions = Versions(spark, scratch_dir(spark, "models"))
    return as_row(spark, forest.retrain(spark, tables.lake(spark, folder), versions))


@query
def train_csv(spark, folder):
    path = scratch_dir(spark, "csv")
    missed = F.when(F.col("attack_type") == "BENIGN", OTHER_CLASS).otherwise(F.col("attack_type"))
    label = F.when(F.col(LABEL) == 1.0, missed).otherwise("BENIGN")
    labelled = detect(clean.clean_all(tables.stored_flows(spark, folder))).select(*FEATURES, label.alias(" Label"))
    labelled.write.option("header", True).csv(path)
    return as_row(spark, forest.train_csv(spark, path, Versions(spark, scratch_dir(spark, "models"))))


@query
def train_gate(spark, folder):
    """Gates over the whole lake, with a row minimum just met, just missed, and without labels."""
    lake = read_lake(spark, tables.lake(spark, folder))
    labelled = forest.from_lake(lake)
    rows = forest.gate(labelled).rows
    met = forest.gate(labelled, ForestSettings(min_rows=rows))
    missed = forest.gate(labelled, ForestSettings(min_rows=rows + 1))
    unlabelled = forest.from_lake(lake.drop(LABEL))
    outcome = [("met", met.skipped), ("missed", missed.skipped), ("unlabelled", forest.NO_LABEL if unlabelled is None else None)]
    return spark.createDataFrame(outcome, "gate string, skipped string")


@query
def score(spark, folder):
    """All flows scored by the forest: rows by label, and whether 99 of 100 are right."""
    model = forest.ModelCache(tables.models(spark, folder)).current()
    scored = forest.score(clean.clean_all(tables.stored_flows(spark, folder)), model)
    return scored.groupBy(LABEL).agg(
        F.count("*").alias("cnt"), (F.avg((F.col("prediction") == F.col(LABEL)).cast("double")) >= 0.99).alias("right")
    )


@query
def hot_reload(spark, folder):
    """Batches before and after a model is published: the second has forest probabilities."""
    root = scratch_dir(spark, "reload")
    published = tables.models(spark, folder).latest()
    versions = Versions(spark, f"{root}/models")
    fan = stream.FanOut(spark, root, models=versions)
    batch = tables.stored_flows(spark, folder)
    fan(batch, 0)
    versions.publish(published["version"], published["location"])
    fan(batch, 1)
    return read_table(spark, f"{root}/alerts").groupBy("batch_id").agg(
        F.count("*").alias("cnt"), F.count("attack_probability").alias("scored_by_forest")
    )
