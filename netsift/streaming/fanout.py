"""Detection stream: each micro-batch is scored once and written to every table."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.config import DEFAULTS, Settings
from netsift.functions.times import read_wire_time
from netsift.operators.clean import clean_all, training_rows
from netsift.operators.detect import to_alerts
from netsift.operators.forest import ModelCache, score
from netsift.operators.geo import attacks_geo, geo_point
from netsift.operators.metrics import METRICS, STATS, attack_summary, batch_counts, with_scores, with_shares
from netsift.operators.pages import minute_counts
from netsift.operators.parse import parse_flows
from netsift.operators.ranges import RangeIndex
from netsift.operators.rollups import attack_cube, attack_ips, rollups_from
from netsift.operators.serve import geo_after_batch, latest_moment
from netsift.operators.sketches import attackers_by_hour, frequent_ips, profile_parts
from netsift.plans.dashboard import sections
from netsift.session import compiled_methods
from netsift.sinks.tables import DATE, dealt_by_date, exists, read_table, write_batch
from netsift.sinks.versions import Versions
from netsift.sources.streams import record_key
from netsift.streaming import ledger

# Tables that are partitioned by date, and tables whose rows grow with the batch.
DATED = ("alerts", "attacks_geo")
LARGE = ("alerts", "attacks_geo", "attack_ips", "attack_cube", "training", "rejects")
# All tables of a batch.
TABLES = (
    "alerts", "attacks_geo", "attack_ips", "attack_cube", "attack_summary", "model_metrics", "traffic_stats", "training",
    "rejects", "alert_minutes", "attackers", "frequent_ips", "profiles", "progress",
)
# Columns that only tell of rejected records.
REJECTION = ("reject_reason", "raw_value")


def reject_reason(when: Column, ingest: Column, settings: Settings = DEFAULTS) -> Column:
    """Why a parsed record is no flow: malformed, or an event time too far from the ingest time; NULL for flows."""
    bare = F.col("src_ip").isNull() & F.col("dst_ip").isNull() & F.col("protocol").isNull()
    limits = settings.stream
    return (
        F.when(bare, "malformed")
        .when(when > ingest + F.make_dt_interval(mins=F.lit(limits.future_minutes)), "future")
        .when(when < ingest - F.make_dt_interval(days=F.lit(limits.past_days)), "past")
    )


def flows_from(raw: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Parsed flows of a raw stream, with event and ingest time, ``reject_reason`` and the text of rejected records.

    The event time falls back to the ingest time, which is constant within a
    micro-batch, also when the batch is replayed. Row, reject and malformed-record
    counts of each batch appear in the query's progress.
    """
    keyed = raw if "flow_id" in raw.columns else raw.withColumn("flow_id", record_key(raw.columns, "raw_value"))
    parsed = parse_flows(keyed, "flow_id", "raw_value")
    ingest = F.current_timestamp().cast("timestamp_ntz")
    timed = parsed.withColumns(
        {"timestamp": F.coalesce(read_wire_time(F.col("timestamp")), ingest), "ingest_time": ingest}
    )
    reason = reject_reason(F.col("timestamp"), F.col("ingest_time"), settings)
    judged = timed.withColumn("reject_reason", reason).withColumn(
        "raw_value", F.when(F.col("reject_reason").isNotNull(), F.col("raw_value"))
    )
    return judged.observe(
        "flows", F.count("*").alias("rows"), F.count_if(F.col("reject_reason") == "malformed").alias("malformed"),
        F.count_if(F.col("src_ip").isNull()).alias("missing_src_ip"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
    )


def accepted(flows: DataFrame) -> DataFrame:
    """The flows among judged records."""
    return flows.filter(F.col("reject_reason").isNull()).drop(*REJECTION)


@dataclass
class FanOut:
    """``foreachBatch`` function. All its writes are safe to repeat."""

    spark: SparkSession
    root: str
    models: Versions | None = None
    ranges: DataFrame | None = None
    settings: Settings = DEFAULTS
    cache: ModelCache = field(init=False)
    index: RangeIndex | None = field(init=False, default=None)
    firsts: dict[str, int] = field(init=False, default_factory=dict)

    def __post_init__(self):
        self.cache = ModelCache(self.models)
        if self.ranges is not None:
            self.index = RangeIndex.build(self.ranges, self.settings.geo.broadcast_rows)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _write(self, table: str, df: DataFrame, batch_id: int) -> tuple[str, int]:
        start = time.monotonic()
        write_batch(df, self.path(table), batch_id, table in DATED, small=table not in LARGE, dealt=DATE in df.columns)
        return table, int((time.monotonic() - start) * 1000)

    def _write_all(self, tables: dict[str, DataFrame], batch_id: int) -> list[tuple[str, int]]:
        """Write all tables of a batch side by side, as most of them are tiny; fails if one fails."""
        with ThreadPoolExecutor(self.settings.stream.writers) as pool:
            tasks = [
                pool.submit(inheritable_thread_target(self.spark)(self._write), table, df, batch_id)
                for table, df in tables.items()
            ]
            return [task.result() for task in tasks]

    def number(self, batch_id: int) -> int:
        """The number under which a batch is stored: batches of a new checkpoint follow the complete ones."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query is None:
            return batch_id
        if query not in self.firsts:
            self.firsts[query] = ledger.first_batch(self.spark, self.root, query)
            if batch_id == 0:
                ledger.discard(self.spark, self.root, TABLES, self.firsts[query])
        return self.firsts[query] + batch_id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with compiled_methods(batch.sparkSession):
            self._run(batch, self.number(batch_id))

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if "reject_reason" not in batch.columns:
            batch = batch.withColumns({c: F.lit(None).cast("string") for c in REJECTION})
        judged = score(clean_all(batch), self.cache.current()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            start = time.monotonic()
            counts = batch_counts(judged.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "batch_id", "reject_reason")
            # One row for the flows and one for each reason.
            by_reason = {r["reject_reason"]: r for r in counts.collect()}
            if not by_reason:
                return
            log = [("score", int((time.monotonic() - start) * 1000))]
            tables = {}
            if set(by_reason) != {None}:
                kept = ("flow_id", *REJECTION, "timestamp", "ingest_time")
                tables["rejects"] = judged.filter(F.col("reject_reason").isNotNull()).select(*[c for c in kept if c in judged.columns])
            row = by_reason.get(None)
            if row is not None:
                tables |= self._tables(accepted(judged), spark.createDataFrame([row], counts.schema), batch_id)
            log += self._write_all(tables, batch_id)
            # What an earlier attempt has left in tables that this one does not write.
            ledger.discard(spark, self.root, [t for t in TABLES if t not in tables and t != "progress"], batch_id)
            samples = row["total_samples"] if row is not None else 0
            progress = spark.createDataFrame(
                [(stage, samples, millis) for stage, millis in log if stage != "rejects"],
                "stage string, batch_rows bigint, millis bigint",
            )
            # Nothing rests on the progress, so the batch may be complete before it is written.
            with ThreadPoolExecutor(2) as pool:
                target = inheritable_thread_target(spark)
                last = [
                    pool.submit(target(self._write), "progress", progress, batch_id),
                    pool.submit(target(ledger.record), spark, self.root, batch_id, samples),
                ]
                for task in last:
                    task.result()
        finally:
            judged.unpersist()

    def _tables(self, scored: DataFrame, one: DataFrame, batch_id: int) -> dict[str, DataFrame]:
        """All tables of the flows of a batch; ``one`` has their counts."""
        light = to_alerts(scored, "flow_id").drop("raw_features")
        tables = {
            # Dealt before the features are packed, as their text is several times as large.
            "alerts": to_alerts(dealt_by_date(scored), "flow_id", "ingest_time", "attack_probability", DATE),
            "attacks_geo": geo_point(attacks_geo(light, "flow_id", ranges=self.index, geo=self.settings.geo)),
            "attack_ips": attack_ips(light),
            "attack_cube": attack_cube(light),
            "attack_summary": attack_summary(scored, probability=True),
            "model_metrics": with_scores(one).select(*METRICS),
            "traffic_stats": with_shares(one).select(*STATS),
            "alert_minutes": minute_counts(light),
            "attackers": attackers_by_hour(light),
            "frequent_ips": frequent_ips(light),
            "profiles": profile_parts(scored),
        }
        if batch_id % self.settings.stream.training_every == 0:
            tables["training"] = training_rows(scored)
        return tables


def start_detection(
    raw: DataFrame,
    fanout: FanOut,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Start the detection stream; with ``once`` it stops after the data that is there now."""
    trigger = {"availableNow": True} if once else {"processingTime": fanout.settings.stream.trigger}
    writer = (
        flows_from(raw, fanout.settings)
        .writeStream.outputMode("append")
        .foreachBatch(fanout)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    # The query keeps the settings of the session it is started in; records are parsed by them.
    with compiled_methods(raw.sparkSession):
        return writer.start()


def refresh_rollups(spark: SparkSession, root: str) -> str:
    """Recompute the five rollups from the per-batch counts and publish them together.

    The counts are far smaller than the alerts, so a refresh does not read those.
    """
    versions = Versions(spark, f"{root}/rollups")
    version, location = versions.new_location()
    parts = rollups_from(read_table(spark, f"{root}/attack_cube"), read_table(spark, f"{root}/attack_ips"))

    def write(name: str) -> None:
        parts[name].hint("rebalance").write.mode("overwrite").parquet(f"{location}/{name}")

    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), parts))
    versions.publish(version, location)
    return location


def read_rollup(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A rollup as last refreshed."""
    return spark.read.parquet(f"{Versions(spark, f'{root}/rollups').latest()['location']}/{name}")


def overall_summary(summary: DataFrame) -> DataFrame:
    """The attack summary over all batches, from the per-batch summaries."""
    weighted = F.sum(F.col("avg_confidence") * F.col("count")) / F.sum("count")
    return summary.groupBy("attack_type").agg(
        F.sum("count").alias("count"), F.max("last_seen").alias("last_seen"), weighted.alias("avg_confidence")
    )


def stored_dashboard(spark: SparkSession, root: str, as_of: Column | datetime | None = None) -> dict[str, DataFrame]:
    """The dashboard sections out of the stream's tables and the refreshed rollups.

    The alerts are read for the last day only; everything else comes from small tables.
    """
    alerts = read_table(spark, f"{root}/alerts")
    return sections(
        alerts,
        read_table(spark, f"{root}/traffic_stats"),
        overall_summary(read_table(spark, f"{root}/attack_summary")),
        latest_moment(alerts) if as_of is None else as_of,
        distribution=read_rollup(spark, root, "attack_distribution"),
        ips=read_rollup(spark, root, "top_ips"),
    )


def latest_summary(summary: DataFrame) -> DataFrame:
    """The attack summary of the newest batch."""
    return summary.filter(F.col("batch_id") == summary.agg(F.max("batch_id")).scalar())


def raw_bridge(raw: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Copy raw records with their ingest time into a table; empty batches write nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_batch(batch, path, batch_id, dated=False)

    trigger = {"availableNow": True} if once else {"processingTime": DEFAULTS.stream.trigger}
    stamped = raw.select("raw_value", F.current_timestamp().cast("timestamp_ntz").alias("timestamp"))
    return (
        stamped.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def poll_geo(spark: SparkSession, root: str, after_batch: int) -> DataFrame | None:
    """Locations written after a batch; None while there is no table yet."""
    path = f"{root}/attacks_geo"
    return geo_after_batch(read_table(spark, path), after_batch) if exists(spark, path) else None
