"""Stored tables behind the serving queries.

As in a running deployment, flows are scored once and stored; the serving
queries then scan the stored alerts with column pruning and pushed filters. The
table is derived from the given folder on first use and lives in the shared
folder of the session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators import metrics
from netsift.operators.clean import clean_all, training_rows
from netsift.operators.detect import detect, to_alerts
from netsift.operators.forest import from_lake, publish, train
from netsift.operators.pages import minute_counts
from netsift.operators.parse import encode_flows
from netsift.plans import flows
from netsift.session import compiled_methods, scratch_dir
from netsift.sinks.tables import CODEC, DATE, dealt_by_date, read_table, write_table
from netsift.sinks.versions import Versions
from netsift.sources.tables import read_lake

ROWS_PER_PART = 12_500
#: Ranges of offsets of the topic, one for each batch of the stream.
TOPIC_RANGES = 6
TOPIC = "key string, value string, partition int, offset bigint"
RECORD = "value string"
#: Shares of the wire files; a stream of them takes some shares at a time, so its batches do not grow in number.
WIRE_SHARES = 8
_PATHS: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived table, written on first use in this application."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _PATHS:
        path = scratch_dir(spark, name)
        with compiled_methods(spark):
            write(path)
        _PATHS[key] = path
    return _PATHS[key]


def _kept(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    return spark.read.parquet(_stored(spark, folder, name, lambda path: make().write.parquet(path)))


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored alerts of all flows, partitioned by date."""
    path = _stored(spark, folder, "alerts", lambda path: write_table(dealt_alerts(spark, folder), path, dealt=True))
    return read_table(spark, path)


def dealt_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alerts of all flows with their date, ready to be written; only the events are shuffled for it."""
    keyed = flows.keyed(spark, folder)
    dealt = dealt_by_date(keyed.withColumn("timestamp", F.col("t")), keyed.count() // ROWS_PER_PART + 1, "k")
    return to_alerts(detect(clean_all(flows.flows_of(dealt, DATE))), "flow_id", "batch_id", DATE)


def stored_flows(spark: SparkSession, folder: str) -> DataFrame:
    """The stored flow records, with the ingest time that a stream would add."""

    def write(path: str) -> None:
        keyed = flows.keyed(spark, folder)
        # The given table may be a single partition; the parts follow its rows, not the cores at hand.
        parts = keyed.count() // ROWS_PER_PART + 1
        rows = flows.flows_of(keyed.repartition(parts, "k"))
        rows.withColumn("ingest_time", F.col("timestamp")).write.parquet(path)

    return spark.read.parquet(_stored(spark, folder, "flows", write))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned and classified flows, out of the stored ones."""
    return detect(clean_all(flow_table(spark, folder)))


def scored_once(spark: SparkSession, folder: str) -> DataFrame:
    """The same made out of the events, for queries that take a few columns of them and nothing else."""
    keyed = flows.keyed(spark, folder)
    return detect(clean_all(flows.flows_of(keyed.repartition(keyed.count() // ROWS_PER_PART + 1, "k"))))


def flow_table(spark: SparkSession, folder: str) -> DataFrame:
    """The stored flow records without their ingest time."""
    return stored_flows(spark, folder).drop("ingest_time")


def minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Page directory of the stored alerts."""
    return _kept(spark, folder, "minutes", lambda: minute_counts(alerts(spark, folder)))


def wire(spark: SparkSession, folder: str) -> str:
    """Folder of JSON-lines files with all flows in wire format, in several files."""

    def write(path: str) -> None:
        records = stored_flows(spark, folder)
        rows = records.count()
        messages = encode_flows(records).select("value")
        messages.write.option("maxRecordsPerFile", max(rows // WIRE_SHARES, 100)).text(path, compression="gzip")

    return _stored(spark, folder, "wire", write)


def files_in(spark: SparkSession, path: str, fmt: str = "text") -> int:
    """Number of data files that a reader finds in a folder."""
    return len(spark.read.format(fmt).load(path).inputFiles())


def dealt(spark: SparkSession, folder: str) -> str:
    """Folder of the JSON-lines files with the records dealt over them, so that each file spans the whole time."""

    def write(path: str) -> None:
        records = stored_flows(spark, folder)
        parts = max(records.count() // ROWS_PER_PART + 1, TOPIC_RANGES)
        encode_flows(records.repartition(parts)).select("value").write.text(path, compression="gzip")

    return _stored(spark, folder, "dealt", write)


def damaged(spark: SparkSession, folder: str) -> str:
    """Folder of all flows in wire format, some cut off and some with times far in the future or the past.

    One record in a row (``value``). As the topic, it is made out of the events, which alone are dealt over tasks, and
    compressed, as the plain text of a flow takes some hundred times the space of its event.
    """
    k, text = F.col("flow_id"), F.col("value")

    def at(moment: str) -> Column:
        return F.regexp_replace(text, '"timestamp":"[^"]*"', f'"timestamp":"{moment}T00:00:00Z"')

    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    planted = F.when(k % 97 == 5, half).when(k % 89 == 7, at("2999-01-01")).when(k % 83 == 3, at("1970-01-02")).otherwise(text)

    def write(path: str) -> None:
        keyed = flows.keyed(spark, folder)
        dealt = keyed.repartition(keyed.count() // ROWS_PER_PART + 1)
        messages = encode_flows(flows.flows_of(dealt), "flow_id")
        messages.select(planted.alias("value")).write.option("compression", CODEC).parquet(path)

    return _stored(spark, folder, "damaged", write)


def damaged_files(spark: SparkSession, folder: str) -> int:
    """Files of the damaged records."""
    return files_in(spark, damaged(spark, folder), "parquet")


def topic(spark: SparkSession, folder: str) -> str:
    """Folder of the same messages as a topic's records: key, value, partition, offset.

    The offsets are cut into ranges, which are written one after the other in as many files each
    (:func:`topic_files`), so a stream that takes so many files at a time reads one range after the other.
    Each range is made out of its own events: only these are dealt over tasks, and no wide row is read again.
    """

    def write(path: str) -> None:
        keyed = flows.keyed(spark, folder)
        rows, last = keyed.agg(F.count("*"), F.max("k")).first()
        size = last // TOPIC_RANGES + 1
        files = rows // TOPIC_RANGES // ROWS_PER_PART + 1
        place = (F.lit(0).alias("partition"), F.col("flow_id").alias("offset"))
        messages = encode_flows(flows.flows_of(keyed.repartition(files)), "flow_id").select("key", "value", *place)
        for n in range(TOPIC_RANGES):
            # The filter moves below the shuffle, into the scan of the events.
            part = messages.filter(F.col("offset").between(n * size, (n + 1) * size - 1))
            part.write.mode("append").option("compression", CODEC).parquet(path)
            # A task without any row of the range has left no file.
            for _ in range((n + 1) * files - files_in(spark, path, "parquet")):
                spark.createDataFrame([], TOPIC).coalesce(1).write.mode("append").parquet(path)

    return _stored(spark, folder, "topic", write)


def topic_files(spark: SparkSession, folder: str) -> int:
    """Files of one range of the topic's offsets."""
    return files_in(spark, topic(spark, folder), "parquet") // TOPIC_RANGES


def lake(spark: SparkSession, folder: str) -> str:
    """Folder of the training lake with all labelled flows."""
    return _stored(
        spark, folder, "lake", lambda path: training_rows(clean_all(stored_flows(spark, folder))).write.parquet(path)
    )


def models(spark: SparkSession, folder: str) -> Versions:
    """Published models; the first one is trained on the lake."""

    def write(path: str) -> None:
        publish(train(from_lake(read_lake(spark, lake(spark, folder)))), Versions(spark, path))

    return Versions(spark, _stored(spark, folder, "models", write))


def stats(spark: SparkSession, folder: str) -> DataFrame:
    """Traffic statistics per batch, written once as the stream writes them."""
    return _kept(spark, folder, "stats", lambda: metrics.traffic_stats(alerts(spark, folder)))


def model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(spark, folder, "model_metrics", lambda: metrics.model_metrics(alerts(spark, folder)))
