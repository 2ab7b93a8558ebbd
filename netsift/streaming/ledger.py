"""Which batches of a stream are complete, and how a stream goes on without its checkpoint.

A batch is complete once all its tables are written; then one row is appended to
the ledger, for every attempt anew. The ledger is split by the hour of writing, so a
reader that knows when it last looked opens the newest hours only, and still sees
replays of old batches.

A checkpoint numbers its batches from 0. Each query (a checkpoint's life) therefore
gets a first batch number of its own, after the last complete batch: a stream whose
checkpoint was lost goes on without touching what is stored.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.sinks.tables import DATE, exists, read_table

LEDGER = "batch_id bigint, attempt bigint, rows bigint, hour bigint"
EPOCHS = "query string, first bigint"
HOUR = 3_600_000_000_000
#: Bit sets of 64 ids each that are sent to every executor.
BROADCAST_WORDS = 2_000_000


def record(spark: SparkSession, root: str, batch_id: int, rows: int) -> None:
    """Note that all tables of a batch are written; ``rows`` of them are alerts."""
    now = time.time_ns()
    row = spark.createDataFrame([(batch_id, now, rows, now // HOUR)], LEDGER)
    row.coalesce(1).write.mode("append").partitionBy("hour").parquet(f"{root}/ledger")


def attempts(spark: SparkSession, root: str, after: int | None = None) -> DataFrame:
    """Complete batches (batch_id, attempt, rows), each attempt for itself; only those written later than ``after``."""
    if not exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], LEDGER).drop("hour")
    rows = spark.read.schema(LEDGER).parquet(f"{root}/ledger")
    if after is not None:
        rows = rows.filter((F.col("hour") >= after // HOUR) & (F.col("attempt") > after))
    return rows.drop("hour")


def last_complete(spark: SparkSession, root: str) -> int:
    """The highest number of a complete batch; -1 before the first."""
    newest = attempts(spark, root).agg(F.max("batch_id")).first()[0]
    return -1 if newest is None else newest


def first_batch(spark: SparkSession, root: str, query: str) -> int:
    """The number of a query's batch 0, fixed when the query is first seen."""
    path = f"{root}/epochs"
    if exists(spark, path):
        known = spark.read.schema(EPOCHS).parquet(path).filter(F.col("query") == query).agg(F.min("first")).first()[0]
        if known is not None:
            return known
    first = last_complete(spark, root) + 1
    spark.createDataFrame([(query, first)], EPOCHS).coalesce(1).write.mode("append").parquet(path)
    return first


def discard(spark: SparkSession, root: str, tables: list[str], batch_id: int) -> None:
    """Empty what an attempt at a batch has left that was never completed, before another query writes this number."""
    for table in tables:
        path = f"{root}/{table}/batch_id={batch_id}"
        if exists(spark, path):
            empty = spark.createDataFrame([], spark.read.parquet(path).schema)
            writer = empty.write.mode("overwrite").option("partitionOverwriteMode", "static")
            (writer.partitionBy(DATE) if DATE in empty.columns else writer).parquet(path)


def stored_ids(spark: SparkSession, root: str) -> DataFrame:
    """``flow_id`` of all records in complete batches, rejected ones included."""
    last = last_complete(spark, root)
    ids = spark.createDataFrame([], "flow_id bigint")
    for table in ("alerts", "rejects"):
        if exists(spark, f"{root}/{table}"):
            ids = ids.union(read_table(spark, f"{root}/{table}").filter(F.col("batch_id") <= last).select("flow_id"))
    return ids


def starting_offsets(spark: SparkSession, root: str, topic: str) -> str | None:
    """Where a topic source goes on after the stored records, as its ``startingOffsets``; None if nothing is stored.

    The places come from the stored keys (16 bits of partition, 48 of offset). Partitions without any
    stored record are left out, so the source needs the other partitions' offsets to be added (-2: earliest).
    """
    partition = F.shiftrightunsigned("flow_id", 48)
    offset = F.col("flow_id").bitwiseAND(F.lit((1 << 48) - 1))
    ends = stored_ids(spark, root).groupBy(partition.alias("partition")).agg(F.max(offset).alias("offset"))
    # One row for each partition of the topic.
    found = {str(r["partition"]): r["offset"] + 1 for r in ends.collect()}
    return json.dumps({topic: dict(sorted(found.items(), key=lambda p: int(p[0])))}) if found else None


def stored_words(spark: SparkSession, root: str) -> DataFrame:
    """The same as bit sets: ``_word`` is an id without its last six bits, ``_bits`` has a bit for each of its ids."""
    ids = stored_ids(spark, root).filter(F.col("flow_id").isNotNull())
    bit = F.expr("shiftleft(1L, CAST(flow_id & 63 AS INT))")
    return ids.groupBy(F.shiftright("flow_id", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def unseen(raw: DataFrame, root: str, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The records of a stream that no complete batch holds, for sources that cannot start at an offset.

    While the stored ids fit into ``broadcast_words`` bit sets, these go to every task and no record is
    shuffled. Ids that lie further apart, such as hashes, are joined one by one.
    """
    spark = raw.sparkSession
    words = stored_words(spark, root)
    if words.limit(broadcast_words + 1).count() > broadcast_words:
        return raw.join(stored_ids(spark, root), "flow_id", "left_anti")
    marked = raw.withColumn("_word", F.shiftright("flow_id", 6)).join(F.broadcast(words), "_word", "left")
    found = F.expr("_bits & shiftleft(1L, CAST(flow_id & 63 AS INT))") != 0
    return marked.filter(F.coalesce(~found, F.lit(True))).select(*raw.columns)
