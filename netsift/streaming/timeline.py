"""Event-time attack timeline as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.operators.rollups import attacks
from netsift.sinks.tables import read_table, write_batch


def windowed_counts(alerts: DataFrame, lateness: str, width: str = "1 minute") -> DataFrame:
    """Attacks per event-time window and class of an alert stream.

    Rows later than ``lateness`` behind the newest event are dropped, as soon as
    their window is closed. State holds open windows only.
    """
    return (
        attacks(alerts)
        .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width), "attack_type")
        .agg(F.count("*").alias("cnt"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "attack_type", "cnt")
    )


def start_timeline(counts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write every changed window; each batch owns its partition."""
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, dated=False)

    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has dropped so far, in the batches of which the query keeps the progress."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    """The newest count of each window and class, oldest first."""
    changes = read_table(spark, path)
    return (
        changes.groupBy("minute", "attack_type")
        .agg(F.max_by("cnt", "batch_id").alias("cnt"))
        .orderBy("minute", "attack_type")
    )
