"""Event-time timeline that also counts rows which come too late for their window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.operators.rollups import attacks
from netsift.sinks.tables import exists, read_table, write_batch

MARK = "seconds bigint"


class LateTimeline:
    """``foreachBatch`` function that splits a batch's counts at the watermark of the batches before it.

    The watermark is the newest event time of all earlier batches less ``lateness``.
    Counts of windows that end after it go to ``windows``; those of windows that
    were closed already go to ``late``. Each batch owns its folders in both and in
    ``marks``, so a replay finds the same watermark and writes the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, lateness: int, width: int = 60):
        self.spark, self.root, self.lateness, self.width = spark, root, lateness, width
        self.marks: dict[int, int] | None = None

    def _newest_before(self, batch_id: int) -> int | None:
        """The newest event time (seconds) of the batches before one; the stored marks are read once, after a start."""
        if self.marks is None:
            path = f"{self.root}/marks"
            rows = read_table(self.spark, path).collect() if exists(self.spark, path) else []
            self.marks = {r["batch_id"]: r["seconds"] for r in rows}
        earlier = [s for b, s in self.marks.items() if b < batch_id]
        return max(earlier, default=None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seconds = F.unix_seconds(F.col("timestamp").cast("timestamp"))
        start = seconds - F.pmod(seconds, F.lit(self.width))
        counts = (
            attacks(batch).groupBy(start.alias("start"), "attack_type")
            .agg(F.count("*").alias("cnt"), F.max(seconds).alias("newest")).persist()
        )
        try:
            newest = counts.agg(F.max("newest")).first()[0]
            before = self._newest_before(batch_id)
            mark = None if before is None else before - self.lateness
            closed = F.lit(False) if mark is None else F.col("start") + self.width <= mark
            minute = F.timestamp_seconds("start").cast("timestamp_ntz").alias("minute")
            for table, rows in (("windows", counts.filter(~closed)), ("late", counts.filter(closed))):
                write_batch(rows.select(minute, "attack_type", "cnt"), f"{self.root}/{table}", batch_id, dated=False, small=True)
            marks = [m for m in (newest, before) if m is not None]
            if marks:
                row = self.spark.createDataFrame([(max(marks),)], MARK)
                write_batch(row, f"{self.root}/marks", batch_id, dated=False, small=True)
                # Only the last marks are needed: a replay concerns the newest batch.
                self.marks = {b: s for b, s in self.marks.items() if b >= batch_id - 2} | {batch_id: max(marks)}
        finally:
            counts.unpersist()


def start_late_timeline(
    alerts: DataFrame, root: str, checkpoint: str, lateness: int, width: int = 60, once: bool = False
) -> StreamingQuery:
    """Keep the timeline of an alert stream; ``lateness`` and ``width`` in seconds. A ``root`` belongs to one checkpoint."""
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return (
        alerts.writeStream.outputMode("append")
        .foreachBatch(LateTimeline(alerts.sparkSession, root, lateness, width))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_windows(spark: SparkSession, root: str, corrected: bool = True) -> DataFrame:
    """Counts by window and class, oldest first; without ``corrected``, as they were when their windows closed."""
    rows = read_table(spark, f"{root}/windows")
    if corrected:
        rows = rows.unionByName(read_table(spark, f"{root}/late"))
    return rows.groupBy("minute", "attack_type").agg(F.sum("cnt").alias("cnt")).orderBy("minute", "attack_type")
