"""The location table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netsift.sinks.tables import write_batch

#: How long ids are remembered. Batch folders must not be replaced later than this after they were written.
MEMORY = "2 days"


def read_geo_feed(spark: SparkSession, root: str, memory: str = MEMORY, files: int = 1_000) -> DataFrame:
    """A stream of all locations, each once.

    A replayed batch replaces its folder; its new files bring the same records again,
    which are left out by ``flow_id``. Ids are remembered by the time at which their
    file was written, not by event time, so a record is never too late. Files that
    vanish between their listing and their reading belong to a replaced folder, whose
    new files follow.
    """
    path = f"{root}/attacks_geo"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("ignoreMissingFiles", "true").option("maxFileAge", "30d")
    rows = reader.option("maxFilesPerTrigger", files).parquet(path)
    written = F.col("_metadata.file_modification_time").alias("written")
    once = rows.select(*schema.names, written).withWatermark("written", memory).dropDuplicatesWithinWatermark(["flow_id"])
    return once.drop("written", "batch_id", "event_date")


def start_geo_feed(feed: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Hand every new location on to a table, batch by batch."""
    trigger = {"availableNow": True} if once else {"processingTime": "5 seconds"}

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, dated=False)

    return (
        feed.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
