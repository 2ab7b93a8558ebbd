"""Streaming sources of flow records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.config import DEFAULTS, StreamSettings


def topic_options(servers: str, topic: str, settings: StreamSettings = DEFAULTS.stream) -> dict[str, str]:
    """Options of the topic source."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
    }


def payload_text(df: DataFrame, column: str = "value") -> DataFrame:
    """The message payload as one string column ``raw_value``."""
    return df.select(F.col(column).cast("string").alias("raw_value"))


def record_key(columns: list[str], value: str = "value") -> Column:
    """A BIGINT that names a record and is the same whenever the record is read again.

    It is the place in the topic where the source tells partition and offset
    (16 and 48 bits), else a hash of the payload; equal payloads then share it.
    """
    if {"partition", "offset"} <= set(columns):
        return F.shiftleft(F.col("partition").cast("bigint"), 48).bitwiseOR(F.col("offset").cast("bigint"))
    return F.xxhash64(F.col(value).cast("string"))


def read_flow_stream(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    column: str = "value",
    schema: str | None = None,
) -> DataFrame:
    """Raw records of any streaming format as ``flow_id`` (:func:`record_key`) and ``raw_value``.

    ``kafka`` takes :func:`topic_options`; file formats (``text`` for JSON lines)
    take a path and are limited with ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    reader = reader.schema(schema) if schema else reader
    rows = reader.load(path) if path else reader.load()
    return rows.select(record_key(rows.columns, column).alias("flow_id"), F.col(column).cast("string").alias("raw_value"))
