"""Published versions of something that readers must never see half-written.

A version is written to a folder of its own; then one row is appended to a
small registry table. Readers take the newest registered version, so a refresh
never disturbs them. The registry is also the history.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from netsift.sinks.tables import exists

SCHEMA = "version bigint, location string, row_count bigint, score double"


@dataclass(frozen=True)
class Versions:
    spark: SparkSession
    root: str

    @property
    def registry(self) -> str:
        return f"{self.root}/registry"

    def new_location(self) -> tuple[int, str]:
        version = time.time_ns()
        return version, f"{self.root}/versions/{version}"

    def publish(self, version: int, location: str, row_count: int | None = None, score: float | None = None) -> None:
        row = self.spark.createDataFrame([(version, location, row_count, score)], SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.registry)

    def history(self):
        return self.spark.read.schema(SCHEMA).parquet(self.registry)

    def latest(self) -> Row | None:
        """The newest version, or None before the first."""
        if not exists(self.spark, self.registry):
            return None
        newest = self.history().agg(F.max_by(F.struct("*"), "version").alias("newest")).first()
        return newest["newest"]
