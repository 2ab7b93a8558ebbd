"""Parquet tables that tolerate replays.

Every micro-batch owns the folder that carries its ``batch_id``. Writing a batch
replaces this folder as a whole, so a replay after a failure leaves no row of an
earlier attempt, also where it writes other dates or no rows at all. Tables with
a ``timestamp`` are also partitioned by its date, by which readers prune.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

DATE = "event_date"
#: Half the size of the default for the packed features of the alerts.
CODEC = "zstd"


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE, F.col("timestamp").cast("date"))


def dealt_by_date(df: DataFrame, parts: int | None = None, *keys: str) -> DataFrame:
    """Rows with their date, dealt over tasks by date and in its order.

    For rows that grow wide later on: what is made out of them, row by row, can be
    written by date without being shuffled or sorted once more (``dealt`` below). With
    ``parts``, tasks get even ranges of date and ``keys``, however little they hold
    now; else the rebalance hint gives tasks of even size.
    """
    dated = with_date(df)
    dealt = dated.repartitionByRange(parts, DATE, *keys) if parts else dated.hint("rebalance", DATE)
    return dealt.sortWithinPartitions(DATE)


def write_table(df: DataFrame, path: str, dealt: bool = False) -> None:
    """Write a whole table, partitioned by date.

    The rebalance hint gives files of even size: small dates share a task, and a
    date with very many rows is split over several. Rows that come from
    :func:`dealt_by_date` are written as they lie (``dealt``).
    """
    rows = df if dealt else with_date(df).hint("rebalance", DATE)
    rows.write.mode("overwrite").option("compression", CODEC).partitionBy(DATE).parquet(path)


def write_batch(
    df: DataFrame, path: str, batch_id: int, dated: bool = True, small: bool = False, dealt: bool = False
) -> None:
    """Write the rows of one batch, replacing what an earlier attempt at it wrote.

    ``small`` is for tables of a few rows per batch, which go into one file, and
    ``dealt`` for dated rows that come from :func:`dealt_by_date`.
    """
    rows = df.drop("batch_id")
    rows = with_date(rows) if dated and not dealt else rows
    keys = [DATE] if dated else []
    if not dealt:
        rows = rows.coalesce(1) if small else rows.hint("rebalance", *keys)
    writer = rows.write.mode("overwrite").options(partitionOverwriteMode="static", compression=CODEC)
    (writer.partitionBy(*keys) if keys else writer).parquet(f"{path}/batch_id={batch_id}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written here; ``batch_id`` is BIGINT again."""
    df = spark.read.parquet(path)
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint")) if "batch_id" in df.columns else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds a readable parquet table."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def since(df: DataFrame, moment: Column) -> DataFrame:
    """Rows from a moment on. Tables partitioned by date are pruned by date as well."""
    rows = df.filter(F.col("timestamp") >= moment)
    return rows.filter(F.col(DATE) >= moment.cast("date")) if DATE in df.columns else rows
