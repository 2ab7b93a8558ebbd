"""Batch sources: training files, parquet tables and relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from netsift.functions.names import normalize_all
from netsift.schema import FEATURES


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to normalised names; changes the schema only."""
    return df.toDF(*normalize_all(df.columns))


def read_training_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Labelled CSV with a header, under normalised column names.

    By default the known features are typed as DOUBLE from the header alone and
    all other columns stay text, which saves the extra pass over the data that
    ``infer=True`` costs.
    """
    reader = spark.read.option("header", True)
    if infer:
        return normalize_columns(reader.option("inferSchema", True).csv(path))
    header = normalize_all(reader.csv(path).columns)
    schema = T.StructType(
        [T.StructField(c, T.DoubleType() if c in FEATURES else T.StringType()) for c in header]
    )
    return reader.schema(schema).csv(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The parquet training lake."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table given by catalog name or by the path of a parquet folder."""
    return spark.read.parquet(table) if "/" in table else spark.read.table(table)


def jdbc_read_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    **connection: str,
) -> dict[str, str]:
    """Options of a relational scan, split into ``partitions`` ranges of ``column`` when given."""
    options = {"url": url, "dbtable": table, "fetchsize": "500", **connection}
    if column is not None:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    """A relational table, see :func:`jdbc_read_options`."""
    return spark.read.format("jdbc").options(**jdbc_read_options(**options)).load()
