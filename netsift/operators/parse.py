"""Wire records to columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.numbers import INFINITY, as_double, as_int
from netsift.functions.times import wire_time
from netsift.schema import (
    COLUMN_TO_WIRE, DOUBLE_COLUMNS, INT_COLUMNS, NUMBER_SCHEMA, PACKED_SCHEMA, UNREAD, WIRE_SCHEMA, WIRE_TO_COLUMN,
)


def _typed(column: str, text: Column) -> Column:
    if column in INT_COLUMNS:
        return as_int(text)
    return as_double(text) if column in DOUBLE_COLUMNS else text


def parse_flows(raw: DataFrame, *keep: str) -> DataFrame:
    """``raw_value`` to the 46 flow columns, after the columns named in ``keep``.

    A malformed record gives NULLs, a value of the wrong type gives NULL in its own
    column. The JSON text is walked once, with numbers read as such; records that
    hold anything else in a number's place are walked again, each value as text.
    """
    number = {c: F.col(f"_record.{w}") for w, c in WIRE_TO_COLUMN.items() if c in INT_COLUMNS + DOUBLE_COLUMNS}
    # As numbers, some values without a finite one and the integer -0 differ from what their text gives.
    odd = (
        F.col(f"_record.{UNREAD}").isNotNull()
        | F.coalesce(F.greatest(*[F.abs(v) for v in number.values()]) >= F.lit(INFINITY), F.lit(False))
        | F.col("_raw").rlike(r"-0\s*[,}]")
    )
    typed = F.from_json("_raw", NUMBER_SCHEMA, {"columnNameOfCorruptRecord": UNREAD})
    record = raw.select(*keep, F.col("raw_value").alias("_raw")).select("*", typed.alias("_record"))
    both = record.select("*", F.when(odd, F.from_json("_raw", WIRE_SCHEMA)).alias("_text"))

    def value(wire: str, column: str) -> Column:
        plain = number.get(column, F.col(f"_record.{wire}"))
        plain = plain.try_cast("int") if column in INT_COLUMNS else plain
        return F.when(F.col("_text").isNull(), plain).otherwise(_typed(column, F.col(f"_text.{wire}"))).alias(column)

    return both.select(*keep, *[value(w, c) for w, c in WIRE_TO_COLUMN.items()])


def rename_fields(df: DataFrame) -> DataFrame:
    """Wire field names to column names; other columns keep theirs."""
    return df.withColumnsRenamed(WIRE_TO_COLUMN)


def encode_flows(flows: DataFrame, *keep: str) -> DataFrame:
    """Keyed JSON messages (``key``, ``value``) with wire field names, after the columns in ``keep``."""

    def field(column: str) -> Column:
        value = F.col(column)
        if column == "timestamp" and dict(flows.dtypes)[column] != "string":
            value = wire_time(value)
        return value.alias(COLUMN_TO_WIRE[column])

    body = F.struct(*[field(c) for c in COLUMN_TO_WIRE])
    return flows.select(*keep, F.col("src_ip").alias("key"), F.to_json(body).alias("value"))


def packed_features() -> Column:
    """The features and the label as JSON text."""
    return F.to_json(F.struct(*DOUBLE_COLUMNS))


def unpack_features(df: DataFrame, *keep: str, column: str = "raw_features") -> DataFrame:
    """Features and label out of their JSON text, after the columns in ``keep``."""
    return df.select(*keep, F.from_json(column, PACKED_SCHEMA).alias("packed")).select(*keep, "packed.*")
