"""Relational sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str, table: str, partitions: int = 2, batch_rows: int = 500, truncate: bool = False, **connection: str
) -> dict[str, str]:
    """Options of a relational write: batched inserts over ``partitions`` connections without a transaction."""
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "isolationLevel": "NONE",
        "numPartitions": str(partitions),
        **connection,
    }
    return options | {"truncate": "true"} if truncate else options


def jdbc_append(df: DataFrame, **options) -> None:
    """Append the rows to a relational table."""
    df.write.mode("append").format("jdbc").options(**jdbc_write_options(**options)).save()


def jdbc_overwrite(df: DataFrame, **options) -> None:
    """Replace the rows of a relational table; the table itself stays."""
    df.write.mode("overwrite").format("jdbc").options(**jdbc_write_options(truncate=True, **options)).save()
