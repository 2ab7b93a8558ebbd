"""Address ranges, nested or overlapping, of either IP version.

Addresses and ends of ranges are keys of 16 bytes whose order is that of the
addresses; IPv4 lies in its mapped block, so both versions share one order. Ranges
are first cut into pieces that do not overlap (:func:`pieces_of`); where several
hold an address, the innermost counts: the one that starts last, then the one that
ends first. After that an address needs one lookup only: the last piece that starts
at or before it. Few pieces go to every task, which looks addresses up by binary
search; many are sorted together with the different addresses.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.functions.ip import with_ip_key
from netsift.session import scratch_dir

WIDTH = 16
TOP = (1 << 128) - 1
PIECES = "first binary, last binary, _lat double, _lon double"
#: Ranges, or pieces and addresses, of one block of keys on average.
BLOCK_ROWS = 100_000


def keyed_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges as ``first, last`` (keys, inclusive), ``_lat, _lon``; one row for each pair of ends.

    ``ip_from`` and ``ip_to`` are IPv4 numbers (BIGINT), literals of either version, or keys already. Ranges that end
    before they start or have an end that is no address are left out.
    """
    out = ranges.select("ip_from", "ip_to", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    for column, key in (("ip_from", "first"), ("ip_to", "last")):
        kind = dict(out.dtypes)[column]
        if kind == "binary":
            out = out.withColumn(key, F.col(column))
        elif kind == "string":
            out = with_ip_key(out, column, key)
        else:
            number = F.when(F.col(column).between(0, 2**32 - 1), F.lpad(F.hex(F.col(column).cast("bigint")), 8, "0"))
            out = out.withColumn(key, F.unhex(F.concat(F.lit("0" * 20 + "FFFF"), number)))
    # Of equal ranges the one with the smallest coordinates counts.
    place = F.min(F.struct("_lat", "_lon")).alias("_place")
    return out.filter("first <= last").groupBy("first", "last").agg(place).select("first", "last", "_place.*")


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _key(number: int) -> bytes:
    return number.to_bytes(WIDTH, "big")


def sweep(rows: list[tuple[int, int, float, float]], low: int, high: int) -> Iterator[tuple[int, int, float, float]]:
    """Pieces between ``low`` and ``high`` out of ranges (first, last, lat, lon), in order; the innermost range wins.

    At each end of a range, the open ranges lie in a heap with the innermost on top; closed ones leave it once they
    come to the top.
    """
    rows = sorted((max(a, low), b, a, lat, lon) for a, b, lat, lon in rows if a <= high and b >= low)
    stops = sorted({r[0] for r in rows} | {min(r[1], high) + 1 for r in rows})
    open_: list[tuple] = []
    at = 0
    for here, after in zip(stops, stops[1:]):
        while at < len(rows) and rows[at][0] == here:
            _, last, start, lat, lon = rows[at]
            heapq.heappush(open_, (-start, last, lat is None, lat or 0.0, lon is None, lon or 0.0, lat, lon))
            at += 1
        while open_ and open_[0][1] < here:
            heapq.heappop(open_)
        if open_:
            yield here, after - 1, open_[0][6], open_[0][7]


def _splitters(keys: DataFrame, rows: int) -> list[bytes]:
    """Keys that divide ``rows`` keys into blocks of about ``BLOCK_ROWS``, out of a sample of some tens per block."""
    blocks = max(1, -(-rows // BLOCK_ROWS))
    if blocks == 1:
        return []
    share = min(1.0, 50 * blocks / rows)
    picked = keys.filter(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    sample = sorted({bytes(r["key"]) for r in picked.limit(200 * blocks).collect()})
    places = (len(sample) * n // blocks for n in range(1, blocks))
    return sorted({sample[p] for p in places}) if sample else []


def _with(df: DataFrame, fields: dict[str, str], add: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with further columns that ``add`` makes out of whole batches."""
    names = [*df.columns, *fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *add(batch)], names)

    more = df.select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields.items()]).schema
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *more.fields]))


def _with_blocks(df: DataFrame, splitters: list[bytes], **places: str) -> DataFrame:
    """The numbers of the blocks that keys lie in, as new columns (new name = key column)."""
    if not splitters:
        return df.withColumns({name: F.lit(0).cast("bigint") for name in places})
    edges = np.array(splitters, f"S{WIDTH}")

    def add(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(np.searchsorted(edges, _fixed(batch.column(key)), "right").astype(np.int64)) for key in places.values()]

    return _with(df, {name: "bigint" for name in places}, add)


def _fixed(keys: pa.Array) -> np.ndarray:
    """Keys of 16 bytes as a numpy array; null as all zero bytes."""
    filled = keys.cast(pa.binary()).fill_null(bytes(WIDTH)).cast(pa.binary(WIDTH))
    return np.frombuffer(filled.buffers()[1], f"S{WIDTH}", len(filled), filled.offset * WIDTH) if len(filled) else np.zeros(0, f"S{WIDTH}")


def _touched(rows: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Ranges or pieces, repeated once for each block that they touch, as ``_block``."""
    ends = _with_blocks(rows, splitters, _a="first", _b="last")
    return ends.withColumn("_block", F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")


def pieces_of(ranges: DataFrame) -> DataFrame:
    """Non-overlapping ``first, last, _lat, _lon`` out of the ranges, in blocks of the keys."""
    keyed = keyed_ranges(ranges)
    splitters = _splitters(keyed.select(F.col("first").alias("key")), keyed.count())
    edges = [0, *map(_number, splitters), TOP + 1]

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        block = int(part["_block"].iloc[0])
        clean = part[["_lat", "_lon"]].astype(object).where(part[["_lat", "_lon"]].notna(), None)
        rows = list(zip(map(_number, part["first"]), map(_number, part["last"]), clean["_lat"], clean["_lon"]))
        found = list(sweep(rows, edges[block], edges[block + 1] - 1))
        return pd.DataFrame(
            {"first": [_key(f[0]) for f in found], "last": [_key(f[1]) for f in found],
             "_lat": pd.Series([f[2] for f in found], dtype=float), "_lon": pd.Series([f[3] for f in found], dtype=float)}
        )

    touched = _touched(keyed, splitters)
    return touched.groupBy("_block").applyInPandas(cut, PIECES)


@dataclass(frozen=True)
class RangeIndex:
    """Pieces of a range table, ready for lookups: in the driver's memory if they are few, else stored.

    It is a snapshot; its size was checked when it was made.
    """

    spark: SparkSession
    rows: int
    table: pa.Table | None = None
    path: str | None = None

    @classmethod
    def build(cls, ranges: DataFrame, limit: int) -> RangeIndex:
        """Cut the ranges; up to ``limit`` pieces are held in memory."""
        spark = ranges.sparkSession
        path = scratch_dir(spark, "ranges")
        pieces_of(ranges).write.parquet(path)
        stored = spark.read.schema(PIECES).parquet(path)
        rows = stored.count()
        if rows > limit:
            return cls(spark, rows, path=path)
        return cls(spark, rows, table=stored.toArrow().combine_chunks().sort_by("first"))

    def pieces(self) -> DataFrame:
        if self.path:
            return self.spark.read.schema(PIECES).parquet(self.path)
        return self.spark.createDataFrame(self.table.to_pandas(), PIECES) if self.rows else self.spark.createDataFrame([], PIECES)

    def located(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with ``_lat`` and ``_lon`` by binary search; no row moves. For indexes held in memory."""
        empty = pa.array([], pa.binary())
        first, last = (
            _fixed(self.table.column(c).combine_chunks() if self.rows else empty) for c in ("first", "last")
        )
        places = [self.table.column(c).to_numpy(zero_copy_only=False) if self.rows else np.zeros(0) for c in ("_lat", "_lon")]
        shared = self.spark.sparkContext.broadcast((first, last, *places))

        def find(batch: pa.RecordBatch) -> list[pa.Array]:
            first, last, lat, lon = shared.value
            keys = batch.column(key)
            wanted = _fixed(keys)
            at = np.searchsorted(first, wanted, "right") - 1
            held = (at >= 0) & keys.is_valid().to_numpy(zero_copy_only=False)
            held[held] = wanted[held] <= last[at[held]]
            got = [np.full(len(wanted), np.nan) for _ in "ab"]
            for values, source in zip(got, (lat, lon)):
                values[held] = source[at[held]]
            return [pa.array(g, pa.float64(), from_pandas=True) for g in got]

        return _with(df, {"_lat": "double", "_lon": "double"}, find)


def lookup_sorted(addresses: DataFrame, pieces: DataFrame, key: str, rows: int) -> DataFrame:
    """``addresses`` with ``_lat`` and ``_lon``: both sides are sorted together and the last piece is carried forward.

    ``rows`` is about how many rows both have together. Blocks are cut by a sample of both, so neither many pieces nor
    many addresses in one place make a block large.
    """
    every = pieces.select(F.col("first").alias("key")).union(addresses.select(key)).filter("key IS NOT NULL")
    splitters = _splitters(every, rows)
    # A piece that begins before its block counts from the block's first key on.
    starts = _touched(pieces, splitters).select(
        "_block", F.col("first").alias("_key"), F.struct("last", "_lat", "_lon").alias("_piece")
    )
    points = _with_blocks(addresses.filter(F.col(key).isNotNull()), splitters, _block=key).select(
        "_block", F.col(key).alias("_key"), F.struct(*addresses.columns).alias("_row")
    )
    # A piece comes before the addresses at its first key, as it has no row.
    order = Window.partitionBy("_block").orderBy("_key", F.col("_row").isNotNull())
    both = starts.unionByName(points, allowMissingColumns=True).withColumn(
        "_piece", F.last("_piece", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    holds = F.col("_key") <= F.col("_piece.last")
    found = both.filter("_row IS NOT NULL").select(
        "_row.*", F.when(holds, F.col("_piece._lat")).alias("_lat"), F.when(holds, F.col("_piece._lon")).alias("_lon")
    )
    return found.unionByName(addresses.filter(F.col(key).isNull()), allowMissingColumns=True)
