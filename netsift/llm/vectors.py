"""Near-duplicate vectors by collision counting on sorted projections.

Unit vectors are projected on many random directions. Each of ``tables`` lists
is sorted by a cell (the signs of ``bits`` projections) and, within it, by one
more projection; two vectors collide in a list when they share the cell and each
lies in the window of ``WINDOW`` around the other. How often a pair at the
threshold collides is known, so the number of lists and the least count are set
such that such a pair passes with probability ``RECALL`` (``calibrated``). Pairs
that pass are verified by their cosine in double precision.

``bits`` grows with the logarithm of the number of vectors, so cells of
unrelated vectors keep their size and the work grows little faster than the
input. With a single projection per list, the windows would hold a fixed share of
all vectors, and the work would grow with the square of the input.

Equal vectors are one class. A pair is counted in the first list in which it
collides; of it only the partners' number and a spanning link leave the task,
never all pairs. For that the vectors themselves and their cells go to every
list; a task takes the places in all lists from the vectors of pairs that share
enough cells, and of no others. Large cells are split into blocks, and each
pair of blocks is a task's unit of work.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.links import components, stored

THRESHOLD = 0.95
WINDOW = 0.5
RECALL = 0.9999
CELL = 32
BLOCK = 1024
#: Pairs out of windows that a task counts at a time.
PAIRS = 1 << 15
SEED = 20240229
# Directions and vectors are rounded to such steps that projections are exact in double precision.
_VECTOR_STEPS, _DIRECTION_STEPS = 1 << 14, 1 << 8


@dataclass(frozen=True)
class Lists:
    """Number of sorted lists, sign bits of a cell, and the least count of collisions."""

    tables: int
    bits: int
    least: int


def _passes(tables: int, p: float, least: int) -> float:
    """Probability of at least ``least`` collisions."""
    return 1 - sum(math.comb(tables, k) * p**k * (1 - p) ** (tables - k) for k in range(least))


def calibrated(vectors: int, threshold: float = THRESHOLD) -> Lists:
    """Lists for so many vectors: a pair at the threshold passes with probability ``RECALL``."""
    bits = max(0, round(math.log2(max(vectors, 1) / CELL)))
    angle = math.acos(threshold)
    spread = math.sqrt(2 - 2 * threshold)
    p = (1 - angle / math.pi) ** bits * math.erf(WINDOW / spread / math.sqrt(2))
    tables = next(t for t in range(2, 100_000) if _passes(t, p, 2) >= RECALL)
    least = max(c for c in range(2, tables) if _passes(tables, p, c) >= RECALL) if tables > 2 else 2
    return Lists(tables, bits, least)


@lru_cache(maxsize=8)
def directions(size: int, lists: Lists) -> np.ndarray:
    rng = np.random.default_rng(SEED + size)
    return np.round(rng.standard_normal((size, lists.tables * (lists.bits + 1))) * _DIRECTION_STEPS)


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def places(units: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Cell and place in the window order of each vector in each list."""
    steps = np.round(units * _VECTOR_STEPS) @ directions(units.shape[1], lists)
    steps = steps.reshape(len(units), lists.tables, lists.bits + 1)
    weights = 1 << np.arange(lists.bits, dtype=np.int64)
    cell = (steps[:, :, :-1] > 0) @ weights if lists.bits else np.zeros(steps.shape[:2], np.int64)
    return cell, steps[:, :, -1] / (_VECTOR_STEPS * _DIRECTION_STEPS)


def spots(units: np.ndarray, lists: Lists, table: int | np.ndarray | None = None) -> np.ndarray:
    """Place of each vector in the window order of each list, or of one list only (each vector's own, if many)."""
    own = directions(units.shape[1], lists)[:, lists.bits :: lists.bits + 1]
    steps = np.round(units * _VECTOR_STEPS)
    found = steps @ own if table is None else np.einsum("ij,ij->i", steps, own.T[np.broadcast_to(table, len(units))])
    return found / (_VECTOR_STEPS * _DIRECTION_STEPS)


def _cell_type(lists: Lists) -> type:
    """Two bytes a cell are enough up to two million vectors."""
    return np.uint16 if lists.bits <= 16 else np.int64


def _roots(n: int, links: np.ndarray) -> np.ndarray:
    """Smallest linked index of each of ``n`` items, by repeated minimum over the links."""
    root = np.arange(n)
    while len(links):
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        new = root.copy()
        np.minimum.at(new, links[:, 0], low)
        np.minimum.at(new, links[:, 1], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _sharing(cell: np.ndarray, i: np.ndarray, j: np.ndarray, least: int) -> np.ndarray:
    """Which of the pairs share enough cells to collide ``least`` times; few unrelated ones do."""
    return (cell[i] == cell[j]).sum(1) >= least


def _within(
    table, size: int, left: slice, right: slice, same: bool, ids, weight, units, lists, threshold, cell=None, group=None
):
    """Links of one group that are first found in this list: index, partners' weight, root.

    With ``group`` (the number of each vector's group) and ``table`` (its list) these are several groups, in a row.

    The right side is put in the order of the list's projection. Around each vector of the left side a window is
    searched there; for the pairs that it gives, collisions are counted over all lists, and only pairs that pass the
    count are verified by their cosine. The cells come with the vectors (``cell``) or are taken from them; most pairs
    are told by the cells alone, so only vectors of the others are projected for all lists.
    """
    cell = (places(units, lists)[0] if cell is None else cell).astype(_cell_type(lists), copy=False)
    table = np.broadcast_to(table, size)
    place = spots(units, lists, table)
    if group is not None:
        # Whole steps that no window reaches across; sums with them are exact.
        place = place + group * (2 * np.ceil(np.abs(place).max()) + 2)
    ordered = right.start + np.argsort(place[right], kind="stable")
    line, queries = place[ordered], np.arange(left.start, left.stop)
    slot = np.full(size, -1)
    at = np.zeros((0, lists.tables))
    low = np.searchsorted(line, place[queries] - WINDOW, "left")
    many = np.searchsorted(line, place[queries] + WINDOW, "right") - low
    upto = np.cumsum(many)
    found, first = [], 0
    while first < len(queries):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] - many[first] + PAIRS, "right")))
        n = many[first:last]
        i = np.repeat(queries[first:last], n)
        j = ordered[np.repeat(low[first:last] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        keep = i < j if same else ids[i] != ids[j]
        i, j = i[keep], j[keep]
        enough = _sharing(cell, i, j, lists.least)
        i, j, first = i[enough], j[enough], last
        if not len(i):
            continue
        new = np.unique(np.concatenate([i, j]))
        new = new[slot[new] < 0]
        slot[new] = len(at) + np.arange(len(new))
        at = np.concatenate([at, spots(units[new], lists)])
        hits = (cell[i] == cell[j]) & (np.abs(at[slot[i]] - at[slot[j]]) <= WINDOW)
        mine = (hits.sum(1) >= lists.least) & (np.argmax(hits, 1) == table[i])
        i, j = i[mine], j[mine]
        linked = np.einsum("ij,ij->i", units[i], units[j]) >= threshold
        found.append(np.stack([i[linked], j[linked]], 1))
    links = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    partners = np.bincount(links[:, 0], weight[links[:, 1]], size) + np.bincount(links[:, 1], weight[links[:, 0]], size)
    linked = np.flatnonzero(partners)
    return linked, partners[linked], _roots(size, links)[linked]


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, as do vectors of different lengths with each other, and
    rows with a null id (component_id null, kept). Rows that repeat an id keep a
    row each and do not count as each other's links. Other columns are ignored.
    """
    single = dict(vectors.dtypes)[vector_column] == "array<float>"
    kind = np.float32 if single else np.float64
    value = vectors[vector_column].cast("array<float>" if single else "array<double>")
    rows = vectors.select(vectors[id_column].cast("bigint").alias("vec_id"), value.alias("v"))

    def to_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("v"):
                a = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    a = v.values.to_numpy(zero_copy_only=False).astype(kind) + kind(0)
                    a = a if np.isfinite(a).all() and a.any() else None
                out.append(None if a is None else a.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "v"])

    read = stored(rows.mapInArrow(to_bytes, "vec_id bigint, v binary"), "vectors")
    usable = read.filter("v is not null and vec_id is not null")
    classes = stored(
        usable.distinct().groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "classes"
    )
    lists = calibrated(classes.count(), threshold)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                raw = batch.column("v").to_pylist()
                sizes = np.array([len(r) for r in raw])
                for size in np.unique(sizes):
                    pick = np.flatnonzero(sizes == size)
                    units = unit(np.frombuffer(b"".join(raw[i] for i in pick), kind).reshape(len(pick), -1))
                    cell, _ = places(units, lists)
                    index = pa.array(np.repeat(pick, lists.tables))
                    all_cells = pa.array([c.tobytes() for c in cell.astype(_cell_type(lists))], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.tile(np.arange(lists.tables, dtype=np.int32), len(pick))), pa.array(cell.ravel()),
                            pa.array(np.full(cell.size, size, np.int32)), batch.column("rep").take(index),
                            batch.column("m").take(index), batch.column("v").take(index),
                            all_cells.take(pa.array(np.repeat(np.arange(len(pick)), lists.tables))),
                        ],
                        ["list", "cell", "size", "rep", "m", "v", "cells"],
                    )

    place = ["list", "cell", "size"]
    dealt = classes.mapInArrow(deal, "list int, cell bigint, size int, rep bigint, m bigint, v binary, cells binary")
    counts = dealt.groupBy(*place).agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(
            F.least("own", j).alias("one"), F.greatest("own", j).alias("two"),
            F.when(F.col("own") <= j, 0).otherwise(1).alias("side"),
        ),
    )
    group = [*place, "one", "two"]
    units_of_work = (
        dealt.join(counts, place).withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("to", F.explode(every)).select(*place, "to.one", "to.two", "to.side", "rep", "m", "v", "cells")
        .repartition(*group).sortWithinPartitions(*group, "side", "rep")
    )

    def work(table: pa.Table, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links of one group, or of several that are no pairs of blocks; ``begin`` is where each begins."""
        number, ids, weight, side = (table.column(c).to_numpy() for c in ("list", "rep", "m", "side"))
        units = unit(np.frombuffer(b"".join(table.column("v").to_pylist()), kind).reshape(len(ids), -1))
        cell = np.frombuffer(b"".join(table.column("cells").to_pylist()), _cell_type(lists)).reshape(len(ids), -1)
        same = table.column("one")[0] == table.column("two")[0]
        middle = len(ids) if same else int((side == 0).sum())
        right = slice(0, middle) if same else slice(middle, len(ids))
        group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(ids)))) if len(begin) > 1 else None
        index, partners, root = _within(
            number, len(ids), slice(0, middle), right, same, ids, weight, units, lists, threshold, cell, group
        )
        return ids[index], partners, ids[root]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in group])
            edge = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            starts = np.concatenate([[0], edge])
            held = table.slice(int(starts[-1]))
            yield from emit(table, keys, starts)
        if held is not None:
            keys = np.stack([held.column(c).to_numpy().astype(np.int64) for c in group])
            yield from emit(held, keys, np.array([0, held.num_rows]))

    def emit(table: pa.Table, keys: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of the groups between ``starts``; small groups in a row are looked at together."""
        size, one, two = (keys[group.index(c)][starts[:-1]] for c in ("size", "one", "two"))
        found, first = [], 0
        while first < len(starts) - 1:
            last = first + 1
            while (
                last < len(starts) - 1 and one[last] == two[last] and one[first] == two[first] and size[last] == size[first]
                and starts[last + 1] - starts[first] <= BLOCK
            ):
                last += 1
            if starts[last] - starts[first] > 1:
                part = table.slice(int(starts[first]), int(starts[last] - starts[first])).combine_chunks()
                found.append(work(part, starts[first:last] - starts[first]))
            first = last
        if found:
            a, partners, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(partners.astype(np.int64)), pa.array(b)], ["a", "partners", "b"]
            )

    links = stored(units_of_work.mapInArrow(compare, "a bigint, partners bigint, b bigint"), "links")
    partners = links.groupBy(F.col("a").alias("rep")).agg(F.sum("partners").alias("partners"))
    placed = components(links.select("a", "b")).withColumnRenamed("node", "rep")
    class_of = (
        classes.join(partners, "rep", "left").join(placed, "rep", "left")
        .select("v", (F.coalesce("partners", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    )
    component = F.coalesce("c", "vec_id")
    keyed = read.withColumn("v", F.when(F.col("vec_id").isNotNull(), F.col("v")))
    return keyed.join(class_of, "v", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
