"""Removal of repeated passages, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document; words are removed when
a window that covers them has its word sequence at an earlier place (smaller id,
or same document and earlier start) as well. The positions 0, 1, 3 and 9 modulo
13 are a difference cover: for any two positions there is a shift below 13 that
brings both into it. So two equal windows share an anchor, a run of 20 - 12 = 8
words at a cover position of both, and hashing four of thirteen positions finds
all of them. Steps:

1. Documents are dealt into groups by a hash of the id. A group sends each of
   its anchor hashes once, with its first place, to a bucket of the hash; the
   bucket reports those that several groups sent.
2. Around anchors that repeat, within the group or outside, the group extends
   to whole windows and sends the 96-bit hash of each once, with its first
   place. The bucket reports all but the earliest place.
3. The group removes what its own repeats and the reports cover.

A passage that very many documents share is sent once by each group, so no
bucket grows with the number of its copies. Groups and buckets hold about
``GROUP_BYTES`` of text each, whatever the size of the table; the texts are
shuffled once and read by all three steps. Of a group, a worker holds the rows
as they came, a hash of each word and what one sort of the windows takes; words
are cut and texts rebuilt about a quarter of a megabyte at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from netsift.llm.links import small_batches
from netsift.llm.text import STEP, runs, starts_of, words

WINDOW = 20
# A perfect difference set and its modulus.
COVER, PERIOD = (0, 1, 3, 9), 13
ANCHOR = WINDOW - PERIOD + 1
GROUP_BYTES = 8 << 20
NULL_ID = np.iinfo(np.int64).min
PLACES = "part int, places binary"
SPANS = ArrayType(StructType().add("start", "integer").add("end", "integer"))


def ordered(table: pa.Table, order: np.ndarray, step: int = STEP) -> Iterator[pa.Table]:
    """The rows in the given order, in runs of about ``step`` bytes of text."""
    table = table.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy()
    ends = np.cumsum(sizes[order], dtype=np.int64)
    first = 0
    while first < len(order):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + step, "right")))
        yield table.take(pa.array(order[first:last]))
        first = last


@dataclass
class Group:
    """Hashes of the words of the documents of one group, in ascending order of their ids."""

    order: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Group:
        ids = table.column("doc_id").combine_chunks().fill_null(int(NULL_ID)).to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        counts, hashes = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
        for piece in ordered(table.select(["text"]), order):
            found = words(piece.column("text"))
            counts.append(found.counts)
            hashes.append(found.hashes())
        return cls(order, ids[order], np.cumsum(np.concatenate(counts)), np.concatenate(hashes))

    def place(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and position in its document of each of the given words."""
        row = np.searchsorted(self.first, word, "right") - 1
        return self.ids[row], (word - self.first[row]).astype(np.int32)

    def word(self, ids: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The words at places of this group; all of them where rows repeat an id."""
        low, high = np.searchsorted(self.ids, ids), np.searchsorted(self.ids, ids, "right")
        each = high - low
        row = np.repeat(low, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        at = self.first[row] + np.repeat(position, each)
        return at[at < self.first[row + 1]]

    def anchors(self) -> np.ndarray:
        """Words at which an anchor begins."""
        counts = np.diff(self.first)
        at = np.arange(self.first[-1])
        at -= np.repeat(self.first[:-1], counts)
        at %= PERIOD
        fits = np.isin(np.arange(PERIOD), COVER)[at]
        del at
        fits &= np.repeat(counts >= WINDOW, counts)
        begin = starts_of(self.first, ANCHOR)
        return begin[fits[begin]]


def _sent(fields: list[np.ndarray], key: np.ndarray, buckets: int, part: int) -> pa.Table:
    """Rows (bucket, part, sent) of records in ascending order of ``key``."""
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(at[1:], len(bucket))
    blobs = [b"".join(f[s:e].tobytes() for f in fields) for s, e in zip(at, ends)]
    return pa.table(
        {
            "bucket": pa.array(bucket[at], pa.int32()), "part": pa.array(np.full(len(at), part), pa.int32()),
            "sent": pa.array(blobs, pa.binary()),
        }
    )


def _read(blobs: list[bytes], kinds: tuple[type, ...]) -> list[np.ndarray]:
    """The fields of blobs that hold one array after the other."""
    size = sum(np.dtype(k).itemsize for k in kinds)
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = len(blob) // size, 0
        for field, kind in zip(out, kinds):
            field.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(f) if f else np.zeros(0, k) for f, k in zip(out, kinds)]


def _reports(part: np.ndarray, ids: np.ndarray, position: np.ndarray) -> pa.Table:
    """Rows (part, places) of the given places."""
    order = np.argsort(part, kind="stable")
    part, ids, position = part[order], ids[order], position[order]
    at = np.flatnonzero(np.diff(part, prepend=-1))
    blobs = [ids[s:e].tobytes() + position[s:e].tobytes() for s, e in zip(at, np.append(at[1:], len(part)))]
    return pa.table({"part": pa.array(part[at], pa.int32()), "places": pa.array(blobs, pa.binary())})


def _records(table: pa.Table, kinds: tuple[type, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sending part of each record of a bucket, and the records' fields."""
    blobs = table.column("sent").to_pylist()
    size = sum(np.dtype(k).itemsize for k in kinds)
    part = np.repeat(table.column("part").to_numpy(), [len(b) // size for b in blobs])
    return part, _read(blobs, kinds)


def send_anchors(table: pa.Table, buckets: int) -> pa.Table:
    group = Group.of(table)
    begin = group.anchors()
    key, at = np.unique(runs(group.hashes, begin, ANCHOR), return_index=True)
    return _sent([key, *group.place(begin[at])], key, buckets, table.column("part")[0].as_py())


def repeated_anchors(table: pa.Table) -> pa.Table:
    part, (key, ids, position) = _records(table, (np.uint64, np.int64, np.int32))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    return _reports(part[again], ids[again], position[again])


def _reported(group: Group, reports: pa.Table) -> np.ndarray:
    return group.word(*_read(reports.column("places").to_pylist(), (np.int64, np.int32)))


def window_hashes(group: Group, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each window, and the order by them that keeps earlier places first."""
    a = runs(group.hashes, begin, WINDOW)
    b = runs(group.hashes, begin, WINDOW, 1).astype(np.uint32)
    return a, b, np.lexsort((b, a))


def _leads(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each of sorted hashes differs from the one before."""
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


def send_windows(docs: pa.Table, reports: pa.Table, buckets: int) -> pa.Table:
    if not docs.num_rows:
        return _sent([], np.zeros(0, np.uint64), buckets, 0)
    group = Group.of(docs)
    begin = group.anchors()
    key = runs(group.hashes, begin, ANCHOR)
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count > 1
    again[inverse[np.isin(begin, _reported(group, reports))]] = True
    marked = np.zeros(len(group.hashes) + 1, np.int32)
    marked[begin[again[inverse]] + 1] = 1
    np.cumsum(marked, out=marked)
    start = starts_of(group.first, WINDOW)
    start = start[marked[start + PERIOD] > marked[start]]
    a, b, order = window_hashes(group, start)
    order = order[_leads(a[order], b[order])]
    return _sent([a[order], b[order], *group.place(start[order])], a[order], buckets, docs.column("part")[0].as_py())


def later_windows(table: pa.Table) -> pa.Table:
    part, (a, b, ids, position) = _records(table, (np.uint64, np.uint32, np.int64, np.int32))
    order = np.lexsort((position, ids, b, a))
    part, a, b, ids, position = (x[order] for x in (part, a, b, ids, position))
    lead = np.flatnonzero(_leads(a, b))
    of = np.repeat(lead, np.diff(np.append(lead, len(a))))
    later = (ids != ids[of]) | (position != position[of])
    return _reports(part[later], ids[later], position[later])


def _own_repeats(group: Group) -> np.ndarray:
    """Words at which a window begins that the group has at an earlier place as well."""
    start = starts_of(group.first, WINDOW)
    a, b, order = window_hashes(group, start)
    lead = _leads(a[order], b[order])
    del a, b
    again, lead = np.flatnonzero(~lead), np.flatnonzero(lead)
    of = start[order[lead[np.searchsorted(lead, again) - 1]]]
    again = start[order[again]]
    (ids, position), (ids0, position0) = group.place(again), group.place(of)
    return again[(ids != ids0) | (position != position0)]


def _gone(group: Group, reports: pa.Table) -> np.ndarray:
    """Whether each word goes."""
    covered = np.zeros(len(group.hashes) + 1, np.int32)
    for begin in (_own_repeats(group), _reported(group, reports)):
        np.add.at(covered, begin, 1)
        np.add.at(covered, begin + WINDOW, -1)
    return np.cumsum(covered, out=covered)[:-1] > 0


def remove(docs: pa.Table, reports: pa.Table, schema: pa.Schema) -> pa.Table:
    if not docs.num_rows:
        return schema.empty_table()
    group = Group.of(docs)
    gone = _gone(group, reports)
    order, first = group.order, group.first
    del group
    # Each part is a batch of its own on the way to the JVM, so that no batch is as large as the group.
    parts, row = [], 0
    for piece in ordered(docs, order):
        found = words(piece.column("text"))
        found.data = found.data.tobytes()
        kept, spans, n_removed = [], [], []
        for i in range(piece.num_rows):
            mine = gone[first[row] : first[row + 1]]
            kept.append(found.joined(i, ~mine).decode() if mine.any() else found.joined(i).decode())
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            spans.append([{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)])
            n_removed.append(int(mine.sum()))
            row += 1
        columns = {
            "doc_id": piece.column("doc_id"), "text": piece.column("text"), "rest": piece.column("rest"),
            "n_words": pa.array(found.counts, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(kept, pa.string()), "removed": pa.array(spans, schema.field("removed").type),
        }
        parts.append(pa.table([columns[n] for n in schema.names], schema=schema))
    return pa.concat_tables(parts)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` and n_words, n_removed, kept, removed.

    ``kept`` holds the words that stay, joined by one space; ``removed`` the
    word spans (start, end) that go. Null, empty and wordless texts have no
    words and an empty ``kept``. Texts shorter than a window keep all words.
    Rows that repeat an id count as the same place: they do not remove each
    other's words, as neither is earlier. Null ids count as one document before
    all others. Columns of the result's names are replaced.
    """
    added = ("n_words", "n_removed", "kept", "removed")
    others = [c for c in docs.columns if c not in (id_column, text_column, *added)]
    # A struct keeps other columns apart from the names used here.
    rest = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none"))
    rows = docs.select(
        docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].cast("string").alias("text"), rest.alias("rest")
    )
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(-(-size // GROUP_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))
    result = dealt.select("doc_id", "text", "rest").schema.add("n_words", "long").add("n_removed", "long")
    result = result.add("kept", "string").add("removed", SPANS)
    arrow = to_arrow_schema(result)
    sent = "bucket int, part int, sent binary"
    by_part = dealt.groupBy("part")
    anchors = by_part.applyInArrow(lambda t: send_anchors(t, groups), sent)
    reported = anchors.groupBy("bucket").applyInArrow(repeated_anchors, PLACES).groupBy("part")
    extended = by_part.cogroup(reported).applyInArrow(lambda d, r: send_windows(d, r, groups), sent)
    later = extended.groupBy("bucket").applyInArrow(later_windows, PLACES).groupBy("part")
    done = by_part.cogroup(later).applyInArrow(lambda d, r: remove(d, r, arrow), result)
    names = [F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)]
    return done.select(F.col("doc_id").alias(id_column), F.col("text").alias(text_column), *names, *added)
