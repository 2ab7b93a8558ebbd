"""Near-duplicate documents by one-permutation MinHash with banded buckets.

A document is the set of its five-word shingles, A-Z lower-cased. Every shingle
is hashed once; the top bits choose a bin, the smallest hash is the bin's value,
and an empty bin borrows from the filled one that a random order of its own
picks (optimal densification). ``bands`` bands of ``rows`` bins give bucket
keys. Steps:

1. Documents with equal sets form a class; only its smallest id goes on.
2. In each bucket the smallest id is the centre and is paired with all others,
   so a bucket of n gives n - 1 candidates.
3. Candidates are confirmed on the full sets, and components are formed.
4. A star can miss a link between two members that are both unlike the centre.
   So in buckets whose members are still in several components, members of
   different components are compared by sketches of 512 bins, in blocks, and
   those that may reach the threshold are confirmed on the full sets as well.

No candidate is capped. A pair at the threshold misses all buckets with
probability (1 - 0.75**4)**32 = 5e-6 and the sketch test with about 1e-4; both
fall quickly above it, and a component needs only one of its links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.links import components, numbered_texts, small_batches, stored
from netsift.llm.text import mix, pieces, shingles, words

SHINGLE = 5
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
SKETCH_BITS = 9
LEAST_ESTIMATE = 0.67
CHUNK = 1024
SIGNED = (
    "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch binary"
)
#: Similarity is at least PART / WHOLE.
PART, WHOLE = 75, 100


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and where each text's begin."""
    found = words(column)
    h, owner = shingles(found.hashes(lower=True), found.first, SHINGLE)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(column) + 1))


def first_of_bins(h: np.ndarray, cut: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bin and value of every filled bin, for sorted hashes per row."""
    owner = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    bins = (h >> np.uint64(64 - bits)).astype(np.int64)
    new = np.ones(len(h), bool)
    new[1:] = (bins[1:] != bins[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], bins[new], h[new]


def signatures(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Densified signature of every row; rows without shingles stay zero."""
    owner, bins, value = first_of_bins(h, cut, BINS.bit_length() - 1)
    out = np.zeros((len(cut) - 1, BINS), np.uint64)
    filled = np.zeros(out.shape, bool)
    out[owner, bins], filled[owner, bins] = value, True
    count = filled.sum(1)
    for row in np.flatnonzero((count > 0) & (count < BINS)):
        have, lack = np.flatnonzero(filled[row]), np.flatnonzero(~filled[row])
        order = mix((lack[:, None] * BINS + have[None, :] + 1).astype(np.uint64))
        out[row, lack] = out[row, have[np.argmin(order, 1)]]
    return out


def sketches(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """One byte (1 to 255, 0 for empty) of the smallest hash of each of 512 bins."""
    owner, bins, value = first_of_bins(h, cut, SKETCH_BITS)
    out = np.zeros((len(cut) - 1, 1 << SKETCH_BITS), np.uint8)
    out[owner, bins] = (value % np.uint64(255)).astype(np.uint8) + 1
    return out


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Likeness of one sketch to each of many: agreeing bins by bins that either fills."""
    same = ((many == one) & (one != 0)).sum(1)
    return same / np.maximum(((many != 0) | (one != 0)).sum(1), 1)


def signed(docs: DataFrame) -> DataFrame:
    """Set size, 128-bit set hash, bucket keys and sketch of every row (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            h, cut = shingle_sets(batch.column("text"))
            n = np.diff(cut)
            sums = []
            for salt in (0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(salt)))])
                sums.append((total[cut[1:]] - total[cut[:-1]]).view(np.int64))
            signature = signatures(h, cut).reshape(-1, BANDS, ROWS)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), signature.shape[:2]).copy()
            for row in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, row])
            keys = key[n > 0].view(np.int64).ravel()
            offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
            sketch = [row.tobytes() for row in sketches(h, cut)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                    pa.ListArray.from_arrays(offsets, pa.array(keys)), pa.array(sketch, pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )

    return docs.mapInArrow(run, SIGNED)


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the ``pairs (a, b)`` whose full sets reach the threshold.

    The set of ``a`` is sent once to each chunk of about ``CHUNK`` of its
    partners, so that a frequent ``a`` is spread over many tasks; a task holds
    one such set at a time and streams the others.
    """
    sized = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("m")), "a")
    chunk = F.pmod(F.xxhash64("b"), F.ceil(F.col("m") / CHUNK)).cast("int")
    # Stored, as both sides of the pairs are read from it.
    dealt = stored(sized.select("a", "b", chunk.alias("chunk")), "dealt")
    visits = (
        dealt.select(F.col("b").alias("doc_id"), F.struct("a", "chunk", F.lit(1).alias("part")).alias("to"))
        .union(dealt.select("a", F.struct("a", "chunk", F.lit(0)).alias("to")).distinct())
        .groupBy("doc_id")
        .agg(F.collect_list("to").alias("to"))
    )

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            h, cut = shingle_sets(batch.column("text"))
            to = batch.column("to")
            counts = to.value_lengths().to_numpy(zero_copy_only=False)
            flat = to.flatten()
            row = np.repeat(np.arange(batch.num_rows), counts)
            sets = pa.array([h[s:e].tobytes() for s, e in zip(cut, cut[1:])], pa.binary())
            take = pa.array(row)
            for first in range(0, len(row), 256):
                part = slice(first, first + 256)
                fields = flat.slice(first, 256)
                yield pa.RecordBatch.from_arrays(
                    [
                        fields.field("a"), fields.field("chunk"), fields.field("part"),
                        batch.column("doc_id").take(take[part]), sets.take(take[part]),
                    ],
                    ["a", "chunk", "part", "b", "hashes"],
                )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        of = None
        for batch in batches:
            a, chunk, part, b = (batch.column(c).to_pylist() for c in ("a", "chunk", "part", "b"))
            found: list[tuple[int, int]] = []
            for i, raw in enumerate(batch.column("hashes")):
                mine = np.frombuffer(raw.as_buffer(), np.uint64)
                if part[i] == 0:
                    if of != (a[i], chunk[i]):
                        of, held = (a[i], chunk[i]), []
                    held.append(mine)
                    continue
                for other in held if of == (a[i], chunk[i]) else []:
                    least, most = sorted((len(mine), len(other)))
                    if WHOLE * least < PART * most:
                        continue
                    at = np.searchsorted(other, mine)
                    both = int((other[np.minimum(at, len(other) - 1)] == mine).sum())
                    if WHOLE * both >= PART * (len(mine) + len(other) - both):
                        found.append((a[i], b[i]))
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"]
            )

    # Never broadcast: the visits grow with the links.
    rows = docs.join(visits.hint("merge"), "doc_id").select("doc_id", "text", "to")
    sent = rows.mapInArrow(send, "a bigint, chunk int, part int, b bigint, hashes binary")
    ordered = sent.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "part")
    return ordered.mapInArrow(compare, "a bigint, b bigint")


def _alike(buckets: DataFrame) -> DataFrame:
    """Pairs of one bucket in different components whose sketches may reach the threshold.

    ``buckets`` holds key, block_a, block_b, side (0/1), doc_id, component,
    n_shingles, bands, sketch: every pair of blocks of a bucket is a group of
    its own. A pair is reported by the first bucket that both share.
    """

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids, comp, n = (table.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles"))
        bands = np.array(table.column("bands").to_pylist())
        key = table.column("key")[0].as_py()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
        same = table.column("block_a")[0].as_py() == table.column("block_b")[0].as_py()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        pairs = [np.zeros((0, 2), np.int64)]
        for i in left:
            fits = (comp[right] != comp[i]) & (ids[right] > ids[i] if same else ids[right] != ids[i])
            fits &= WHOLE * np.minimum(n[right], n[i]) >= PART * np.maximum(n[right], n[i])
            others = right[fits]
            if len(others):
                close = others[estimate(sketch[i], sketch[others]) >= LEAST_ESTIMATE]
                close = close[bands[i][np.argmax(bands[close] == bands[i], 1)] == key]
                if len(close):
                    mine = np.full(len(close), ids[i])
                    pairs.append(np.stack([np.minimum(mine, ids[close]), np.maximum(mine, ids[close])], 1))
        all_ = np.concatenate(pairs)
        return pa.table({"a": all_[:, 0], "b": all_[:, 1]})

    return buckets.groupBy("key", "block_a", "block_b").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    A document of fewer than five words has its whole word sequence as its one
    shingle. Null, empty and wordless texts have no shingles and link with
    nothing. Rows that repeat an id are one document as to links and keep a row
    each. A null id links with nothing, its component_id is null and it is kept.
    """
    small_batches(docs.sparkSession)
    rows = numbered_texts(docs, id_column, text_column)
    known = rows.filter("doc_id is not null")
    table = stored(signed(rows), "signed")
    sets = ["n_shingles", "set_a", "set_b"]
    filled = table.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(filled.groupBy(*sets).agg(F.min("doc_id").alias("rep")), "classes")
    reps = filled.join(classes.select(F.col("rep").alias("doc_id"), *sets), ["doc_id", *sets])
    buckets = reps.select("doc_id", F.explode("bands").alias("key"))
    centres = buckets.groupBy("key").agg(F.min("doc_id").alias("a"), F.count("*").alias("m")).filter("m > 1").drop("m")
    members = stored(buckets.join(centres, "key").select("key", "a", "doc_id"), "members")
    stars = stored(members.filter("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct(), "stars")
    links = stored(confirmed(known, stars).distinct(), "confirmed")

    placed = components(links)
    own = F.coalesce("component", "doc_id")
    seen = members.join(placed.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", own)
    split = (
        seen.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m"))
        .filter("low < high")
        .select("key", F.ceil(F.col("m") / CHUNK).cast("int").alias("blocks"))
    )
    shown = reps.select("doc_id", "n_shingles", "bands", "sketch")
    block = F.pmod(F.xxhash64("doc_id", F.lit(7)), "blocks").cast("int")
    open_ = seen.join(split, "key").join(shown, "doc_id").withColumn("block", block)
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(
            F.least("block", j).alias("block_a"), F.greatest("block", j).alias("block_b"),
            F.when(F.col("block") <= j, 0).otherwise(1).alias("side"),
        ),
    )
    dealt = open_.withColumn("to", F.explode(every)).select(
        "key", "to.block_a", "to.block_b", "to.side", "doc_id", "component", "n_shingles", "bands", "sketch"
    )
    more = stored(_alike(dealt).distinct(), "alike")
    if not more.isEmpty():
        links = stored(links.union(confirmed(known, more)).distinct(), "confirmed")
        placed = components(links)
    rep_of = classes.join(placed.withColumnRenamed("node", "rep"), "rep", "left").select(
        *sets, F.coalesce("component", "rep").alias("component")
    )
    # Rows that repeat an id may be in several classes; the smallest component is theirs.
    found = table.select("doc_id", *sets).join(rep_of, sets, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
