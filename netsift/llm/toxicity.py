"""Toxicity by logistic regression on hashed n-grams, fitted with FTRL-proximal.

Features are the distinct words, word pairs and pairs with one word between
them of a whole text, lower-cased and hashed; words longer than a stem (``STEMS``
bytes) also count by that stem, as inflected forms are too rare to learn alone. FTRL-proximal keeps a learning
rate per coordinate and an L1 term, so most weights are exactly zero; what is
broadcast are the non-zero ones. The fit uses a bounded sample of labelled rows
(``sample``): it is dealt over ``shards`` groups, each group runs its own
passes, and the weights are averaged. Scoring reads every text once and shuffles
nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.links import small_batches, smallest_hashes
from netsift.llm.text import NOT_WORD, Words, mix, pieces, words

#: Lengths in bytes of the word beginnings that are features too.
STEMS = (4, 5)


@dataclass(frozen=True)
class Ftrl:
    """Settings of the fit; ``sample`` bounds the labelled rows that are used."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.2
    passes: int = 8
    shards: int = 2
    sample: int = 20_000


@dataclass(frozen=True)
class Weights:
    """Non-zero weights by feature number, and the intercept."""

    index: np.ndarray
    value: np.ndarray
    bias: float
    bits: int


def features(found: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts in a row, and the text of each; with repetitions."""
    h = found.hashes(lower=True)
    text = np.repeat(np.arange(len(found.counts)), found.counts)
    parts, owners = [mix(h)], [text]
    for gap, salt in ((1, 0x9FB21C651E98DF25), (2, 0xB492B66FBE98F273)):
        same = text[gap:] == text[:-gap]
        pair = h[:-gap] * np.uint64(salt) + (h[gap:] ^ np.uint64(salt))
        parts.append(mix(pair[same]))
        owners.append(text[gap:][same])
    size = found.ends - found.starts
    for length in STEMS:
        longer = size > length
        start = found.starts[longer]
        parts.append(mix(found.span_hashes(start, start + length) ^ np.uint64(length)))
        owners.append(text[longer])
    return (np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int32), np.concatenate(owners)


def ftrl(rows: list[tuple[np.ndarray, int]], settings: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights after all passes over ``rows`` of (distinct feature numbers, label)."""
    size = (1 << settings.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    bias = size - 1

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        l1 = np.where(i == bias, 0.0, settings.l1)
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0.0)
        return -shrunk / ((settings.beta + np.sqrt(n[i])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for index, label in rows:
            i = np.append(index, bias)
            w = weights(i)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            ni = n[i]
            z[i] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / settings.alpha * w
            n[i] = ni + g * g
    every = np.flatnonzero(np.abs(z[:-1]) > settings.l1)
    return every.astype(np.int32), weights(every), float(weights(np.array([bias]))[0])


def fit(docs: DataFrame, labels: DataFrame, settings: Ftrl = Ftrl()) -> Weights:
    """Fit on documents (doc_id, text) with labels (doc_id, label 0/1).

    Labels that are null are left out; of several for a document the largest
    counts. At most ``sample`` labelled documents are used, those with the
    smallest hashes of their ids; only their feature numbers are shuffled.
    Without any labelled document all scores are one half.
    """
    small_batches(docs.sparkSession)
    known = labels.filter("doc_id is not null and label is not null").groupBy("doc_id")
    chosen = smallest_hashes(known.agg(F.max("label").cast("int").alias("label")), settings.sample, "doc_id")

    def to_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            index, owner = features(words(batch.column("text"), NOT_WORD), settings.bits)
            keys = np.unique((owner.astype(np.int64) << 32) | index)
            split = np.searchsorted(keys >> 32, np.arange(batch.num_rows + 1))
            low = (keys & 0xFFFFFFFF).astype(np.int32)
            blobs = [low[a:b].tobytes() for a, b in zip(split, split[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(blobs, pa.binary())], ["doc_id", "label", "f"]
            )

    # The chosen labels are at most ``sample`` rows of two numbers, so they may be broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = sample.mapInArrow(to_features, "doc_id bigint, label int, f binary")

    def train(part: pa.Table) -> pa.Table:
        # The feature numbers stay in Arrow's buffers; only the order of the rows is made.
        order = np.argsort(part.column("order").to_numpy(), kind="stable")
        blobs = [b for chunk in part.column("f").chunks for b in chunk]
        labels = part.column("label").to_numpy()
        data = [(np.frombuffer(blobs[i].as_buffer(), np.int32), int(labels[i])) for i in order]
        index, value, bias = ftrl(data, settings)
        return pa.table({"i": np.append(index, -1).astype("int32"), "w": np.append(value, bias)})

    trained = (
        rows.withColumn("order", F.xxhash64("doc_id", F.lit(1)))
        .withColumn("shard", F.pmod("order", F.lit(settings.shards)))
        .groupBy("shard")
        .applyInArrow(train, "i int, w double")
    )
    # At most one row for each of the 2**bits features comes back.
    table = trained.groupBy("i").agg(F.sum("w").alias("w"), F.count("*").alias("c")).toPandas()
    bias = table[table["i"] < 0]
    if bias.empty:
        return Weights(np.zeros(0, np.int32), np.zeros(0), 0.0, settings.bits)
    shards = float(bias["c"].iloc[0])
    table = table[table["i"] >= 0].sort_values("i")
    return Weights(
        table["i"].to_numpy(np.int32), table["w"].to_numpy() / shards, float(bias["w"].iloc[0]) / shards, settings.bits
    )


def score(docs: DataFrame, weights: Weights, text_column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, with score (0 to 1) and predicted (score >= 0.5).

    Null and empty texts get the score of the intercept alone. Repeated rows are
    scored each for itself; columns named as the results are replaced, and an
    empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    # The text goes through once, not a second time among the other columns.
    others = [c for c in keep if c != text_column]
    rest = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none"))
    with_text = text_column in keep

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        dense = np.zeros(1 << w.bits, np.float32)
        dense[w.index] = w.value
        for batch in pieces(batches):
            index, owner = features(words(batch.column("text"), NOT_WORD), w.bits)
            hit = np.flatnonzero(dense[index])
            keys = np.unique((owner[hit].astype(np.int64) << 32) | index[hit])
            sums = np.bincount(keys >> 32, dense[keys & 0xFFFFFFFF].astype(np.float64), batch.num_rows) + w.bias
            p = 1.0 / (1.0 + np.exp(-np.clip(sums, -500, 500)))
            out = {"rest": batch.column("rest"), "score": p, "predicted": (p >= 0.5).astype(np.int32)}
            yield pa.RecordBatch.from_pydict({"text": batch.column("text"), **out} if with_text else out)

    rows = docs.select(docs[text_column].cast("string").alias("text"), rest.alias("rest"))
    shown = rows.select("text", "rest") if with_text else rows.select("rest")
    done = rows.mapInArrow(run, shown.schema.add("score", "double").add("predicted", "integer"))
    place = {c: f"rest.c{i}" for i, c in enumerate(others)} | {text_column: "text"}
    return done.select(*[F.col(place[c]).alias(c) for c in keep], "score", "predicted")
