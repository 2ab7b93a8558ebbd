"""Packing of tokenised documents into fixed-length sequences by harmonic classes.

A document's token ids are cut into full sequences, then into halves, quarters
and so on of the capacity down to ``smallest``, and one tail. A piece of length
p belongs to class k = capacity // p, so it fills at most 1/k of a sequence, and
every bin of class k takes exactly k pieces. The power-of-two classes therefore
fill without padding, and tails pad by less than their own length per sequence.
Each worker fills its bins alone: nothing is shuffled, and what a worker holds
open is at most one bin per class. The bins that stay incomplete at the end of a
worker's rows are joined, cut at the capacity, and the rest is cut at powers of
two, so they need no padding either.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from netsift.llm.links import small_batches
from netsift.llm.text import pieces

CAPACITY = 1024
SMALLEST = 64
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("class", pa.int32()),
    ]
)
_DDL = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint,"
    " offset bigint, class int"
)
# Fixed value: how byte-level BPE splits a text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=1)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


class TextEncoder:
    """Token ids of whole texts as little-endian 32-bit integers.

    ``path`` is a byte-level BPE file of the ``tokenizers`` library. Its
    vocabulary is run by tiktoken, which gives the same ids at four times the
    speed; special tokens in a text get their own ids, as there.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        special = {t["content"]: t["id"] for t in parts["added_tokens"] if t["special"]}
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): id_ for token, id_ in parts["model"]["vocab"].items() if token not in special
        }
        self.special = special
        self.encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        plain = not any(s in text for s in self.special)
        ids = self.encoding.encode_ordinary(text) if plain else self.encoding.encode(text, allowed_special="all")
        return np.array(ids, "<u4").tobytes()


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself where printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def cuts(tokens: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> list[int]:
    """Lengths of the pieces of a document: full, halves, quarters ..., and a tail below ``smallest``."""
    out = [capacity] * (tokens // capacity)
    rest, size = tokens % capacity, capacity // 2
    while size >= smallest:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


class Bins:
    """Open bins of one worker; ``rows`` collects the pieces of closed ones."""

    def __init__(self, worker: int, capacity: int):
        self.capacity, self.next = capacity, worker << 36
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple], kind: int) -> None:
        offset = 0
        for doc, start, length, ids, tokens in pieces:
            self.rows.append((doc, start, length, ids, tokens, self.next, offset, kind))
            offset += length
        self.next += 1

    def add(self, doc: int | None, ids: bytes, smallest: int) -> None:
        tokens = len(ids) // 4
        start = 0
        for length in cuts(tokens, self.capacity, smallest):
            kind = self.capacity // length
            bin_ = self.open.setdefault(kind, [])
            bin_.append((doc, start, length, ids[4 * start : 4 * (start + length)], tokens))
            if len(bin_) == kind:
                self._close(self.open.pop(kind), kind)
            start += length

    def finish(self) -> None:
        """Close what is left: cut at the capacity, and the last part at powers of two."""
        left = [p for kind in sorted(self.open) for p in self.open[kind]]
        self.open.clear()
        total = sum(p[2] for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        at = 0
        for size in sizes:
            pieces, room = [], size
            while room:
                doc, start, length, ids, tokens = left[at]
                take = min(room, length)
                pieces.append((doc, start, take, ids[: 4 * take], tokens))
                room -= take
                if take == length:
                    at += 1
                else:
                    left[at] = (doc, start + take, length - take, ids[4 * take :], tokens)
            self._close(pieces, 0)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in PIECES]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    smallest: int = SMALLEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Columns: doc_id, start (ids of the document before the piece), length, ids
    (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset,
    class (k; 0 for a worker's last, joined bins). Every document ends with
    ``end_id``, so a null or empty text is one id. Repeated rows are packed each
    for itself, a null id stays null, other columns are ignored, an empty table
    gives no rows. ``capacity`` is a power of two. ``tokenizer`` is the path of
    a byte-level tokeniser file that all workers can read.
    """
    if capacity & (capacity - 1) or not 0 < smallest <= capacity:
        raise ValueError("capacity must be a power of two and smallest at most as large")
    small_batches(docs.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        bins = Bins(TaskContext.get().partitionId(), capacity)
        for batch in pieces(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                bins.add(doc, encoder.encode(text) + tail, smallest)
            yield bins.batch()
        bins.finish()
        yield bins.batch()

    rows = docs.select(docs[id_column].cast("bigint").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.mapInArrow(run, _DDL)
