"""Words and word hashes of Arrow batches, computed with numpy over whole batches.

A word is a run of bytes other than space and 0x09-0x0D. Texts stay in Arrow's
own buffers; the work arrays cover about a quarter of a megabyte of text at a
time, or one text where that is longer. A worker keeps what its largest arrays
took, so larger steps cost memory in all stages that follow.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

STEP = 1 << 18
#: Regular expression of a word separator, for Spark and DuckDB alike.
SPACE = r"[\x20\x09-\x0D]"
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything in ASCII but letters and digits separates; bytes of other characters belong to words.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd multipliers of two independent polynomial hashes modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    out = values ^ (values >> np.uint64(32))
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xA0761D6478BD642F)
    out ^= out >> np.uint64(32)
    return out


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(n - 1, 1).bit_length()
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (self.base, self.inverse)
            )
        return self.up, self.down


_BYTE_POWERS = [_Powers(b) for b in BASES]
_WORD_POWERS = [_Powers(b) for b in _WORD_BASES]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each span."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", step: int = STEP) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about ``step`` bytes of text."""
    for batch in batches:
        at, _ = strings(batch.column(column))
        first, n = 0, batch.num_rows
        while first < n:
            last = max(first + 1, int(np.searchsorted(at, at[first] + step, "right")) - 1)
            yield batch.slice(first, min(last, n) - first)
            first = last


@dataclass
class Words:
    """Words of several texts in a row: bytes, word spans, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False, which: int = 0) -> np.ndarray:
        """A 64-bit hash for each word; ``lower`` folds A-Z first."""
        return self.span_hashes(self.starts, self.ends, lower, which)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = True, which: int = 0) -> np.ndarray:
        """A 64-bit hash for each run of bytes."""
        data = (_LOWER[self.data] if lower else self.data).astype(np.uint64)
        data += np.uint64(1)
        return span_hash(data, starts, ends, _BYTE_POWERS[which])

    def joined(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """Words of one text, joined by one space; ``keep`` marks those that stay."""
        raw = self.data.tobytes() if not isinstance(self.data, bytes) else self.data
        index = np.arange(self.first[row], self.first[row + 1])
        if keep is not None:
            index = index[keep]
        return b" ".join(raw[s:e] for s, e in zip(self.starts[index].tolist(), self.ends[index].tolist()))


def words(column: pa.Array, gap: np.ndarray = _GAP) -> Words:
    """The words of every text of a column; ``gap`` marks the bytes that separate them."""
    at, data = strings(column)
    data = data[at[0] : at[-1]]
    at = at - at[0]
    n = len(data)
    solid = ~gap[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:] = solid[:-1]
        after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (edge[:n] | ~before))
    ends = np.flatnonzero(solid & (edge[1:] | ~after)) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


def starts_of(first: np.ndarray, length: int) -> np.ndarray:
    """Words at which a run of ``length`` words begins that lies in one text."""
    inside = np.ones(int(first[-1]), bool)
    for back in range(1, length):
        stop = first[1:] - back
        inside[stop[stop >= first[:-1]]] = False
    return np.flatnonzero(inside)


def runs(hashes: np.ndarray, begin: np.ndarray, length: int, which: int = 0, step: int = STEP >> 2) -> np.ndarray:
    """Hash of the run of ``length`` words that begins at each of ``begin``, which ascend; ``step`` words at a time."""
    out = np.empty(len(begin), np.uint64)
    for low in range(0, len(hashes), step):
        i, j = np.searchsorted(begin, (low, low + step))
        at = begin[i:j] - low
        out[i:j] = span_hash(hashes[low : low + step + length], at, at + length, _WORD_POWERS[which])
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, length: int = 5, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and the text of each: runs of ``length`` words, or all words of a shorter text."""
    counts = np.diff(first)
    begin = starts_of(first, length)
    full = runs(hashes, begin, length, which)
    short = np.flatnonzero((counts > 0) & (counts < length))
    text = np.repeat(np.arange(len(counts)), counts)
    whole = span_hash(hashes, first[short], first[short + 1], _WORD_POWERS[which]) if len(short) else full[:0]
    return np.concatenate([full, whole]), np.concatenate([text[begin], short])
