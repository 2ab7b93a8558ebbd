"""Periodic runs of words, found by recursive frequency splitting and a scan of lags.

A run is a stretch of words in which words ``q`` apart are equal, ``q`` being its
smallest period, that is at least ``max(least, times * q)`` words long and that
no neighbouring word extends. Each of its words therefore occurs ``times`` times
within it. So a word that occurs less often within a segment of the text belongs
to no run there and splits the segment; the parts are counted anew until nothing
splits any more (``segments``). Ordinary prose falls to pieces within a few rounds.

What is left is scanned for lags (``scan``). A run of period ``q`` holds ``times``
multiples of ``q`` in a row whose words are equal, so a lag is looked at there
only: m log m comparisons for m words. Places that pass are extended word by word.
All steps are exact: words are compared by codes of their bytes, not by hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from netsift.llm.links import numbered_texts, small_batches
from netsift.llm.text import Words, pieces, words

LEAST = 24
TIMES = 3
#: Rounds over all segments at once; texts that still split after them are split one by one (``peeled``).
ROUNDS = 32
#: Places of lags that are looked at together.
PLACES = 1 << 20

SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
)


def codes_of(found: Words) -> np.ndarray:
    """A number for each word, the same for equal words of these texts only."""
    sizes = found.ends - found.starts
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    from_ = np.repeat(found.starts - at[:-1], sizes) + np.arange(at[-1])
    texts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(found.data[from_]))]
    )
    return texts.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch of set flags."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def segments(codes: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Parts of the texts in which every word occurs ``times`` times or more, at least ``least`` words long."""
    begin, end = np.asarray(first[:-1], np.int64), np.asarray(first[1:], np.int64)
    many = int(codes.max()) + 1 if len(codes) else 1
    done: list[tuple[int, int]] = []
    for _ in range(ROUNDS):
        long = end - begin >= least
        begin, end = begin[long], end[long]
        if not len(begin):
            return done
        sizes = end - begin
        at = np.cumsum(sizes) - sizes
        where = np.repeat(begin - at, sizes) + np.arange(int(sizes.sum()))
        owner = np.repeat(np.arange(len(begin)), sizes)
        _, place, count = np.unique(owner * many + codes[where], return_inverse=True, return_counts=True)
        rare = count[place] < times
        splits = np.zeros(len(begin), bool)
        splits[owner[rare]] = True
        done += zip(begin[~splits].tolist(), end[~splits].tolist())
        # The parts of a segment end before its rare words and at its own end.
        stay = ~rare & splits[owner]
        last = np.zeros(len(where), bool)
        last[at + sizes - 1] = True
        starts = np.flatnonzero(stay & np.concatenate([[True], ~stay[:-1] | last[:-1]]))
        stops = np.flatnonzero(stay & (last | np.concatenate([~stay[1:], [True]])))
        begin, end = where[starts], where[stops] + 1
    return done + [part for b, e in zip(begin.tolist(), end.tolist()) for part in peeled(codes, b, e, least, times)]


def peeled(codes: np.ndarray, begin: int, end: int, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """The same for one segment; the longest part keeps its segment's counts, so each word is counted log n times."""
    order = np.argsort(codes[begin:end], kind="stable")
    ranked, done = codes[begin:end][order], []

    def counted(lo: int, hi: int) -> tuple[int, int, Counter, set]:
        count = Counter(codes[lo:hi].tolist())
        return lo, hi, count, {c for c, n in count.items() if n < times}

    open_ = [counted(begin, end)]
    while open_:
        lo, hi, count, rare = open_.pop()
        if hi - lo < least:
            continue
        if not rare:
            done.append((lo, hi))
            continue
        cuts = []
        for code in rare:
            places = order[np.searchsorted(ranked, code, "left") : np.searchsorted(ranked, code, "right")] + begin
            cuts += places[(places >= lo) & (places < hi)].tolist()
        edges = [lo - 1, *sorted(cuts), hi]
        parts = [(a + 1, b) for a, b in zip(edges, edges[1:])]
        big = max(parts, key=lambda p: p[1] - p[0])
        gone = Counter(codes[lo : big[0]].tolist()) + Counter(codes[big[1] : hi].tolist())
        for code, n in gone.items():
            count[code] -= n
        open_ += [counted(*p) for p in parts if p != big and p[1] - p[0] >= least]
        open_.append((*big, count, {c for c in gone if 0 < count[c] < times}))
    return sorted(done)


def _lag_places(w: np.ndarray, low: int, high: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Lags from ``low`` below ``high`` and multiples of them at which ``times`` words in a row, one lag apart, are equal."""
    n, lags, places = len(w), [], []
    root = int(np.sqrt(n)) + 1
    for q in range(low, min(high, root)):
        line = w[::q]
        same = line[1:] == line[:-1]
        hit = same[: len(same) - times + 2].copy()
        for k in range(1, times - 1):
            hit &= same[k : len(same) - times + 2 + k]
        at = np.flatnonzero(hit)
        lags.append(np.full(len(at), q))
        places.append(at * q)
    low = max(low, root)
    multiple = 0
    while low < high and (multiple + times - 1) * low < n:
        q = np.arange(low, min(high, (n - 1) // (multiple + times - 1) + 1))
        hit = np.ones(len(q), bool)
        for k in range(times - 1):
            hit &= w[(multiple + k) * q] == w[(multiple + k + 1) * q]
        lags.append(q[hit])
        places.append(multiple * q[hit])
        multiple += 1
    if not lags:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lag, at = np.concatenate(lags), np.concatenate(places)
    order = np.lexsort((at, lag))
    return lag[order], at[order]


def _extended(w: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` with this lag; ``w[at] == w[at + lag]``."""
    stop, step, n = at + 1, 64, len(w)
    while stop < n - lag:
        other = w[stop + lag : stop + lag + step]
        differs = w[stop : stop + len(other)] != other
        if differs.any():
            stop += int(differs.argmax())
            break
        stop, step = stop + len(other), step * 2
    start, step = at, 64
    while start > 0:
        size = min(step, start)
        differs = w[start - size : start] != w[start - size + lag : start + lag]
        if differs.any():
            start -= int(differs[::-1].argmax())
            break
        start, step = start - size, step * 2
    return start, stop + lag


def scan(w: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in ``w``, by start, then period."""
    n, found = len(w), []
    low, most = 1, n // times
    while low <= most:
        # Lags are taken in blocks that have about PLACES multiples.
        high = low + 1
        room = PLACES - n // low
        while high <= most and room > 0:
            step = max(1, min(most + 1 - high, room // (n // high + 1)))
            high, room = high + step, room - step * (n // high + 1)
        lag, at = _lag_places(w, low, high, times)
        # Within a run, words equal their partners from its first multiple over the next times - 2 lags.
        for part in (1, 4, 8, 12, 15):
            near = at + (times - 2) * lag * part // 16
            fits = near + lag < n
            lag, at, near = lag[fits], at[fits], near[fits]
            same = w[near] == w[near + lag]
            lag, at = lag[same], at[same]
        edge = np.flatnonzero(np.diff(lag)) + 1 if len(lag) else np.zeros(0, np.int64)
        for places, q in zip(np.split(at, edge), lag[np.concatenate([[0], edge])].tolist() if len(lag) else []):
            found += _runs_of(w, places, q, found, least, times)
        low = high
    return sorted(found, key=lambda r: (r[0], r[2]))


def _runs_of(w: np.ndarray, at: np.ndarray, lag: int, found: list, least: int, times: int) -> list[tuple[int, int, int]]:
    """New runs with this period among the stretches around ``at``; ``found`` has those with smaller periods."""
    # A stretch that lies in a run whose period divides the lag is that run again.
    known = sorted((s, s + n) for s, n, p in found if lag % p == 0)
    if known:
        starts, ends = np.array(known).T
        before = np.searchsorted(starts, at, "right") - 1
        reach = np.where(before >= 0, np.maximum.accumulate(ends)[before], 0)
        at = at[reach <= at + (times - 1) * lag]
    runs, reached = [], -1
    for place in at.tolist():
        if place >= reached:
            start, stop = _extended(w, place, lag)
            reached = stop - lag
            if stop - start >= max(least, times * lag):
                runs.append((start, stop - start, lag))
    same = {(s, n) for s, n, _ in found}
    return [r for r in runs if (r[0], r[1]) not in same]


def runs_of_texts(found: Words, least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, with word numbers of the text."""
    codes = codes_of(found)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(found.first) - 1)]
    for begin, end in sorted(segments(codes, found.first, least, times)):
        runs = scan(codes[begin:end], least, times)
        if runs:
            row = int(np.searchsorted(found.first, begin, "right")) - 1
            shift = begin - int(found.first[row])
            out[row] += [(s + shift, n, p) for s, n, p in runs]
    return out


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that stay: all but those that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and collapsed.

    ``collapsed`` holds the words outside the repeats of all runs, joined by one
    space. Null and empty texts have no words, no runs and an empty collapsed
    text. Every row is judged by itself, so repeated rows and ids, also null
    ids, give a row each, and no text meets another. Whole texts are searched
    however long they are; a text is the unit of work. Other columns of any
    name are ignored; an empty table gives an empty result. Of runs that start
    at the same word, the one with the smaller period comes first.
    """
    rows = numbered_texts(docs, id_column, text_column)
    small_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = words(batch.column("text"))
            runs = runs_of_texts(found, least, times)
            counts = found.counts
            collapsed = [
                found.joined(i, kept(int(counts[i]), r) if r else None).decode("utf-8", "surrogatepass")
                for i, r in enumerate(runs)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts.astype(np.int64)),
                    pa.array([[dict(zip(("start", "length", "period"), x)) for x in r] for r in runs], pa.list_(run)),
                    pa.array(collapsed, pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return rows.mapInArrow(search, SCHEMA)
