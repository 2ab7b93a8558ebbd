"""Ranked lexical search by the Best Position Algorithm.

Every term of a query has an impact list: the documents that hold it, highest
impact first. A query reads its lists side by side. Each document that appears is
looked up in all other lists at once (direct access), which gives its whole score
and marks its place in every list as seen. The best position of a list is the end
of its unbroken run of seen places; no document that is still unseen can score
more than the impacts there add up to. As direct accesses lengthen these runs, this
bound lies below the one of the last places read. The search stops as soon as it is
strictly below the k-th score, so equal scores can still be ordered by id.

Documents never move: one pass counts the terms that any query asks for and stores
them per document; then each task builds the lists of its documents, some ``POSTINGS``
at a time, searches all queries in them, and passes on the k best of each query.
The k-th score so far is also the bar for the task's next lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm.links import numbered_texts, small_batches, stored
from netsift.llm.text import _LOWER, NOT_WORD, pieces, words

K = 50
#: Postings of the lists that a task holds at a time; one document's are never divided.
POSTINGS = 1 << 20
#: Query terms that are sent to every task at a time; queries beyond them are searched in a further pass.
TERMS = 200_000
#: Places read from each list before the bound is looked at; doubles from round to round up to the second figure.
STEP, MOST_STEP = 32, 4096
#: Groups in which the tasks' results of one query are merged first.
MERGES = 32


def terms_of(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Terms of each text: a code for each place, the term of each code, and the first place of each text."""
    found = words(column, NOT_WORD)
    sizes = found.ends - found.starts
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    where = np.repeat(found.starts - at[:-1], sizes) + np.arange(at[-1])
    data = np.ascontiguousarray(_LOWER[found.data[where]])
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(data)])
    coded = texts.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, found.first


def _counts(codes: np.ndarray, first: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, code and occurrences of each term of each text; codes below 0 are left out."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[codes >= 0]
    keys, n = np.unique(row * max(many, 1) + codes[codes >= 0], return_counts=True)
    return keys // max(many, 1), keys % max(many, 1), n


def query_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id, term``: the different terms of each query; rows that share an id are one query."""
    rows = numbered_texts(items, id_column, text_column)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codes, names, first = terms_of(batch.column("text"))
            row, code, _ = _counts(codes, first, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), names.take(pa.array(code)).cast(pa.binary())], ["item_id", "term"]
            )

    return rows.filter("doc_id IS NOT NULL").mapInArrow(split, "item_id bigint, term binary").distinct()


def postings(docs: DataFrame, vocabulary: list[bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n, terms, counts`` of every document that holds a term: all its terms, and those of the vocabulary."""
    rows = numbered_texts(docs, id_column, text_column)
    known = pa.array(vocabulary, pa.large_binary())

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codes, names, first = terms_of(batch.column("text"))
            place = pc.index_in(names, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            row, code, n = _counts(place[codes] if len(codes) else codes, first, len(vocabulary))
            at = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (code, n)]
            made = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), *lists], ["doc_id", "n", "terms", "counts"]
            )
            yield made.filter(pa.array(np.diff(first) > 0))

    return rows.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, counts array<int>")


def weight(documents: int, holders: int) -> int:
    """Weight of a term that ``holders`` of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What each occurrence count adds to its document's score, in 64-bit integers."""
    norm = 50 + (50 * lengths * documents) // total
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 20 * norm))


@dataclass
class Lists:
    """Impact lists of some documents: per term, documents by impact, and by number with their place in that order."""

    starts: np.ndarray
    docs: np.ndarray
    impact: np.ndarray
    sorted_docs: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int) -> Lists:
        """Lists of postings that are in the order of their documents."""
        by_impact = np.lexsort((doc, -impact, term))
        by_doc = np.argsort(term, kind="stable")
        starts = np.searchsorted(term[by_doc], np.arange(terms + 1))
        place = np.empty(len(term), np.int64)
        place[by_impact] = np.arange(len(term)) - starts[term[by_impact]]
        return cls(starts, doc[by_impact], impact[by_impact], doc[by_doc], place[by_doc])

    def best(self, terms: np.ndarray, k: int, bar: int, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores among which are the ``k`` best of a query, as far as they score ``bar`` or more.

        ``met`` is a cleared flag for each document, and is cleared again.
        """
        spans = [(a, b) for a, b in zip(self.starts[terms].tolist(), self.starts[terms + 1].tolist()) if b > a]
        seen = [np.zeros(b - a + 1, bool) for a, b in spans]
        best = [0] * len(spans)
        docs, scores, depth, step = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, STEP
        top = np.zeros(0, np.int64)
        while any(a + depth < b for a, b in spans):
            fresh = np.unique(np.concatenate([self.docs[a + depth : min(a + depth + step, b)] for a, b in spans]))
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            score, bound = np.zeros(len(fresh), np.int64), 0
            for t, (a, b) in enumerate(spans):
                at = a + np.searchsorted(self.sorted_docs[a:b], fresh)
                at[at == b] = a
                hit = self.sorted_docs[at] == fresh
                place = self.place[at[hit]]
                score[hit] += self.impact[a + place]
                seen[t][place] = True
                best[t] += int(np.argmin(seen[t][best[t] :]))
                bound += int(self.impact[a + best[t]]) if a + best[t] < b else 0
            docs.append(fresh)
            scores.append(score)
            top = np.concatenate([top, score])
            top = np.partition(top, len(top) - k)[len(top) - k :] if len(top) > k else top
            if bound < bar or (len(top) == k and bound < top.min()):
                break
            depth, step = depth + step, min(2 * step, MOST_STEP)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        met[docs] = False
        good = scores >= max(bar, 1, int(top.min()) if len(top) == k else 1)
        return docs[good], scores[good]


def _order(hit: tuple[int, int | None]) -> tuple:
    score, doc_id = hit
    return -score, doc_id is None, doc_id or 0


def _searched(found: DataFrame, items: list[tuple[int, np.ndarray]], weights: np.ndarray, documents: int, total: int, k: int):
    """``item_id, doc_id, score`` of the k best documents of each task for each query."""

    def flush(rows: list[pa.RecordBatch], best: list[list[tuple[int, int | None]]]) -> None:
        table = pa.Table.from_batches(rows).combine_chunks()
        sizes = pc.list_value_length(table.column("terms")).to_numpy()
        term, count = (pc.list_flatten(table.column(c)).to_numpy().astype(np.int64) for c in ("terms", "counts"))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        length = table.column("n").to_numpy()[doc]
        lists = Lists.of(term, doc, impacts(weights[term], count, length, documents, total), len(weights))
        ids, met = table.column("doc_id"), np.zeros(len(sizes), bool)
        for n, (_, terms) in enumerate(items):
            bar = best[n][k - 1][0] if len(best[n]) >= k else 0
            docs, scores = lists.best(terms, k, bar, met)
            if len(docs):
                hits = best[n] + list(zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist()))
                best[n] = sorted(hits, key=_order)[:k]

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int | None]]] = [[] for _ in items]
        rows, held = [], 0
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
            first = 0
            while first < batch.num_rows:
                before = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + POSTINGS - held, "right")))
                rows.append(batch.slice(first, last - first))
                held += int(ends[min(last, batch.num_rows) - 1]) - before
                first = last
                if held >= POSTINGS or first < batch.num_rows:
                    flush(rows, best)
                    rows, held = [], 0
        if rows:
            flush(rows, best)
        hits = [(items[n][0], doc, score) for n, found_ in enumerate(best) for score, doc in found_]
        for at in range(0, len(hits), 1 << 16):
            item, doc, score = zip(*hits[at : at + (1 << 16)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"]
            )

    return found.mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")


def search(
    docs: DataFrame, items: DataFrame, k: int = K, terms: int = TERMS,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score.

    Every document with a score above 0 is ranked by its score, then by its id, a
    null id last; documents that repeat an id are ranked one by one. Null and
    empty texts hold no term: such documents are found by no item and do not
    count, such items find nothing, and items with a null id are left out. Rows
    that share an item id are one item. Other columns of any name are ignored; an
    empty table on either side gives an empty result. Whole texts are counted,
    however long.

    ``terms`` bounds what is sent to every task: items with more terms in all are
    searched in several passes, each of which reads the documents again.
    """
    small_batches(docs.sparkSession)
    asked = stored(query_terms(items, item_column, item_text), "queries")
    passes = max(1, math.ceil(asked.count() / terms))
    parts = [
        _search_pass(docs, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == n), k, id_column, text_column)
        for n in range(passes)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _search_pass(docs: DataFrame, asked: DataFrame, k: int, id_column: str, text_column: str) -> DataFrame:
    """The search of as many items as one pass takes."""
    pairs = asked.toArrow().to_pydict()
    vocabulary = sorted(set(pairs["term"]))
    number = {t: n for n, t in enumerate(vocabulary)}
    by_item: dict[int, list[int]] = {}
    for item, term in zip(pairs["item_id"], pairs["term"]):
        by_item.setdefault(item, []).append(number[term])
    found = stored(postings(docs, vocabulary, id_column, text_column), "postings")
    whole = found.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
    holders = np.zeros(len(vocabulary), np.int64)
    # One row for each term of the vocabulary at most.
    for term, n in found.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holders[term] = n
    weights = np.array([weight(whole["documents"], int(n)) for n in holders], np.int64)
    queries = [(item, np.array(sorted(t), np.int64)) for item, t in sorted(by_item.items())]
    hits = _searched(found, queries, weights, whole["documents"], whole["total"] or 1, k)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    # First within groups of tasks, so that no task gets all results of an item.
    some = Window.partitionBy("item_id", "_group").orderBy(*order)
    grouped = hits.withColumn("_group", F.spark_partition_id() % MERGES)
    few = grouped.withColumn("_place", F.row_number().over(some)).filter(F.col("_place") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return few.select("item_id", rank.alias("rank"), "doc_id", "score").filter(F.col("rank") <= k)
