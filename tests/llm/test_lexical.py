"""Ranked search against a plain scoring of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from netsift.llm import lexical

DOCS = "doc_id bigint, text string, score string, rank int, item_id string"
ITEMS = "item_id bigint, text string, doc_id string, term int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=50):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=lambda r: r[:2])


def found(spark, docs, items, parts=3, **options):
    d = spark.createDataFrame([(i, t, "s", 1, "i") for i, t in docs], DOCS).repartition(parts)
    q = spark.createDataFrame([(i, t, "d", 2) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical.search(d, q, **options).collect()), key=lambda r: r[:2])


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(12)
    names = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choices(names, k=rng.choice([1, 5, 30, 200])))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, " .,;\n"), (403, "W1 w1, É-é w1"), (404, "w1 " * 20_000), (405, docs[3][1])]
    docs += [(3, docs[3][1]), (3, docs[5][1]), (None, docs[3][1]), (None, None), (None, docs[3][1])]
    docs += [(1000 + i, "same words here") for i in range(80)]
    items = [(i, " ".join(rng.choices(names, k=rng.choice([1, 3, 12, 40])))) for i in range(40)]
    items += [(50, None), (51, ""), (52, "unknown"), (53, "É W1"), (54, "here"), (55, "same; words"), (None, "w1"), (1, "w1 w2 w3")]
    return docs, items


def test_equals_plain_search(spark, tables):
    assert found(spark, *tables) == plain_search(*tables)


def test_ties_go_by_id(spark, tables):
    hits = [r for r in found(spark, *tables) if r[0] == 55]
    assert [r[2] for r in hits] == list(range(1000, 1050)) and len({r[3] for r in hits}) == 1


@pytest.mark.parametrize("k", [1, 7])
def test_small_lists_and_passes(spark, tables, monkeypatch, k):
    """Lists of few postings, several passes over the queries and short steps give the same rows."""
    monkeypatch.setattr(lexical, "POSTINGS", 200)
    monkeypatch.setattr(lexical, "STEP", 1)
    monkeypatch.setattr(lexical, "MOST_STEP", 2)
    assert found(spark, *tables, parts=2, k=k, terms=150) == plain_search(*tables, k=k)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_bound_is_that_of_the_best_positions(monkeypatch):
    """A search ends once the impacts after the unbroken runs add up to less than the k-th score."""
    monkeypatch.setattr(lexical, "STEP", 1)
    monkeypatch.setattr(lexical, "MOST_STEP", 1)
    # Two lists in which the same three documents lead, in opposite orders; after them the impacts drop.
    n = 1000
    impact = np.concatenate([[90, 80, 70], np.full(n - 3, 10), [70, 80, 90], np.full(n - 3, 10)])
    lists = lexical.Lists.of(np.repeat([0, 1], n), np.tile(np.arange(n), 2), impact, 2)
    reads = []
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda x: reads.append(len(x)) or unique(x))
    docs, scores = lists.best(np.array([0, 1]), 1, 0, np.zeros(n, bool))
    # By the last places read, 80 + 80 would not be below 160 after two rounds; the three leaders are seen by then.
    assert len(reads) == 2 and scores.max() == 160 and set(docs) <= {0, 1, 2}


def test_lists_equal_full_scores():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, many = int(rng.integers(1, 200)), int(rng.integers(1, 8))
        holds = rng.random((n, many)) < rng.choice([0.05, 0.5, 1.0])
        doc, term = np.nonzero(holds)
        impact = rng.integers(0, rng.choice([2, 5, 1000]), len(doc))
        lists = lexical.Lists.of(term, doc, impact, many)
        terms_, k = np.arange(many)[rng.random(many) < 0.7], int(rng.integers(1, 30))
        met = np.zeros(n, bool)
        docs, scores = lists.best(terms_, k, 0, met)
        assert not met.any()
        full = np.zeros(n, np.int64)
        picked = np.isin(term, terms_)
        np.add.at(full, doc[picked], impact[picked])
        expected = sorted(((-s, i) for i, s in enumerate(full.tolist()) if s > 0))[:k]
        assert sorted(zip((-scores).tolist(), docs.tolist()))[:k] == expected
