"""Periodic runs against a plain search of every lag."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from netsift.llm import periodic
from netsift.llm.queries import looped, op11_periodic_runs

SCHEMA = "doc_id bigint, text string, runs string, n_words string, collapsed int"


def plain_runs(w, least=periodic.LEAST, times=periodic.TIMES):
    """Runs of a list of words: all stretches of all lags, of equal stretches the one with the smallest lag."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts():
    rng = random.Random(11)
    out = [None, "", " \n\t ", "one", "a " * 23, "a " * 24, "ab \x0b" * 40, "é ö " * 12, "é ö " * 11 + "é"]
    for _ in range(150):
        w = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(4)):
            if len(w) > 30:
                a, p = rng.randrange(len(w) - 20), rng.randrange(1, 25)
                for i in range(a, rng.randrange(a + 15, len(w) + 1)):
                    w[i] = w[a + (i - a) % p]
        out.append(rng.choice([" ", "\n", " \t "]).join(w))
    return out + out[-3:]


def test_runs_equal_plain_search(spark):
    rows = [(n, t, "x", "y", 1) for n, t in enumerate(texts())] + [(None, "b " * 30, "x", "y", 1), (3, "c " * 30, "x", "y", 1)]
    done = periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in done)
    expected = []
    for i, t, *_ in rows:
        w = words(t)
        runs = plain_runs(w)
        expected.append((str(i), len(w), runs, plain_collapsed(w, runs)))
    assert got == sorted(expected) and sum(len(r[2]) for r in got) > 30


def test_empty_table_and_other_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic.periodic_runs(empty).columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert periodic.periodic_runs(empty).count() == 0
    named = spark.createDataFrame([("x " * 30, 5)], "body string, key int")
    row = periodic.periodic_runs(named, "key", "body").first()
    assert (row["doc_id"], row["n_words"], [tuple(r) for r in row["runs"]], row["collapsed"]) == (5, 30, [(0, 30, 1)], "x")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 6), st.integers(2, 4))
def test_parameters(w, least, times):
    w = w + w + w[: len(w) // 2] + w[: len(w) // 3]
    codes, first = np.array(w, np.int64), np.array([0, len(w)])
    parts = periodic.segments(codes, first, least, times)
    assert sorted(parts) == periodic.peeled(codes, 0, len(w), least, times)
    got = [(s + b, n, q) for b, e in sorted(parts) for s, n, q in periodic.scan(codes[b:e], least, times)]
    assert sorted(got, key=lambda r: (r[0], r[2])) == plain_runs(w, least, times)


def test_splitting_ends_when_nothing_is_rare(monkeypatch):
    # Each round frees one more word, as in a chain; the parts are the same whichever way they are found.
    chain = np.array([x for k in range(200) for x in (k, k, k + 1)] + list(range(30)) * 3, np.int64)
    parts = periodic.segments(chain, np.array([0, len(chain)]))
    monkeypatch.setattr(periodic, "ROUNDS", 2)
    assert sorted(periodic.segments(chain, np.array([0, len(chain)]))) == sorted(parts) == periodic.peeled(chain, 0, len(chain))


@pytest.mark.parametrize("period", [1, 7, 50_000])
def test_long_texts(period):
    w = np.concatenate([np.arange(1000) + 10**6, np.arange(200_000) % period, np.arange(5) + 10**7])
    parts = periodic.segments(w, np.array([0, len(w)]))
    assert [(s + b, n, q) for b, e in parts for s, n, q in periodic.scan(w[b:e])] == [(1000, 200_000, period)]


def test_lags_are_taken_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    w = rng.integers(0, 2, 400)
    w[100:350] = np.resize(w[100:131], 250)
    expected = plain_runs(w.tolist())
    monkeypatch.setattr(periodic, "PLACES", 50)
    assert periodic.scan(w) == expected


def test_query_on_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    shaped = {r["doc_id"]: r["text"] for r in looped(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    done = {r["doc_id"]: r for r in op11_periodic_runs(spark, folder).collect()}
    assert len(done) == len(docs)
    for i, text in docs:
        w, h = words(text), zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j if j < a else a + (j - a) % p] for j in range(n)]
        assert words(shaped[i]) == w
        if n > 1500:
            continue
        runs = plain_runs(w)
        r = done[i]
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(w, runs).encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)


def test_query_takes_odd_rows(spark, tmp_path):
    looping = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(looping[0], None), (looping[1], ""), (looping[2], " \t"), (looping[2], "a b"), (None, "a b"), (None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = op11_periodic_runs(spark, str(tmp_path)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(done) == 6 and all(r["n_runs"] == 0 and r["start"] is None and r["runs_sha256"] == empty for r in done)
