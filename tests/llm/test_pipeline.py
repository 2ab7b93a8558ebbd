"""The cleaning pipeline against a plain version that uses the same models."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_passages import plain_repeats, roots, shingle_set
from tokenizers import Tokenizer

import corpus_pipeline
from netsift.llm import secrets, toxicity
from netsift.llm.queries import held_out


def test_pipeline_equals_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    left = {r["doc_id"]: r["text"] for r in toxicity.score(docs, model).filter("predicted = 0").collect()}
    assert 0 < len(left) < docs.count()

    sets = {i: shingle_set(t) for i, t in left.items()}
    ids = sorted(left)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    left = {i: left[i] for i, root in roots(ids, links).items() if root == i}
    assert len(left) < len(ids)

    done = plain_repeats(list(left.items()))
    left = {i: done[i][2] if done[i][1] else t for i, t in left.items() if done[i][1] == 0 or done[i][1] < done[i][0]}
    frame = spark.createDataFrame(list(left.items()), "doc_id bigint, text string")
    known, trees = secrets.fitted(frame)
    for i, t in left.items():
        spans = [(m.start(), m.end()) for m in secrets.CANDIDATE.finditer(t)]
        x = np.array([secrets.features(t, s, e, known) for s, e in spans])
        for (s, e), score in reversed(list(zip(spans, secrets.vote(x, trees) if spans else []))):
            t = t[:s] + "[SECRET]" + t[e:] if score >= 0.5 else t
        left[i] = t

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sorted(got) == sorted(left)
    for i, parts in got.items():
        ids = np.array(reference.encode(left[i], add_special_tokens=False).ids + [0], "<u4")
        assert {p["doc_tokens"] for p in parts} == {len(ids)}
        for p in parts:
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
        assert sum(p["length"] for p in parts) == len(ids)


def test_stages_keep_the_columns(spark, folder):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, folder)
            assert frame.columns == docs.columns
        ids = [r["doc_id"] for r in frame.collect()]
        assert sorted(map(str, ids)) == (["1", "2", "None"] if ids else [])


def test_stages_keep_clashing_columns(spark, folder):
    """Columns named as the operators' working columns come through unchanged, next to very long and odd texts."""
    clashing = "score predicted kept findings removed n_words n_removed component_id n_shingles doc_tokens _place lang".split()
    schema = "doc_id bigint, text string, n_chars bigint, " + ", ".join(f"{c} string" for c in clashing)
    long = " ".join(f"word{i}" for i in range(60_000))
    texts = ["a b c", "a b c", None, "", " \n", long, "x " * 50_000]
    rows = [(i, t, len(t or ""), *[f"{c} {i}" for c in clashing]) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == ["doc_id", "text", "n_chars", *clashing]
    done = {r["doc_id"]: r for r in frame.collect()}
    assert set(done) == {0, 2, 3, 4, 5, 6} and done[5]["text"] == long
    assert all(r[c] == f"{c} {i}" for i, r in done.items() for c in clashing)


def test_names():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and all(re.fullmatch(r"\w+", n) for n in names)
