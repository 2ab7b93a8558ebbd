"""Packing and SentencePiece coding: exact round trips and the libraries' own ids."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from netsift.llm import packing, subwords

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, ids string, start string"
ODD = ["a  b", " a ", "a \nb\n\n c", "", "  x  \t y", "it's 'll IT'S", "<|endoftext|> b", "\x1c b\x85 c", "日本 é  x", "x\n"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "und", "öpf", "12", "thing,"]) for _ in range(rng.choice([1, 40, 900, 5000]))) for _ in range(60)]
    return [*enumerate(texts + ODD), (900, None), (901, texts[0]), (901, texts[0]), (None, "no id")]


def test_packing_is_a_round_trip_without_overlap(spark, rows):
    reference = Tokenizer.from_file(BYTE_BPE)
    expected = sorted(
        (str(i), tuple(reference.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows
    )
    done = packing.pack(frame(spark, rows).repartition(3), BYTE_BPE).collect()
    documents, sequences = {}, {}
    for r in done:
        assert len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"] != 901:
            documents.setdefault(str(r["doc_id"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    for doc, parts in documents.items():
        ids = [i for _, part, _ in sorted(parts) for i in part]
        assert (doc, tuple(ids)) in expected and {p[2] for p in parts} == {len(ids)}
        assert [s for s, _, _ in sorted(parts)] == list(np.cumsum([0] + [len(p) for _, p, _ in sorted(parts)])[:-1])
    pad = total = 0
    for parts in sequences.values():
        parts.sort()
        length = sum(n for _, n in parts)
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1]) and length <= 1024
        total += length
        pad += 0 if length & (length - 1) == 0 else 1024 - length
    assert total == sum(len(ids) for _, ids in expected)
    assert pad <= 0.02 * total


@given(st.integers(0, 10_000))
def test_cuts_add_up(tokens):
    cuts = packing.cuts(tokens)
    assert sum(cuts) == tokens and all(0 < c <= 1024 for c in cuts)
    assert [c for c in cuts if c < packing.SMALLEST] == cuts[-1:] * (tokens % packing.SMALLEST > 0)


def test_packing_of_an_empty_table(spark):
    assert packing.pack(frame(spark, []), BYTE_BPE).count() == 0


def test_capacity_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        packing.pack(frame(spark, []), BYTE_BPE, capacity=1000)


@pytest.fixture(scope="module")
def model():
    return subwords.Subwords(PIECES)


def scanned(model, text, chunk):
    whole = model.processor.normalize(text)
    ends = [*range(chunk, len(whole), chunk), len(whole)]
    entries, exits, matrices, chunks = [], [], [], []
    for k, end in enumerate(ends):
        start = ends[k - 1] if k else 0
        left = max(0, start - model.longest)
        args = (whole[left : end + model.longest], start - left, end - left)
        e, x, m = model.transfer(*args, end == len(whole))
        entries.append(e)
        exits.append(x)
        matrices.append(m)
        chunks.append(args)
    path = subwords.states(entries, exits, matrices)
    return [i for args, (a, b) in zip(chunks, path) for i in model.backtrace(*args, a, b)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "the", "ing", "é", "日", "\n", "0", "aa", "\U0001f600", "  ", "T"]), min_size=1, max_size=40), st.integers(1, 20))
def test_scan_equals_the_library(model, parts, chunk):
    text = "".join(parts)
    assert scanned(model, text, chunk) == model.processor.encode(text)


def test_products_are_associative():
    rng = np.random.default_rng(0)
    a, b, c = (np.where(rng.random(s) < 0.5, 0, subwords.NEVER).astype(np.float32) for s in ((3, 4), (4, 5), (5, 2)))
    left = subwords.product(subwords.product(a, b), c)
    assert np.array_equal(left, subwords.product(a, subwords.product(b, c)))


def test_encoding_equals_the_library(spark, rows, model):
    done = subwords.decode(subwords.encode(frame(spark, rows), PIECES, chunk=700), PIECES).collect()
    assert len(done) == len(rows)
    assert sum(len(t or "") > 700 for _, t in rows) > 10
    expected = sorted((str(i), t or "", tuple(model.processor.encode(t or ""))) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["text"], tuple(r["ids"])) for r in done) == expected
    assert all(r["decoded"] == r["text"] for r in done)


def test_encoding_of_one_endless_word(spark, model):
    text = "ab" * 3000
    row = subwords.encode(frame(spark, [(1, text)]), PIECES, chunk=999).first()
    assert list(row["ids"]) == model.processor.encode(text)


def test_decoding_of_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, [1, 264])], "doc_id bigint, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in subwords.decode(df, PIECES).collect()} == {1: "", 2: "a"}


def test_encoding_of_an_empty_table(spark):
    assert subwords.encode(frame(spark, []), PIECES).count() == 0


def test_scan_over_the_whole_table_equals_the_library(spark, folder, model):
    """All documents of the table, most of them cut into several chunks."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert sum(len(t) > 600 for t in texts.values()) > 20
    got = {r["doc_id"]: r["ids"] for r in subwords.encode(docs, PIECES, chunk=600).collect()}
    assert got == {i: model.processor.encode(t) for i, t in texts.items()}


def test_decoding_of_whole_batches_equals_one_by_one(model):
    """Unknown, missing and control ids give nothing, bytes of no character a mark; also in part of an array."""
    pieces = {i: p.replace("▁", " ").encode() for p, i in model.ids.items()} | {i: bytes([b]) for b, i in model.bytes_.items()}
    lone = model.bytes_[0xE2]
    lists = [
        [], model.processor.encode("  two spaces, é日\U0001f600"), [-1, 10**6, None, 0, 1, 2], [lone], [264, lone, 264],
        model.processor.encode(" "), [model.bytes_[0x20], lone], model.processor.encode("x" * 50),
    ]
    plain = [b"".join(pieces.get(i, b"") for i in ids) for ids in lists]
    texts = [(r[1:] if r.startswith(b" ") else r).decode("utf-8", "replace") for r in plain]
    whole = pa.array(lists, pa.list_(pa.int32()))
    for first in range(len(lists)):
        for last in range(first + 1, len(lists) + 1):
            assert model.decode(whole.slice(first, last - first)).to_pylist() == texts[first:last]


def test_scan_looks_no_further_than_pieces_reach(model, monkeypatch):
    looked, piece = [], subwords.Subwords.piece
    monkeypatch.setattr(subwords.Subwords, "piece", lambda self, text: looked.append(text) or piece(self, text))
    text = model.processor.normalize("Zqxjk vwzzq 0x8f3kq\u4e2d" * 20)
    model.forward(text, 0, len(text), [(0, 0)])
    assert len(looked) < 6 * len(text)
