"""Repeated passages, near duplicates and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash

from netsift.llm import fingerprints, neardup, substrings
from netsift.llm.links import components

SCHEMA = "doc_id bigint, text string, rest string, part int, n_words string, key string"


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def frame(spark, rows):
    """Documents with other columns, some of them named as the operators' own."""
    return spark.createDataFrame([(i, t, "r", 7, "x", "k") for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice("aa bb cc dd ee ff gg é hh ii".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    passage, line = prose(rng, 60), prose(rng, 20)
    base = [prose(rng, rng.choice([3, 19, 20, 21, 80, 300])) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(40, 80):
        t = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            t[rng.randrange(len(t))] = f"edit{rng.randrange(1000)}"
        rows.append((i, " ".join(t)))
    for i in range(80, 100):
        rows.append((i, f"{prose(rng, 30)}\n{passage}\t{prose(rng, rng.randrange(30))}\x0b{line}"))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one"), (104, "ONE"), (105, "x " * 5000), (106, "x " * 5000)]
    rows += [(107, base[3]), (107, base[3]), (None, base[4]), (None, None), (108, "é" * 30_000 + " tail")]
    rng.shuffle(rows)
    return rows


def plain_repeats(rows):
    seen, out = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if seen.setdefault(tuple(w[s : s + 20]), (i, s)) != (i, s):
                gone[s : s + 20] = [True] * 20
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_repeats_equal_plain_version(spark, documents):
    rows = [r for r in documents if r[0] is not None]
    done = substrings.remove_repeats(frame(spark, rows)).collect()
    assert len(done) == len(rows)
    expected = plain_repeats(rows)
    for r in done:
        assert (r["n_words"], r["n_removed"], r["kept"]) == expected[r["doc_id"]], r["doc_id"]
        assert (r["rest"], r["part"], r["key"]) == ("r", 7, "k")
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_repeats_with_null_ids_come_first(spark):
    text = " ".join(f"w{i}" for i in range(25))
    done = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(frame(spark, [(1, text), (None, text)])).collect()}
    assert done == {None: 0, 1: 25}


def test_repeats_do_not_depend_on_the_number_of_groups(spark, documents):
    rows = [r for r in documents if r[0] is not None]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = {(r["doc_id"], r["kept"]) for r in substrings.remove_repeats(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == {(r["doc_id"], r["kept"]) for r in substrings.remove_repeats(frame(spark, rows)).collect()}


def test_cover_meets_every_shift():
    pairs = {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER}
    assert pairs == set(range(substrings.PERIOD))


def shingle_set(text):
    w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_near_duplicates_equal_plain_version(spark, documents):
    rows = list(dict.fromkeys(r for r in documents if r[0] is not None))
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    expected = roots(ids, links)
    assert any(v != k for k, v in expected.items())
    done = neardup.near_duplicates(frame(spark, documents)).collect()
    assert len(done) == len(documents)
    for r in done:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, True)
        else:
            i = r["doc_id"]
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), expected[i], expected[i] == i)


def test_link_that_the_centre_does_not_show(spark):
    """1-2 and 1-3 are unlike, 2-3 are alike, and all three share buckets with 1 in the middle."""
    rng = random.Random(2)
    base = prose(rng, 400).split()

    def edited(spots, mark):
        t = list(base)
        for s in spots:
            t[s] = f"{mark}{s}"
        return " ".join(t)

    rows = [(1, edited(range(0, 200, 12), "p"))] + [(i, edited([*range(200, 399, 30), i], "q")) for i in range(2, 40)]
    sets = {i: shingle_set(t) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    expected = roots(sets, links)
    assert expected[1] == 1 and expected[3] == 2
    done = neardup.near_duplicates(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in done} == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 100 + i) for i in range(50)] + [(7, 7), (500, 500)]
    random.Random(1).shuffle(links)
    done = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert done == roots({n for e in links for n in e}, links)


@pytest.mark.parametrize("operator", [substrings.remove_repeats, neardup.near_duplicates, fingerprints.edited_fingerprints])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


def fold(values, seed=42):
    """Spark's hash of an array of strings or numbers: one after the other, each seeding the next."""
    for v in values:
        raw = v if isinstance(v, bytes) else v.to_bytes(8 if v >= 1 << 31 or v < 0 else 4, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


def plain_fingerprint(text):
    w = words(text)
    found = {fold(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    bins = {}
    for h in found:
        signed = h - (1 << 64) if h >= 1 << 63 else h
        bins[h >> 57] = min(bins.get(h >> 57, signed), signed)
    if not bins:
        return []
    order = sorted(bins, key=lambda b: (bins[b]))
    out = []
    for j in range(128):
        if j not in bins:
            def rank(pair):
                h = fold([j, pair[1]])
                h = h - (1 << 64) if h >= 1 << 63 else h
                return (h & ~127) | pair[0]
            own = min(enumerate(order), key=rank)[1]
        else:
            own = j
        out.append(bins[own] & 255)
    return out


def plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    same = sum(x == y for x, y in zip(a, b)) / 128
    return max((same - 1 / 256) / (1 - 1 / 256), 0.0)


def test_fingerprints_equal_plain_version(spark, documents):
    rows = sorted({i: t or "" for i, t in documents if i is not None}.items())
    done = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(frame(spark, rows)).collect()}
    assert len(done) == len(rows)
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        a, b, c = map(plain_fingerprint, (text, edited, following))
        r = done[i]
        assert (r["n_chars"], r["edited"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), edited, a, b), i
        assert (r["near_edited"], r["near_next"]) == (pytest.approx(plain_likeness(a, b)), pytest.approx(plain_likeness(a, c)))


def test_fingerprints_of_odd_rows(spark):
    rows = [(None, "a b c d e f g h"), (5, "x y"), (5, "x y"), (9, None)]
    done = fingerprints.edited_fingerprints(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in done) == ["5", "5", "9", "None"]
    by = {r["doc_id"]: r for r in done}
    assert by[None]["edited"] == "a b c d e f " and by[None]["near_next"] == 0.0
    assert by[9]["fingerprint"] == [] and by[5]["near_next"] == 0.0


def test_likeness_follows_jaccard(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
    rows = [(2 * k, " ".join(base)) for k in range(1)]
    done = fingerprints.edited_fingerprints(frame(spark, rows + [(1, prose(rng, 2000))])).collect()
    near = {r["doc_id"]: r["near_edited"] for r in done}
    assert near[0] == pytest.approx(0.6, abs=0.15)
    assert len(hashlib.sha256(b"").hexdigest()) == 64
