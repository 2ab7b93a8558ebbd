"""Work arrays and pairs that the text operators hold at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa

from netsift.llm import substrings, text, vectors


def test_pieces_are_a_quarter_of_a_megabyte():
    texts = ["x" * 50_000] * 40 + ["y" * 600_000, None, ""]
    batch = pa.record_batch({"text": pa.array(texts), "id": pa.array(range(len(texts)))})
    found = list(text.pieces([batch]))
    assert [i for p in found for i in p.column("id").to_pylist()] == list(range(len(texts)))
    sizes = [sum(len(t or "") for t in p.column("text").to_pylist()) for p in found]
    assert max(sizes) <= 600_000 and sorted(sizes)[-2] <= 1 << 18


def test_runs_of_many_words_take_powers_of_a_step_only(monkeypatch):
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 300_000).astype(np.uint64)
    begin = np.sort(rng.choice(300_000 - 20, 50_000, replace=False))
    for which in (0, 1):
        fresh = [text._Powers(p.base) for p in text._WORD_POWERS]
        whole = text.span_hash(hashes, begin, begin + 20, fresh[which])
        fresh = [text._Powers(p.base) for p in text._WORD_POWERS]
        monkeypatch.setattr(text, "_WORD_POWERS", fresh)
        assert (text.runs(hashes, begin, 20, which) == whole).all()
        assert len(fresh[which].up) <= text.STEP
        assert (text.runs(hashes, begin, 20, which, step=7) == whole).all()
    assert len(text.runs(hashes[:0], begin[:0], 20)) == 0


def group_of(texts):
    ids = np.arange(len(texts))[::-1].copy()
    return pa.table(
        {
            "doc_id": pa.array(ids), "text": pa.array(texts, pa.string()), "part": pa.array([0] * len(texts), pa.int32()),
            "rest": pa.array([{"none": 0}] * len(texts), pa.struct([("none", pa.int32())])),
        }
    )


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("text", pa.string()), ("rest", pa.struct([("none", pa.int32())])), ("n_words", pa.int64()),
        ("n_removed", pa.int64()), ("kept", pa.string()),
        ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
NONE = pa.table({"part": pa.array([], pa.int32()), "places": pa.array([], pa.binary())})


def test_a_group_of_texts_takes_a_small_multiple_of_its_bytes():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{w:05d}" for w in rng.integers(0, 100_000, 700)) for _ in range(800)]
    texts[400:420] = texts[:20]
    group = group_of(texts)
    steps = {
        "anchors": lambda: substrings.send_anchors(group, 4), "windows": lambda: substrings.send_windows(group, NONE, 4),
        "remove": lambda: substrings.remove(group, NONE, RESULT),
    }
    size, peak = sum(map(len, texts)), {}
    for name, step in steps.items():
        step()
        tracemalloc.start()
        done = step()
        peak[name] = tracemalloc.get_traced_memory()[1] / size
        tracemalloc.stop()
    assert sum(done.column("n_removed").to_pylist()) == 20 * 700
    assert max(peak.values()) <= 11


def test_a_group_goes_back_in_batches_of_a_quarter_of_a_megabyte():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{w:05d}" for w in rng.integers(0, 100_000, 700)) for _ in range(300)] + [None, "", "x" * 400_000, " \n"]
    done = substrings.remove(group_of(texts), NONE, RESULT)
    assert done.column("doc_id").to_pylist() == list(range(len(texts)))
    assert done.column("text").to_pylist() == texts[::-1]
    assert done.column("n_words").to_pylist() == [len((t or "").split()) for t in texts[::-1]]
    assert done.column("kept").to_pylist() == [" ".join((t or "").split()) for t in texts[::-1]]
    sizes = [sum(len(t or "") for t in b.column("text").to_pylist()) for b in done.to_batches()]
    assert max(sizes) == 400_000 and sorted(sizes)[-2] <= 1 << 18


def test_few_unrelated_pairs_reach_the_windows():
    """Only pairs that share enough cells are compared by windows, and none that collide often enough is lost."""
    rng = np.random.default_rng(5)
    units = vectors.unit(rng.standard_normal((600, 48)))
    units[1::20] = vectors.unit(units[::20] + 0.01 * rng.standard_normal((30, 48)))
    lists = vectors.calibrated(50_000)
    cell, at = vectors.places(units, lists)
    i, j = np.triu_indices(len(units), 1)
    enough = vectors._sharing(cell.astype(np.uint16), i, j, lists.least)
    hits = ((cell[i] == cell[j]) & (np.abs(at[i] - at[j]) <= vectors.WINDOW)).sum(1) >= lists.least
    assert not (hits & ~enough).any()
    assert hits.sum() >= 30 and enough.mean() < 0.01


def test_links_of_a_group_are_those_of_all_windows():
    rng = np.random.default_rng(7)
    units = vectors.unit(rng.standard_normal((200, 48)))
    units[1::10] = vectors.unit(units[::10] + 0.01 * rng.standard_normal((20, 48)))
    lists, every = vectors.calibrated(5_000), slice(0, 200)
    ids, weight = np.arange(200), np.ones(200, np.int64)
    cell, at = vectors.places(units, lists)
    i, j = np.triu_indices(200, 1)
    hits = (cell[i] == cell[j]) & (np.abs(at[i] - at[j]) <= vectors.WINDOW)
    linked = (hits.sum(1) >= lists.least) & (np.einsum("ij,ij->i", units[i], units[j]) >= vectors.THRESHOLD)
    for table in range(lists.tables):
        # A group is all vectors here, so pairs of other cells are in the windows too.
        mine = linked & (hits.argmax(1) == table)
        wanted = np.bincount(np.concatenate([i[mine], j[mine]]), minlength=200)
        index, partners, _ = vectors._within(table, 200, every, every, True, ids, weight, units, lists, vectors.THRESHOLD)
        assert index.tolist() == np.flatnonzero(wanted).tolist() and partners.tolist() == wanted[wanted > 0].tolist()


def test_vectors_that_share_no_other_cell_are_not_projected_for_all_lists(monkeypatch):
    rng = np.random.default_rng(5)
    units = vectors.unit(rng.standard_normal((64, 32)))
    units[1] = vectors.unit((units[0] + 0.01 * units[2])[None])[0]
    lists, every = vectors.calibrated(50_000), slice(0, 64)
    cell, at = vectors.places(units, lists)
    table = int(np.argmax((cell[0] == cell[1]) & (np.abs(at[0] - at[1]) <= vectors.WINDOW)))
    assert all(np.array_equal(vectors.spots(units, lists, t), at[:, t]) for t in range(lists.tables))
    seen = []
    spots = vectors.spots
    monkeypatch.setattr(vectors, "spots", lambda u, ls, t=None: (seen.append(len(u)) if t is None else None, spots(u, ls, t))[1])
    monkeypatch.setattr(vectors, "places", None)
    ids, weight = np.arange(64), np.ones(64, np.int64)
    index, partners, root = vectors._within(
        table, 64, every, every, True, ids, weight, units, lists, vectors.THRESHOLD, cell
    )
    assert (index.tolist(), partners.tolist(), root.tolist()) == ([0, 1], [1, 1], [0, 0])
    i, j = np.triu_indices(64, 1)
    share = vectors._sharing(cell, i, j, lists.least)
    assert sum(seen) <= len(np.unique(np.concatenate([i[share], j[share]]))) < 64
    assert vectors.directions(32, lists) is vectors.directions(32, lists)


def test_small_groups_looked_at_together_give_the_links_of_each(monkeypatch):
    monkeypatch.setattr(vectors, "PAIRS", 100)
    rng = np.random.default_rng(7)
    lists, sizes = vectors.calibrated(5_000), (30, 1, 45, 2, 30)
    near = rng.standard_normal((6, 24))
    units = vectors.unit(near[rng.integers(0, 6, sum(sizes))] + 0.02 * rng.standard_normal((sum(sizes), 24)))
    cell, _ = vectors.places(units, lists)
    ids, weight = rng.permutation(len(units)), rng.integers(1, 4, len(units))
    group, table = np.repeat(np.arange(len(sizes)), sizes), np.repeat([0, 0, 1, 2, 5], sizes)
    every = slice(0, len(units))
    index, partners, root = vectors._within(
        table, len(units), every, every, True, ids, weight, units, lists, vectors.THRESHOLD, cell, group
    )
    want = []
    for g in range(len(sizes)):
        at = np.flatnonzero(group == g)
        all_of = slice(0, len(at))
        one = vectors._within(
            int(table[at[0]]), len(at), all_of, all_of, True, ids[at], weight[at], units[at], lists, vectors.THRESHOLD
        )
        want += zip(at[one[0]].tolist(), one[1].tolist(), at[one[2]].tolist())
    assert len(want) > 20
    assert list(zip(index.tolist(), partners.tolist(), root.tolist())) == want
