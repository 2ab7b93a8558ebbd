"""Secrets in text: candidates by pattern, false positives removed by a random forest.

Candidates are the known key formats, also inside a run of other characters;
values of at least ``SHORTEST_VALUE`` characters of any kind that are assigned
to a key word; and every other run of at least ``SHORTEST`` characters that can
make up a key. Names, assignment signs and final punctuation are not part of a
candidate. A forest decides by length, character classes and entropy, how likely
its character transitions are in the corpus, how much of it frequent corpus
words cover, whether it looks like a path or address, and the neighbouring
words. Transitions and words are counted over the whole table. The forest is
fitted on a bounded number (``sample``) of labelled findings; each tree grows in
a task of its own on a bootstrap sample, and the trees, of at most ``2**depth``
leaves each, are broadcast. Scanning then reads every text once and shuffles
nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.links import small_batches, smallest_hashes, stored
from netsift.llm.text import NOT_WORD, pieces, words

SHORTEST, SHORTEST_VALUE = 16, 6
CONTEXT = 32
# Words that announce a secret, and key formats of common services.
KEY_WORDS = re.compile(r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential)")
KNOWN = re.compile(
    r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
    r"|eyJ[\w-]+\.[\w-]+\.[\w-]+|AIza[\w-]{35}"
)
_NAME = (
    r"(?i:token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|auth|credential)[\w.\-]{0,24}[\"'\]]{0,2}\s{0,4}"
)
NAMED = re.compile(_NAME + "$")
ASSIGNED = re.compile(_NAME + r"[=:]{1,3}>?\s{0,4}[\"'`]?$")
HEX_OR_KEY = re.compile(r"[0-9a-f]{24,}|(?=.*\d)(?=.*[A-Za-z])[A-Za-z0-9+/_=\-]{16,}")
# Values that only stand for a secret: variables, markup, addresses and paths.
_PLACEHOLDER = re.compile(r"\$\{.*|\$\(.*|\$[A-Z_]+|<.*>|\{\{.*|%\w+%|\w+://[^@]*|[\w.+\-]+@[\w\-]+\.[\w.]+|\.{0,2}/.*|~/.*|[\w.]+[(\[].*")
_SIGNS = re.compile(r"[=:]+>?")
_VALUE = re.compile(
    r"\s{0,4}(?:\"([^\"\n]{%(n)d,})\"|'([^'\n]{%(n)d,})'|`([^`\n]{%(n)d,})`|[\"'`]?((?:(?!&[\w.\-]+=)[^\s\"'`,;]){%(n)d,}))"
    % {"n": SHORTEST_VALUE}
)
_KNOWN_STARTS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "eyJ", "AIza")
_KNOWN_INSIDE = re.compile(r"(?<![A-Za-z0-9])(?!(?<=[_\-])eyJ)(?:%s)(?![A-Za-z0-9])" % KNOWN.pattern)
_RUN = re.compile(r"[A-Za-z0-9+/_\-.@]{%d,}(?:={1,2}(?![A-Za-z0-9+/_\-.@=\"']))?" % SHORTEST)
_ANY = re.compile("(?s).+")
_CLOSING, _PUNCTUATION = ".,:?)]}>", ".,:?)]}>!#$*"
NAME_CONTEXT = 64
_CLASSES = 28
_CLASS = np.full(256, 27, np.int64)
for _b in range(128):
    _c = chr(_b).lower()
    _CLASS[_b] = ord(_c) - 97 if "a" <= _c <= "z" else 26 if _c.isdigit() else 27
FEATURES = (
    "length", "digits", "upper", "lower", "symbols", "entropy", "switches", "transition", "dictionary",
    "slashes", "dots", "at", "key_word", "assignment", "quoted", "hexadecimal",
)


@dataclass(frozen=True)
class Forest:
    """Settings of the fit; ``sample`` bounds the labelled findings, ``vocabulary`` the frequent words."""

    trees: int = 16
    depth: int = 8
    leaf: int = 5
    sample: int = 20_000
    vocabulary: int = 4096


@dataclass(frozen=True)
class Corpus:
    """Frequent short words, log probabilities of character transitions, and the number of candidates."""

    words: frozenset[str]
    transitions: np.ndarray
    candidates: int = 0


def corpus(docs: DataFrame, settings: Forest = Forest()) -> Corpus:
    """Counts over all texts. Words are of two to six letters a-z, A-Z lower-cased."""

    small_batches(docs.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place counts the candidates.
        pairs = np.zeros(_CLASSES * _CLASSES + 1, np.int64)
        for batch in pieces(batches):
            pairs[-1] += sum(1 for text in batch.column("text").to_pylist() for _ in CANDIDATE.finditer(text or ""))
            found = words(batch.column("text"), NOT_WORD)
            kinds = _CLASS[found.data]
            pairs[:-1] += np.bincount(kinds[:-1] * _CLASSES + kinds[1:], minlength=len(pairs) - 1)
            size = found.ends - found.starts
            letters = np.concatenate([[0], np.cumsum(kinds < 26)])
            plain = (size >= 2) & (size <= 6) & (letters[found.ends] - letters[found.starts] == size)
            begin, size = found.starts[plain], size[plain]
            code = np.zeros(len(begin), np.int64)
            for k in range(6):
                inside = k < size
                code[inside] = code[inside] * 27 + kinds[begin[inside] + k] + 1
            code, n = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["code", "n"])
        at = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(-1 - at), pa.array(pairs[at])], ["code", "n"])

    counted = docs.select("text").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stored(counted, "counts")
    # At most 28 * 28 transitions and ``vocabulary`` words come to the driver.
    pairs = counts.filter("code < 0").toPandas()
    frequent = counts.filter("code > 0").orderBy(F.desc("n"), "code").limit(settings.vocabulary).toPandas()
    table = np.zeros(_CLASSES * _CLASSES + 1, np.int64)
    table[-1 - pairs["code"].to_numpy(np.int64)] = pairs["n"].to_numpy()
    candidates, table = int(table[-1]), 1.0 + table[:-1].reshape(_CLASSES, _CLASSES)

    def spell(code: int) -> str:
        out = ""
        while code:
            code, letter = divmod(code, 27)
            out = chr(96 + letter) + out
        return out

    return Corpus(frozenset(map(spell, frequent["code"].tolist())), np.log(table / table.sum(1, keepdims=True)), candidates)


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """Values assigned to a key word, quoted or up to the next gap, without final punctuation."""
    done = 0
    for sign in _SIGNS.finditer(text):
        if sign.start() < done or sign.end() - sign.start() > 4:
            continue
        if not NAMED.search(text[max(0, sign.start() - NAME_CONTEXT) : sign.start()]):
            continue
        value = _VALUE.match(text, sign.end())
        if not value:
            continue
        start, end = value.span(value.lastindex)
        if value.lastindex == 4:
            found = value[4]
            bare = found.rstrip(_PUNCTUATION)
            key = KNOWN.fullmatch(bare) or HEX_OR_KEY.fullmatch(bare)
            end = start + len(bare if key else found.rstrip(_CLOSING))
        if end - start >= SHORTEST_VALUE:
            done = end
            yield start, end


class Candidates:
    """The candidates of a text, in order and apart from each other; used like a compiled pattern."""

    def finditer(self, text: str) -> Iterator[re.Match]:
        values = list(_assigned(text))
        known = [m.span() for m in _KNOWN_INSIDE.finditer(text)] if any(k in text for k in _KNOWN_STARTS) else []
        spans: list[tuple[int, int]] = []
        for start, end in sorted(values + known, key=lambda s: (s[0], -s[1])):
            if spans and start < spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((start, end))
        at = 0
        for start, end in [*spans, (len(text), len(text))]:
            for m in _RUN.finditer(text, at, start):
                stop = m.start() + len(m[0].rstrip("."))
                if stop - m.start() >= SHORTEST:
                    yield _ANY.match(text, m.start(), stop)
            if start < end:
                yield _ANY.match(text, start, end)
            at = end


CANDIDATE = Candidates()


def coverage(word: str, known: frozenset[str]) -> float:
    """Share of characters that frequent words cover, taking the longest at each place."""
    word = word.lower()
    at = covered = 0
    while at < len(word):
        size = next((n for n in range(6, 1, -1) if word[at : at + n] in known), 0)
        covered += size
        at += size or 1
    return covered / max(len(word), 1)


def features(text: str, start: int, end: int, known: Corpus) -> list[float]:
    found = text[start:end]
    n = len(found)
    kinds = _CLASS[np.frombuffer(found.encode(), np.uint8)]
    counts = np.bincount(np.frombuffer(found.encode(), np.uint8))
    p = counts[counts > 0] / n
    upper = sum(c.isupper() for c in found)
    digits = int((kinds == 26).sum())
    symbols = int((kinds == 27).sum())
    groups = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in found]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + 1]
    return [
        float(n), digits / n, upper / n, (n - digits - upper - symbols) / n, symbols / n, float(-(p * np.log2(p)).sum()),
        sum(a != b for a, b in zip(groups, groups[1:])) / n, float(known.transitions[kinds[:-1], kinds[1:]].mean()),
        coverage(found, known.words), float(found.count("/")), float(found.count(".")), float("@" in found),
        float(bool(KEY_WORDS.search(before))), float(bool(re.search(r"[=:]>?\s*[\"'`]?$", before))),
        float(before[-1:] in "\"'" and after in "\"'" and bool(after)), float(bool(re.fullmatch("[0-9a-fA-F]+", found))),
    ]


def ruled(text: str, start: int, end: int) -> int:
    """Label of a finding by strict rules: a known key format, or a key-like value assigned to a key word.

    A value is also key-like, at any length, if it mixes letters with digits or signs and is no placeholder.
    """
    found = text[start:end]
    if KNOWN.fullmatch(found) or _KNOWN_INSIDE.search(found):
        return 1
    if not ASSIGNED.search(text[max(0, start - NAME_CONTEXT) : start]):
        return 0
    if HEX_OR_KEY.fullmatch(found):
        return 1
    if " " in found or _PLACEHOLDER.fullmatch(found):
        return 0
    return int(bool(re.search("[A-Za-z]", found) and re.search(r"[0-9!@#$%^&*+~?]", found)))


def findings(docs: DataFrame, known: Corpus, settings: Forest = Forest()) -> DataFrame:
    """A sample of the candidates with features and rule labels: (key, label, features).

    At most ``sample`` of them, those with the smallest hashes of id, place and surroundings. Only those below a hash
    that about so many candidates lie below are looked at, and equal ones count once, so little more than the sample
    leaves the tasks, however often rows repeat.
    """
    share = min(1.0, (settings.sample + 6 * math.sqrt(settings.sample)) / max(known.candidates, 1))
    limit = math.ceil(share * 2.0**64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys, label, x = [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for m in CANDIDATE.finditer(text or ""):
                    around = text[max(0, m.start() - NAME_CONTEXT) : m.end() + 1]
                    key = xxhash.xxh64_intdigest(f"{doc} {m.start()} {around}".encode("utf-8", "surrogatepass"))
                    if key < limit:
                        keys.append(key - (1 << 63))
                        label.append(ruled(text, m.start(), m.end()))
                        x.append(features(text, m.start(), m.end(), known))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(label, pa.int32()), pa.array(x, pa.list_(pa.float64()))],
                ["key", "label", "features"],
            )

    every = docs.select("doc_id", "text").mapInArrow(run, "key bigint, label int, features array<double>")
    return every.dropDuplicates(["key"]).orderBy("key").limit(settings.sample)


def labelled(docs: DataFrame, spans: DataFrame, known: Corpus, settings: Forest = Forest()) -> DataFrame:
    """Features of findings that people or other tools have labelled: (key, label, features).

    ``spans`` holds doc_id, start, end (in code points) and label; at most ``sample`` of them are used, those with the
    smallest hashes, so they fit into a broadcast. Spans with a null, without a document or outside its text count for
    nothing; those that repeat, with their document or in it, count once.
    """
    small_batches(docs.sparkSession)
    few = spans.select("doc_id", "start", "end", F.col("label").cast("int").alias("label")).dropna().distinct()
    few = smallest_hashes(few, settings.sample, "doc_id", "start", "end", "label")
    few = few.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "label")).alias("spans"))
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, label, x = [], [], []
            for row in batch.to_pylist():
                text = row["text"] or ""
                for span in row["spans"]:
                    start, end = span["start"], span["end"]
                    if 0 <= start < end <= len(text):
                        around = f"{row['doc_id']} {start} {span['label']} {text[max(0, start - NAME_CONTEXT) : end + 1]}"
                        keys.append(xxhash.xxh64_intdigest(around.encode("utf-8", "surrogatepass")) - (1 << 63))
                        label.append(span["label"])
                        x.append(features(text, start, end, known))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(label, pa.int32()), pa.array(x, pa.list_(pa.float64()))],
                ["key", "label", "features"],
            )

    every = rows.mapInArrow(run, "key bigint, label int, features array<double>")
    return every.dropDuplicates(["key"]).orderBy("key").limit(settings.sample)


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, settings: Forest) -> list[list[float]]:
    """Nodes of one tree: [feature, threshold, left, right, share]; feature -1 marks a leaf."""
    nodes: list[list[float]] = []

    def split(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        share = float(y[rows].mean())
        nodes.append([-1, 0.0, -1, -1, share])
        if depth == settings.depth or len(rows) < 2 * settings.leaf or share in (0.0, 1.0):
            return me
        best = (share * (1 - share) * len(rows) - 1e-9, -1, 0.0)
        for f in rng.choice(x.shape[1], max(1, round(math.sqrt(x.shape[1]))), replace=False):
            values = x[rows, f]
            cuts = np.unique(np.quantile(values, np.linspace(0.02, 0.98, 33)))
            for cut in cuts:
                left = values <= cut
                a = int(left.sum())
                if settings.leaf <= a <= len(rows) - settings.leaf:
                    p, q = y[rows[left]].mean(), y[rows[~left]].mean()
                    impurity = p * (1 - p) * a + q * (1 - q) * (len(rows) - a)
                    if impurity < best[0]:
                        best = (impurity, int(f), float(cut))
        if best[1] >= 0:
            left = x[rows, best[1]] <= best[2]
            nodes[me][:2] = best[1:]
            nodes[me][2] = split(rows[left], depth + 1)
            nodes[me][3] = split(rows[~left], depth + 1)
        return me

    split(np.arange(len(y)), 0)
    return nodes


def fit(labelled: DataFrame, settings: Forest = Forest()) -> list[np.ndarray]:
    """A forest on labelled findings (label, features). Without any there are no trees and all scores are 0."""
    spark = labelled.sparkSession
    sample = labelled.limit(settings.sample).toPandas()
    if sample.empty:
        return []
    x = np.stack(sample["features"].to_numpy())
    y = sample["label"].to_numpy(np.float64)
    shared = spark.sparkContext.broadcast((x, y))

    def tree(part: pd.DataFrame) -> pd.DataFrame:
        number = int(part["id"].iloc[0])
        rng = np.random.default_rng(number)
        # Secrets are rare, so a bootstrap sample takes both classes alike.
        kinds = [k for k in (np.flatnonzero(shared.value[1] == c) for c in (0, 1)) if len(k)]
        rows = np.concatenate([rng.choice(k, len(shared.value[1]) // len(kinds) + 1) for k in kinds])
        nodes = grow(shared.value[0][rows], shared.value[1][rows], rng, settings)
        return pd.DataFrame({"tree": number, "nodes": [nodes]})

    trees = spark.range(settings.trees).groupBy("id").applyInPandas(tree, "tree bigint, nodes array<array<double>>")
    return [np.array([list(n) for n in r["nodes"]]) for r in trees.orderBy("tree").collect()]


def vote(x: np.ndarray, trees: list[np.ndarray]) -> np.ndarray:
    """Mean share of all trees for each row of features."""
    total = np.zeros(len(x))
    for nodes in trees:
        at = np.zeros(len(x), np.int64)
        while (nodes[at, 0] >= 0).any():
            inner = np.flatnonzero(nodes[at, 0] >= 0)
            node = nodes[at[inner]]
            left = x[inner, node[:, 0].astype(np.int64)] <= node[:, 1]
            at[inner] = np.where(left, node[:, 2], node[:, 3]).astype(np.int64)
        total += nodes[at, 4]
    return total / max(len(trees), 1)


FOUND = "array<struct<start:int,end:int,score:double,secret:boolean>>"


def scan(
    docs: DataFrame, known: Corpus, trees: list[np.ndarray], threshold: float = 0.5, text_column: str = "text"
) -> DataFrame:
    """All columns of ``docs`` and ``findings``: start and end (in code points), score and verdict of each candidate.

    Null and empty texts have no findings. Rows are handled one by one, so
    repeated rows keep a row each; a column ``findings`` is replaced.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((known, trees))
    keep = [c for c in docs.columns if c != "findings"]
    others = [c for c in keep if c != text_column]
    rest = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none"))
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("secret", pa.bool_())])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus_, trees_ = shared.value
        for batch in pieces(batches):
            spans, x = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for m in CANDIDATE.finditer(text or ""):
                    spans.append((row, m.start(), m.end()))
                    x.append(features(text, m.start(), m.end(), corpus_))
            score = vote(np.array(x), trees_) if x else []
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for (row, start, end), s in zip(spans, score):
                out[row].append({"start": start, "end": end, "score": float(s), "secret": bool(s >= threshold)})
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("rest"), pa.array(out, kind)], ["text", "rest", "findings"]
            )

    rows = docs.select(docs[text_column].cast("string").alias("text"), rest.alias("rest"))
    result = rows.select("text", "rest").schema.add("findings", rows.select(F.lit(None).cast(FOUND)).schema[0].dataType)
    done = rows.mapInArrow(run, result)
    place = {c: f"rest.c{i}" for i, c in enumerate(others)} | {text_column: "text"}
    return done.select(*[F.col(place[c]).alias(c) for c in keep], "findings")


def redacted(text: str = "text", findings: str = "findings", mark: str = "[SECRET]") -> F.Column:
    """The text with every secret replaced by ``mark``; unchanged where there is none."""
    hits = F.filter(F.col(findings), lambda f: f["secret"])
    cut = F.aggregate(
        hits,
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda acc, f: F.struct(
            F.concat(acc["done"], F.substring(F.col(text), acc["at"] + 1, f["start"] - acc["at"]), F.lit(mark)).alias("done"),
            f["end"].alias("at"),
        ),
        lambda acc: F.concat(acc["done"], F.substring(F.col(text), acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(hits) > 0, cut).otherwise(F.col(text))


def fitted(
    docs: DataFrame, settings: Forest = Forest(), spans: DataFrame | None = None
) -> tuple[Corpus, list[np.ndarray]]:
    """Corpus counts and a forest from labelled findings in ``docs`` (doc_id, text).

    ``spans`` are the findings with their labels, see ``labelled``; without them the rules label the table's own.
    """
    known = corpus(docs, settings)
    return known, fit(findings(docs, known, settings) if spans is None else labelled(docs, spans, known, settings), settings)
