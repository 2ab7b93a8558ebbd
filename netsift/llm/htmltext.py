"""Main text of web pages by minimum-cut labelling.

A page is read into blocks of text (``read``). Each block has a cost of being
content and one of being boilerplate: a logistic classifier looks at the block
itself (kind, length, links, punctuation, place, neighbours), and elements that
tell their purpose (``article``, ``nav``, ``class="comments"``, ...) add evidence
to all blocks in them. The costs are the terminal capacities of a graph; blocks
that follow each other or share a parent element are joined by smoothness edges,
weaker the further apart they are in the tree. The minimum cut separates content
from boilerplate; of equally cheap cuts the one with the least content counts.

The classifier is trained on pages of the corpus: the elements that tell their
purpose label the blocks in them, which the classifier sees without these
elements, so that it also judges pages without any. Its features are counts of
a fixed number of kinds of blocks, so what reaches the driver is bounded; where
few blocks are labelled, its weights stay near ``PRIOR``.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.llm.links import small_batches
from netsift.llm.text import pieces

#: Pages that the classifier is trained on, chosen by a hash of their columns; all pages of smaller tables.
SAMPLE = 4000

_TAG = re.compile(
    r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
# Elements whose content is no text of the page, up to their end tag whatever stands between. Without an end tag, the
# first kind reaches to the end of the page, and the second kind is passed over.
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes"}
_SKIPPED = {"template", "svg", "select", "button", "object", "canvas", "audio", "video", "datalist", "label"}
_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in _RAW | _SKIPPED}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
# A start tag of the key ends an open element of these names, up to the names after it.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PARAGRAPHS = {"p", "blockquote", "pre", "figcaption", "dd", "dt"}
_CELLS = {"td", "th", "caption"}

# What elements tell of their content. Firm marks hold wherever they stand. Mild and loose ones do not hold for the bulk
# of a page (with all that is marked as content in it); within loose ones, an element marked as content is content.
_CONTENT_TAGS = {"article", "main"}
_CONTENT_ROLES = {"main", "article"}
_CONTENT_WORDS = {"article", "content", "post", "entry", "story", "main", "maincontent", "articlebody", "postbody"}
_FIRM_TAGS = {"nav", "footer", "aside", "menu", "dialog"}
_LOOSE_TAGS = {"header", "form"}
_FIRM_ROLES = {"navigation", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar"}
_FIRM_WORDS = set(
    "comment comments commentlist disqus reply replies respond discussion ad ads advert adverts advertisement advertising "
    "sponsor sponsored cookie cookies consent gdpr related recommended".split()
)
_MILD_WORDS = set(
    "promo newsletter subscribe signup share sharing social breadcrumb breadcrumbs pagination pager copyright nav "
    "navigation navbar menu sidebar footer hidden".split()
)
_LOOSE_WORDS = set(
    "header masthead banner notice alert popup modal overlay login search widget toolbar form topbar disclaimer".split()
)
_NOT_WORD = {"has", "with", "no", "without"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

NONE, CONTENT, FIRM, MILD, LOOSE = range(5)

#: Costs and edges, in thousandths of a logit.
EVIDENCE, OUTSIDE, MOST_LOGIT = 6000, 3000, 3000
NEAR, AKIN, FAR, ACROSS, SIBLING = 1000, 600, 250, 50, 600

# Kinds of a feature, and weights before any training: prose is long, punctuated and free of links.
LEVELS = {"kind": 5, "words": 6, "links": 4, "ends": 2, "commas": 2, "before": 2, "after": 2, "place": 3}
PRIOR = {
    "kind": (2.0, 1.0, -0.5, 0.0, -0.3), "words": (-1.5, -1.0, -0.3, 0.3, 1.0, 1.5), "links": (0.3, 0.0, -1.0, -2.5),
    "ends": (-0.3, 0.4), "commas": (-0.1, 0.3), "before": (0.1, -0.4), "after": (0.1, -0.4), "place": (-0.3, 0.2, -0.3),
}
#: Labelled blocks that the prior weights count as.
PRIOR_BLOCKS = 20.0


@dataclass
class Page:
    """Blocks of a page in page order, and the tree of its elements (0 is the root; parents come first)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    mark: list[int] = field(default_factory=lambda: [NONE])
    node: list[int] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def _mark(tag: str, attributes: str, in_content: bool) -> tuple[int, bool]:
    """What an element tells of its content, and whether it is hidden."""
    if tag in _CONTENT_TAGS:
        told = CONTENT
    elif tag in _FIRM_TAGS:
        told = FIRM
    elif tag in _LOOSE_TAGS and not (tag == "header" and in_content):
        told = LOOSE
    else:
        told = NONE
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return told, False
    hidden, names = False, []
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), next((g for g in found.groups()[1:] if g is not None), "")
        if name in ("class", "id"):
            names += value.split()
        elif name == "role" and told in (NONE, LOOSE):
            role = value.strip().lower()
            told = CONTENT if role in _CONTENT_ROLES else FIRM if role in _FIRM_ROLES else LOOSE if role == "banner" else told
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    if told in (NONE, LOOSE) and tag not in ("html", "body"):
        for name in names:
            parts = [w.lower() for w in _WORD.findall(name)]
            if set(parts) & _NOT_WORD:
                continue
            if set(parts) & _FIRM_WORDS:
                told = FIRM
                break
            if set(parts) & _MILD_WORDS:
                told = MILD
                continue
            if told == MILD:
                continue
            if set(parts) & _LOOSE_WORDS and not (told == NONE and in_content and "header" in parts):
                told = LOOSE
            elif set(parts) & _CONTENT_WORDS and told == NONE:
                told = CONTENT
    return told, hidden


def read(html: str) -> Page:
    """The blocks of a page. Missing end tags, cut pages and stray ``<`` are read as browsers do, as far as text goes."""
    page = Page()
    stack = [0]
    depth_of: dict[str, int] = {}
    content_depth = 0
    parts: list[str] = []
    links = link_words = 0
    # Depth of the stack at which a link was opened; it ends with the element around it at the latest.
    link_at = -1
    skipped, at, n = 0, 0, len(html)
    absent: set[str] = set()

    def close() -> None:
        nonlocal links
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                page.node.append(stack[-1])
                page.text.append(text)
                page.words.append(text.count(" ") + 1)
                page.linked.append(min(links, text.count(" ") + 1))
            parts.clear()
        links = 0

    def pop() -> None:
        nonlocal content_depth, skipped, link_at
        node = stack.pop()
        tag = page.tag[node]
        depth_of[tag] -= 1
        content_depth -= page.mark[node] == CONTENT
        skipped -= page.mark[node] < 0
        link_at = -1 if link_at > len(stack) else link_at

    while at < n:
        found = _TAG.search(html, at)
        stop = found.start() if found else n
        if stop > at and not skipped:
            parts.append(html[at:stop])
            if link_at >= 0:
                links += len(html[at:stop].split())
        if not found:
            break
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "a":
                link_at = -1
            elif tag in _INLINE:
                pass
            elif tag == "p" and not depth_of.get("p"):
                close()
            elif depth_of.get(tag):
                close()
                while page.tag[stack[-1]] != tag:
                    pop()
                pop()
            continue
        if tag in _END:
            end = None if tag in absent else _END[tag].search(html, at)
            if end:
                at = _TAG.match(html, end.start()).end()
            elif tag in _RAW:
                at = n
            else:
                absent.add(tag)
            continue
        if tag == "a":
            link_at = len(stack)
            continue
        if tag in _INLINE:
            if tag == "br" or tag == "img":
                parts.append(" ")
            continue
        close()
        if tag in _VOID:
            continue
        if depth_of.get("p"):
            # Only what may stand inside a paragraph leaves it open; nothing that opens a block does.
            while page.tag[stack[-1]] != "p":
                pop()
            pop()
        ends = _ENDS.get(tag)
        if ends:
            names, limits = ends
            # Not searched deeper than this, as pages may leave any number of elements open.
            for k in range(len(stack) - 1, max(len(stack) - 64, 0), -1):
                if page.tag[stack[k]] in limits:
                    break
                if page.tag[stack[k]] in names:
                    while len(stack) > k:
                        pop()
                    break
        mark, hidden = _mark(tag, found[3], content_depth > 0)
        page.parent.append(stack[-1])
        page.tag.append(tag)
        page.mark.append(-1 if hidden else mark)
        depth_of[tag] = depth_of.get(tag, 0) + 1
        stack.append(len(page.tag) - 1)
        content_depth += mark == CONTENT and not hidden
        skipped += hidden
    close()
    return page


def evidence(page: Page) -> tuple[list[int], list[int]]:
    """For each block: 1 inside content, -1 inside boilerplate, -2 outside the content that the page marks, else 0.

    The second list names the element that tells it. Within boilerplate of firm or
    mild marks, only ``main`` can be content again.
    """
    size = len(page.tag)
    words, linked = [0] * size, [0] * size
    for node, n, k in zip(page.node, page.words, page.linked):
        words[node] += n
        linked[node] += k
    content = [int(mark == CONTENT) for mark in page.mark]
    for node in range(size - 1, 0, -1):
        for total in (words, linked, content):
            total[page.parent[node]] += total[node]
    says, by = [0] * size, [0] * size
    for node in range(1, size):
        above, mark = page.parent[node], page.mark[node]
        says[node], by[node] = says[above], by[above]
        bulk = 2 * words[node] > words[0] and 2 * linked[node] < words[node] and content[node] == content[0]
        if mark in (MILD, LOOSE) and bulk:
            mark = NONE
        if mark == CONTENT:
            if says[above] >= 0 or page.mark[by[above]] == LOOSE or page.tag[node] == "main":
                says[node], by[node] = 1, node
        elif mark in (FIRM, MILD, LOOSE):
            says[node], by[node] = -1, node
    marked = any(says[node] > 0 for node in page.node)
    return [says[n] if says[n] or not marked else -2 for n in page.node], [by[n] for n in page.node]


def _step(value: float, limits: tuple[float, ...]) -> int:
    return sum(value >= limit for limit in limits)


def kinds(page: Page) -> list[tuple[int, ...]]:
    """The features of each block, as a level of each of ``LEVELS``."""
    share = [k / n for k, n in zip(page.linked, page.words)]
    count = len(share)
    out = []
    for i, (node, text, n) in enumerate(zip(page.node, page.text, page.words)):
        tag = page.tag[node]
        kind = 0 if tag in _HEADINGS else 1 if tag in _PARAGRAPHS else 2 if tag == "li" else 3 if tag in _CELLS else 4
        place = 0 if 10 * i < count else 2 if 10 * (i + 1) > 9 * count else 1
        out.append(
            (
                kind, _step(n, (3, 6, 11, 21, 41)), _step(share[i], (1e-9, 1 / 3, 2 / 3)), int(text[-1] in ".!?…。"),
                int("," in text or ";" in text), int(i > 0 and share[i - 1] >= 2 / 3), int(i + 1 < count and share[i + 1] >= 2 / 3), place,
            )
        )
    return out


def edges(page: Page, by: list[int]) -> list[tuple[int, int, int]]:
    """Smoothness edges between blocks (i, j, weight): neighbours, and the next block of the same parent."""
    parent, out, last = page.parent, [], {}
    for j, node in enumerate(page.node):
        home = parent[node]
        if j:
            i, other = j - 1, page.node[j - 1]
            if by[i] != by[j]:
                weight = ACROSS
            elif node == other or home in (parent[other], other) or parent[other] == node:
                weight = NEAR
            else:
                weight = AKIN if home > 0 and parent[other] > 0 and parent[home] == parent[parent[other]] else FAR
            out.append((i, j, weight))
        i = last.get(home, -1)
        if 0 <= i < j - 1 and by[i] == by[j]:
            out.append((i, j, SIBLING))
        last[home] = j
    return out


def labels(gain: list[int], joined: list[tuple[int, int, int]]) -> list[bool]:
    """Minimum cut: which blocks are content, if ``gain`` is the cost of boilerplate less that of content.

    Blocks whose gain outweighs all their edges are settled first, whatever the
    others become; max-flow decides the rest.
    """
    n = len(gain)
    gain, near = list(gain), [{} for _ in range(n)]
    for i, j, w in joined:
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    pull = [sum(x.values()) for x in near]
    label: list[bool | None] = [None] * n
    open_ = deque(range(n))
    while open_:
        i = open_.popleft()
        if label[i] is not None or -pull[i] < gain[i] <= pull[i]:
            continue
        label[i] = gain[i] > pull[i]
        for j, w in near[i].items():
            gain[j] += w if label[i] else -w
            pull[j] -= w
            del near[j][i]
            open_.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {i: k for k, i in enumerate(rest)}
        pairs = [(number[i], number[j], w) for i in rest for j, w in near[i].items() if i < j]
        for i, side in zip(rest, _cut([gain[i] for i in rest], pairs)):
            label[i] = side
    return [bool(x) for x in label]


def _cut(gain: list[int], joined: list[tuple[int, int, int]]) -> list[bool]:
    """Max-flow by blocking flows over level graphs; the blocks that the source still reaches are content."""
    n = len(gain)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, g in enumerate(gain):
        if g > 0:
            edge(source, i, g, 0)
        elif g < 0:
            edge(i, sink, -g, 0)
    for i, j, w in joined:
        edge(i, j, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []
        while True:
            a = to[path[-1]] if path else source
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # Go on from the first edge that is full.
                path = path[: next(k for k, e in enumerate(path) if not room[e])]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > 0 and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
            elif path:
                path.pop()
                at[to[path[-1]] if path else source] += 1
            else:
                break


@dataclass(frozen=True)
class Model:
    """Weight of each level of each feature, in the order of ``LEVELS``, and of every block."""

    weights: tuple[tuple[float, ...], ...] = tuple(PRIOR.values())
    intercept: float = 0.0

    def gain(self, kind: tuple[int, ...], told: int) -> int:
        """Cost of boilerplate less that of content of one block."""
        logit = 1000 * (self.intercept + sum(w[k] for w, k in zip(self.weights, kind)))
        known = {1: EVIDENCE, -1: -EVIDENCE, -2: -OUTSIDE, 0: 0}[told]
        return known + round(max(-MOST_LOGIT, min(MOST_LOGIT, logit)))


def main_text(html: str | None, model: Model = Model()) -> str:
    """The content blocks of a page, joined by line feeds."""
    page = read(html or "")
    told, by = evidence(page)
    gain = [model.gain(k, t) for k, t in zip(kinds(page), told)]
    return "\n".join(t for t, content in zip(page.text, labels(gain, edges(page, by))) if content)


def fitted(counts: list[tuple[tuple[int, ...], int, int]]) -> Model:
    """Logistic regression on (features, label, number of blocks), drawn towards ``PRIOR``; Newton steps."""
    if not counts:
        return Model()
    sizes = list(LEVELS.values())
    offset = np.cumsum([0, *sizes[:-1]])
    x = np.zeros((len(counts), sum(sizes) + 1))
    for row, (kind, _, _) in enumerate(sorted(counts)):
        x[row, offset + np.array(kind)] = 1
    x[:, -1] = 1
    y, n = (np.array([c[k] for c in sorted(counts)], float) for k in (1, 2))
    prior = np.concatenate([*PRIOR.values(), [0.0]])
    w = prior.copy()

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + PRIOR_BLOCKS / 2 * ((v - prior) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (n * (p - y)) + PRIOR_BLOCKS * (w - prior)
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + PRIOR_BLOCKS * np.eye(len(w))
        step, size = np.linalg.solve(bend, slope), 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    w = np.round(w, 6)
    return Model(tuple(tuple(w[o : o + s].tolist()) for o, s in zip(offset, sizes)), float(w[-1]))


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> Model:
    """The classifier, trained on about ``sample`` pages of the table; ``PRIOR`` for a table without labelled blocks.

    Pages are chosen by a hash of all columns but the html, so the same table gives the same model however it is split;
    rows that agree in these columns are all chosen or all left.
    """
    share = min(1.0, sample / max(pages.count(), 1))
    small_batches(pages.sparkSession)
    others = [F.col(f"`{c}`").cast("string") for c in pages.columns if c != html] or [F.xxhash64(pages[html])]
    chosen = pages.filter(F.pmod(F.xxhash64(*others), F.lit(1_000_000)) < math.ceil(share * 1_000_000))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}
        for batch in batches:
            for source in batch.column("html").to_pylist():
                page = read(source or "")
                for kind, told in zip(kinds(page), evidence(page)[0]):
                    if told in (1, -1):
                        held[(*kind, told)] = held.get((*kind, told), 0) + 1
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in held], pa.list_(pa.int32())), pa.array(held.values(), pa.int64())], ["key", "n"])

    found = chosen.select(F.col(html).cast("string").alias("html")).mapInArrow(count, "key array<int>, n bigint")
    # At most one row for each combination of levels, whatever the number of pages.
    rows = found.groupBy("key").agg(F.sum("n").alias("n")).collect()
    return fitted([(tuple(r["key"][:-1]), int(r["key"][-1] == 1), r["n"]) for r in rows])


def extract(pages: DataFrame, model: Model, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the html) of every page, with ``text`` and ``n_chars`` (code points).

    Null and empty pages, and pages without any content, have an empty text.
    Every row is judged by itself, so repeated rows give a row each. Columns of
    ``pages`` named ``text`` or ``n_chars`` are replaced; an empty table gives an
    empty result. Whole pages are read, however long; a page is the unit of work.
    Character references are decoded, white space within a block becomes one
    space, ``br`` counts as white space, and blocks are joined by one line feed.
    """
    names = [c for c in (pages.columns if keep is None else keep) if c not in (html, "text", "n_chars")]
    rows = pages.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{html}`").cast("string").alias("text"))
    small_batches(pages.sparkSession)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [main_text(source, model) for source in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"]
            )

    fields = [f for f in rows.schema.fields if f.name in names]
    schema = rows.select(*[F.col(f"`{f.name}`") for f in fields]).schema.add("text", T.StringType()).add("n_chars", T.LongType())
    return rows.mapInArrow(judge, schema)
