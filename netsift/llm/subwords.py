"""SentencePiece encoding and decoding, with a max-plus scan for giant documents.

A document of at most ``CHUNK`` characters is encoded in one go. A longer one is
cut at fixed places, also inside words, and its chunks are worked on by
different tasks:

1. The state at a cut is the piece that holds the character before it. Each
   chunk yields its transfer matrix: 0 where the path from an entry state to an
   exit state exists, minus infinity where not.
2. The matrices of a document are combined in max-plus algebra, forwards and
   backwards, which leaves one state per cut.
3. With both states known, each chunk is backtraced on its own.

The vocabularies at hand are merge vocabularies (BPE), where the best path is no
sum of scores: a sequence of pieces is the encoding exactly when every two
neighbours are what their joined text is encoded to, and there is only one such
sequence. So the weight of a step is 0 for such neighbours and minus infinity
otherwise; the result equals the library's encoding of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.links import small_batches
from netsift.llm.text import pieces

CHUNK = 1 << 16
NEVER = np.float32(-np.inf)
IDS = "doc_id bigint, text string, ids array<int>"
#: A state at a cut: where the piece begins and ends, counted from the cut.
State = tuple[int, int]


@lru_cache(maxsize=2)
def model(path: str) -> Subwords:
    return Subwords(path)


class Subwords:
    """A merge vocabulary: the library's processor and the tables for the scan."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
        self.longest = max(map(len, self.ids))
        table = {i: bytes([b]) for b, i in self.bytes_.items()}
        table |= {i: p.replace("▁", " ").encode() for p, i in self.ids.items()}
        #: Bytes by id; the last, empty entry stands for all other ids.
        self.table = pa.array([table.get(i, b"") for i in range(sp.get_piece_size() + 1)], pa.large_binary())
        self.fits: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    @cached_property
    def begins(self) -> set[str]:
        """Beginnings of all pieces: a text that is not among them is the beginning of none."""
        return {p[:n] for p in self.ids for n in range(1, len(p) + 1)}

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text: the best-scored neighbours are joined, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def piece(self, text: str) -> bool:
        """Whether a text can be a piece: one character, or a vocabulary entry that merging reaches."""
        if len(text) == 1:
            return True
        if text not in self.ids:
            return False
        if text not in self.whole:
            self.whole[text] = self.merge(text) == [text]
        return self.whole[text]

    def follows(self, left: str, right: str) -> bool:
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > 500_000:
                self.fits.clear()
            found = self.fits[key] = self.merge(left + right) == [left, right]
        return found

    def encoded(self, part: str) -> list[int]:
        """Ids of one piece; a character outside the vocabulary becomes its bytes."""
        own = self.ids.get(part)
        return [own] if own is not None else [self.bytes_[b] for b in part.encode()]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Text of each list of ids; the space that encoding puts first is taken off."""
        other = len(self.table) - 1
        flat = ids.flatten()
        known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, other)), False)
        parts = self.table.take(pc.if_else(known, flat, other))
        lists = pa.LargeListArray.from_arrays(pc.subtract(ids.offsets, ids.offsets[0]).cast(pa.int64()), parts)
        raw = pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))
        try:
            text = raw.cast(pa.large_string())
        except pa.ArrowInvalid:
            # Some ids hold bytes of no character.
            text = pa.array([r.decode("utf-8", "replace") for r in raw.to_pylist()], pa.large_string())
        return pc.if_else(pc.starts_with(text, " "), pc.utf8_slice_codeunits(text, 1), text).cast(pa.string())

    def entries(self, context: str, cut: int) -> list[State]:
        """States that the text around a cut allows: pieces over the character before it."""
        if cut == 0:
            return [(0, 0)]
        return [
            (j - cut, i - cut)
            for j in range(max(0, cut - self.longest), cut)
            for i in range(cut, min(len(context), j + self.longest) + 1)
            if self.piece(context[j:i])
        ]

    def forward(self, context: str, cut: int, end: int, entries: list[State]) -> list[dict[int, int]]:
        """For each place: start of a piece that ends there -> bit set of the entries that lead to it."""
        reach: list[dict[int, int]] = [{} for _ in range(len(context) + 1)]
        for bit, (j, i) in enumerate(entries):
            held = reach[cut + i]
            held[cut + j] = held.get(cut + j, 0) | 1 << bit
        for at in range(cut, end):
            held = reach[at]
            if not held:
                continue
            for to in range(at + 1, min(len(context), at + self.longest) + 1):
                right = context[at:to]
                if self.piece(right):
                    bits = 0
                    for j, mask in held.items():
                        if at == 0 or self.follows(context[j:at], right):
                            bits |= mask
                    if bits:
                        reach[to][at] = reach[to].get(at, 0) | bits
                if right not in self.begins:
                    break
        return reach

    def transfer(self, context: str, cut: int, end: int, last: bool) -> tuple[list[State], list[State], np.ndarray]:
        """Entry states, exit states and max-plus matrix of the chunk ``context[cut:end]``."""
        entries = self.entries(context, cut)
        reach = self.forward(context, cut, end, entries)
        exits, columns = [], []
        for i in range(end, len(reach)):
            for j, mask in reach[i].items():
                if j < end and (not last or i == end):
                    exits.append((j - end, i - end))
                    columns.append([0.0 if mask >> b & 1 else NEVER for b in range(len(entries))])
        return entries, exits, np.array(columns, np.float32).reshape(len(exits), len(entries)).T

    def backtrace(self, context: str, cut: int, end: int, entry: State, exit_: State) -> list[int]:
        """Ids of the pieces after ``entry`` up to and with ``exit_``."""
        reach = self.forward(context, cut, end, [entry])
        first = (cut + entry[0], cut + entry[1])
        at = (end + exit_[0], end + exit_[1])
        path = []
        while at != first:
            path.append(context[at[0] : at[1]])
            before = at[0]
            at = next(
                (j, before) for j in reach[before]
                if (j, before) == first or before == 0 or self.follows(context[j:before], path[-1])
            )
        return [i for part in reversed(path) for i in self.encoded(part)]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def states(entries: list[list[State]], exits: list[list[State]], matrices: list[np.ndarray]) -> list[tuple[State, State]]:
    """Entry and exit state of each chunk on the one path through all of them."""
    ahead = [np.zeros((1, 1), np.float32)]
    aligned = []
    for k, m in enumerate(matrices):
        if k:
            # The exits of one chunk are among the entries of the next.
            index = {s: n for n, s in enumerate(entries[k])}
            m = m[[index[s] for s in exits[k - 1]]]
        aligned.append(m)
        ahead.append(product(ahead[-1], m))
    back = np.zeros((len(exits[-1]), 1), np.float32)
    path: list[tuple[State, State]] = []
    for k in reversed(range(len(matrices))):
        leave = int(np.argmax(ahead[k + 1][0] + back[:, 0]))
        back = product(aligned[k], back)
        enter = int(np.argmax(ahead[k][0] + back[:, 0]))
        path.append((exits[k - 1][enter] if k else (0, 0), exits[k][leave]))
    return path[::-1]


def encode(
    docs: DataFrame, path: str, chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Ids of every row: doc_id, text, ids.

    ``path`` is the model file, readable by all workers. Null texts are empty
    and give no ids. Repeated rows keep a row each, a null id stays null, other
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        docs[id_column].cast("bigint").alias("doc_id"), F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text")
    )

    def short(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = model(path).processor
        for batch in pieces(batches):
            ids = sp.encode(batch.column("text").to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "text", "ids"]
            )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for doc, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                whole = m.processor.normalize(text)
                ends = [*range(chunk, len(whole), chunk), len(whole)]
                for number, end in enumerate(ends):
                    start = ends[number - 1] if number else 0
                    left = max(0, start - m.longest)
                    context = whole[left : end + m.longest]
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": doc, "key": key, "chunk": number, "context": context, "cut": start - left,
                          "end": end - left, "last": end == len(whole)}],
                        pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("chunk", pa.int32()), ("context", pa.string()),
                                   ("cut", pa.int32()), ("end", pa.int32()), ("last", pa.bool_())]),
                    )

    def transfers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for row in batch.to_pylist():
                entries, exits, matrix = m.transfer(row["context"], row["cut"], row["end"], row["last"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_id"]], pa.int64()), pa.array([row["key"]], pa.int64()),
                     pa.array([row["chunk"]], pa.int32()),
                     *(pa.array([np.array(s, np.int32).tobytes()], pa.binary()) for s in (entries, exits)),
                     pa.array([matrix.tobytes()], pa.binary())],
                    ["doc_id", "key", "chunk", "entries", "exits", "matrix"],
                )

    def scan(table: pa.Table) -> pa.Table:
        # A text is at most 2 GB, so a document has a bounded number of matrices of at most a few hundred states.
        table = table.sort_by("chunk")
        entries, exits = (
            [[tuple(s) for s in np.frombuffer(b, np.int32).reshape(-1, 2).tolist()] for b in table.column(c).to_pylist()]
            for c in ("entries", "exits")
        )
        matrices = [
            np.frombuffer(b, np.float32).reshape(len(e), len(x))
            for b, e, x in zip(table.column("matrix").to_pylist(), entries, exits)
        ]
        path_ = [[*enter, *leave] for enter, leave in states(entries, exits, matrices)]
        return table.select(["doc_id", "key", "chunk"]).append_column("path", pa.array(path_, pa.list_(pa.int32())))

    def backtraced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            ids = []
            for row in batch.to_pylist():
                enter, leave = tuple(row["path"][:2]), tuple(row["path"][2:])
                ids.append(m.backtrace(row["context"], row["cut"], row["end"], enter, leave))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), batch.column("chunk"), pa.array(ids, pa.list_(pa.int32()))],
                ["doc_id", "key", "chunk", "ids"],
            )

    small = rows.filter(F.length("text") <= chunk).mapInArrow(short, IDS)
    # Equal giant rows are encoded once; two hashes keep texts of one id apart.
    giants = rows.filter(F.length("text") > chunk).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    giants = giants.withColumn("key", F.xxhash64("doc_id", "text"))
    parts = "doc_id bigint, key bigint, chunk int, context string, cut int, end int, last boolean"
    # A given number of partitions is kept: chunks are few bytes but much work, and must not be put together by size.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = giants.select("doc_id", "key", "text").mapInArrow(cut, parts).repartition(tasks, "key", "chunk")
    matrices = chunks.mapInArrow(
        transfers, "doc_id bigint, key bigint, chunk int, entries binary, exits binary, matrix binary"
    )
    paths = matrices.groupBy("key").applyInArrow(scan, "doc_id bigint, key bigint, chunk int, path array<int>")
    found = chunks.join(paths.select("key", "chunk", "path"), ["key", "chunk"])
    coded = found.mapInArrow(backtraced, "doc_id bigint, key bigint, chunk int, ids array<int>")
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda c: c["ids"]))
    large = giants.join(coded.groupBy("key").agg(joined.alias("ids")), "key").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )
    return small.unionByName(large.select("doc_id", "text", "ids"))


def decode(coded: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """``coded`` with the column ``decoded``, the text of the ids; null ids are empty, unknown ones give nothing."""
    others = [c for c in coded.columns if c != "decoded"]
    rest = F.struct(*[coded[c].alias(f"c{i}") for i, c in enumerate(others)])
    rows = coded.select(F.coalesce(coded[ids_column], F.array().cast("array<int>")).alias("ids"), rest.alias("rest"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                yield pa.RecordBatch.from_arrays([batch.column("rest"), m.decode(batch.column("ids"))], ["rest", "decoded"])

    done = rows.mapInArrow(run, rows.select("rest").schema.add("decoded", "string"))
    return done.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(others)], "decoded")
