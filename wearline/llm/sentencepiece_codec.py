"""SentencePiece encoding and decoding by a max-plus parallel scan.

The model file holds a BPE model with byte fallback. Its encoding of a text is the one path
through the lattice of pieces on which every two neighbours are compatible: merging the
characters of the two by the model's scores gives just these two pieces back. So an edge weighs
0 where neighbours are compatible and minus infinity elsewhere, and the encoding is the
path of weight 0 (the library's result, exactly; no scores are approximated).

1. Giant documents are split into chunks of about ``CHUNK`` characters, anywhere. The state at a
   boundary is the piece that covers it or ends there.
2. A chunk's transfer matrix lists the pairs (entry state, exit state) with a path of weight 0
   between them. Boundaries that no piece can cross (before a space mark that follows
   another character; around characters outside the vocabulary) make it a product of
   two short edge parts, so most of a chunk needn't be walked for it.
3. The matrices of a document are combined from both ends; the product is associative,
   and the one state that both sides reach is the state of the whole path at each boundary.
4. Each chunk is backtraced between its two states, independently of all others.
Shorter documents are one chunk with free ends. Within a chunk, stretches between
uncrossable boundaries are solved once and remembered (bounded memory).

Decoding joins the pieces' bytes, turns space marks into spaces and drops the first one.

Defined cases: null and empty text: no pieces, decoded as empty; the space mark itself decodes
to a space; repeated rows and null ids are kept row by row; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, python_ready, written

CHUNK = 32_768
REMEMBERED = 800_000
SPACE = "▁"
FREE = (0, 0)
NEVER = float("-inf")
_MADE: dict[int, Codec] = {}

State = tuple[int, int]  # how far a piece reaches beyond a boundary, and its length; FREE where pieces can't cross


class Codec:
    """Pieces, compatibility of neighbours, and paths through the lattice of a stretch."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.raw: list[bytes] = []
        self.byte = [0] * 256
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.score[piece], self.id[piece] = sp.get_score(i), i
                self.raw.append(piece.encode())
        self.longest = max(map(len, self.id), default=1)
        # a piece that its own merges don't reach never stands in an encoding
        self.id = {p: i for p, i in self.id.items() if len(p) == 1 or len(self.merged(list(p))) == 1}
        self.begins = {p[:n] for p in self.id for n in range(1, len(p) + 1)}
        self.prefix = SPACE if sp.encode("a", out_type=str)[0].startswith(SPACE) else ""
        self.spaced = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id)  # a space mark only starts pieces
        apart = "".join(c for c in "\n\t\r" if not any(c in p for p in self.id))
        hard = re.escape(apart)
        self.apart = set(apart)
        self.stretch = re.compile(f"{SPACE}+[^{SPACE}{hard}]*|[^{SPACE}{hard}]+" + (f"|[{hard}]" if hard else "")) if self.spaced else None
        self.fits: dict[str, dict[str, bool]] = {}
        self.n_fits = 0
        self.known: dict[str, bytes] = {}

    @classmethod
    def made(cls, model: bytes) -> Codec:
        """One per Python worker and model."""
        key = zlib.crc32(model)
        if key not in _MADE:
            _MADE[key] = cls(model)
        return _MADE[key]

    def merged(self, parts: list[str], seam: int = -1) -> list[str]:
        """Merge neighbours by score, the best first, the leftmost among equals.

        Ends with an empty list as soon as a merge would cross the ``seam`` (after that many parts).
        """
        score = self.score
        best = [score.get(a + b, NEVER) for a, b in pairwise(parts)]
        while best:
            top = max(best)
            if top == NEVER:
                break
            at = best.index(top)
            if at == seam - 1:
                return []
            seam -= at < seam
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del best[at]
            if at < len(best):
                best[at] = score.get(parts[at] + parts[at + 1], NEVER)
            if at:
                best[at - 1] = score.get(parts[at - 1] + parts[at], NEVER)
        return parts

    def piece(self, s: str) -> bool:
        """Whether ``s`` can stand as one piece: a piece of the vocabulary, or one character outside it."""
        return s in self.id or len(s) == 1

    def fit(self, a: str, b: str) -> bool:
        """Whether merging the characters of both gives just the two pieces (remembered)."""
        row = self.fits.get(a)
        f = None if row is None else row.get(b)
        if f is None:
            f = self.merged([*a, *b], len(a)) == [a, b]
            if self.n_fits > REMEMBERED:
                self.fits.clear()
                self.n_fits = 0
            self.fits.setdefault(a, {})[b] = f
            self.n_fits += 1
        return f

    def cut(self, text: str, p: int) -> bool:
        """Whether no piece can cross position p."""
        if p <= 0 or p >= len(text):
            return True
        a, b = text[p - 1], text[p]
        return (self.spaced and b == SPACE != a) or a in self.apart or b in self.apart

    def solve(self, s: str) -> list[str]:
        """Pieces of a stretch with free ends: per place, the one piece that ends the path to it."""
        n, ids, begins, fits, unknown = len(s), self.id, self.begins, self.fits, {}
        back = [""] * (n + 1)
        for j in range(n):
            before = back[j]
            if j and not before:
                continue  # no path comes here
            fit = fits.get(before, unknown)
            i = j + 1
            t = s[j]
            while True:
                if not back[i] and (t in ids or i == j + 1):
                    f = fit.get(t) if j else True
                    if self.fit(before, t) if f is None else f:
                        back[i] = t
                if i == n:
                    break
                i += 1
                t = s[j:i]
                if t not in begins:
                    break
        out, i = [], n
        while i:
            if not back[i]:
                return self.merged(list(s))  # no single compatible prefix path: merge outright
            out.append(back[i])
            i -= len(back[i])
        return out[::-1]

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.id.get(p)
            if i is None:
                out += [self.byte[b] for b in p.encode("utf-8")]
            else:
                out.append(i)
        return out

    def encode(self, s: str) -> bytearray:
        """Ids (32 bits each) of a text with free ends; ``s`` is normalised."""
        out, known = bytearray(), self.known
        for part in self.stretch.findall(s) if self.stretch else [s]:
            got = known.get(part)
            if got is None:
                got = self.packed(self.solve(part))
                if len(part) <= 64:
                    if len(known) > REMEMBERED:
                        known.clear()
                    known[part] = got
            out += got
        return out

    def packed(self, pieces: list[str]) -> bytes:
        return array("i", self.ids(pieces)).tobytes()

    def states(self, text: str, p: int) -> list[State]:
        """Pieces that cover position p or end there."""
        if self.cut(text, p):
            return [FREE]
        out = []
        for s in range(max(0, p - self.longest), p):
            if any(self.cut(text, q) for q in range(s + 1, p + 1)):
                continue
            for e in range(p, min(len(text), s + self.longest) + 1):
                if e - 1 > p and self.cut(text, e - 1):
                    break
                if self.piece(text[s:e]):
                    out.append((e - p, e - s))
        return out

    def walk(self, text: str, start: int, entries: list[State], stop: int, free_stop: bool):
        """Paths from the entry states at ``start`` to ``stop``.

        Returns nodes {(end, length): entries that reach it, as bits} and their order; pieces that begin
        before ``stop`` may reach beyond it unless ``free_stop``.
        """
        at: dict[int, dict[int, int]] = {}
        for k, (over, size) in enumerate(entries):
            held = at.setdefault(start + over, {})
            held[size] = held.get(size, 0) | (1 << k)
        far = stop if free_stop else min(len(text), stop + self.longest)
        for j in range(start, stop):
            if j not in at:
                continue
            for i in range(j + 1, min(far, j + self.longest) + 1):
                if i > j + 1 and self.cut(text, i - 1):
                    break
                t = text[j:i]
                if not self.piece(t):
                    continue
                bits = 0
                for size, mask in at[j].items():
                    if size == 0 or self.cut(text, j) or self.fit(text[j - size:j], t):
                        bits |= mask
                if bits:
                    held = at.setdefault(i, {})
                    held[i - j] = held.get(i - j, 0) | bits
        return at

    def exits(self, text: str, at: dict[int, dict[int, int]], stop: int) -> dict[State, int]:
        """Exit states at ``stop`` and the entries that reach them."""
        if self.cut(text, stop):
            bits = 0
            for mask in at.get(stop, {}).values():
                bits |= mask
            return {FREE: bits} if bits else {}
        return {(e - stop, size): mask for e, held in at.items() if e >= stop
                for size, mask in held.items() if size == 0 or e - size < stop}

    def edges(self, text: str, a: int, b: int) -> tuple[int | None, int | None]:
        """The first and last uncrossable positions within [a, b]."""
        first = next((p for p in range(a, b + 1) if self.cut(text, p)), None)
        return first, None if first is None else next(p for p in range(b, a - 1, -1) if self.cut(text, p))

    def transfer(self, text: str, a: int, b: int) -> list[tuple[State, State]]:
        """The pairs of entry and exit states of [a, b) with a path between them."""
        entries = self.states(text, a)
        first, last = self.edges(text, a, b)
        if first is None:
            found = self.exits(text, self.walk(text, a, entries, b, False), b)
            return [(x, y) for y, mask in found.items() for k, x in enumerate(entries) if mask >> k & 1]
        reach = self.exits(text, self.walk(text, a, entries, first, True), first).get(FREE, 0)
        ends = self.exits(text, self.walk(text, last, [FREE], b, False), b)
        return [(x, y) for k, x in enumerate(entries) if reach >> k & 1 for y in ends]

    def path(self, text: str, a: int, x: State, b: int, y: State) -> list[str]:
        """Pieces from entry state x at a to exit state y at b; the piece of y is included."""
        at = self.walk(text, a, [x], b, y == FREE and self.cut(text, b))
        end = b + y[0]
        size = y[1] or next(iter(at[end]))
        out = []
        while end > a + x[0]:
            t = text[end - size:end]
            out.append(t)
            end -= size
            if end == a + x[0]:
                break
            size = next(n for n in at[end] if n == 0 or self.cut(text, end) or self.fit(text[end - n:end], t))
        return out[::-1]

    def between(self, text: str, a: int, x: State, b: int, y: State) -> bytearray:
        """Ids of the pieces that begin after entry state x and up to exit state y."""
        first, last = self.edges(text, a, b)
        if first is None:
            return bytearray(self.packed(self.path(text, a, x, b, y)))
        out = bytearray(self.packed(self.path(text, a, x, first, FREE)) if a + x[0] < first else b"")
        out += self.encode(text[first:last])
        if last < b:
            out += self.packed(self.path(text, last, FREE, b, y))
        return out

    def decode(self, ids: bytes | bytearray) -> str:
        """Text of ids, normalised form (space marks, with the first one)."""
        return b"".join(map(self.raw.__getitem__, memoryview(ids).cast("i"))).decode("utf-8", "replace")

    def normal(self, text: str | None) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def plain(self, normal: str) -> str:
        return (normal[1:] if self.prefix and normal.startswith(SPACE) else normal).replace(SPACE, " ")


_IDS = "doc_id long, ids array<int>, round_trip boolean"


def _lists(parts: list[bytearray]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _whole(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.made(model.value)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                ids, ok = [], []
                for text in part.column(1):
                    s = codec.normal(text.as_py())
                    ids.append(codec.encode(s))
                    ok.append(codec.decode(ids[-1]) == s)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids), pa.array(ok)], ["doc_id", "ids", "round_trip"])

    return run


_CHUNKS = "uid long, doc_id long, no int, context string, a int, b int"


def _split(model, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codec = Codec.made(model.value)
        uid = TaskContext.get().partitionId() << 32
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = codec.normal(text.as_py())
                n = -(-len(s) // chunk)
                ends = [len(s) * k // n for k in range(n + 1)]
                for k in range(n):
                    lo, hi = max(0, ends[k] - codec.longest - 1), min(len(s), ends[k + 1] + codec.longest + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid]), pa.array([doc_id], pa.int64()), pa.array([k], pa.int32()), pa.array([s[lo:hi]]),
                         pa.array([ends[k] - lo], pa.int32()), pa.array([ends[k + 1] - lo], pa.int32())],
                        ["uid", "doc_id", "no", "context", "a", "b"])
                uid += 1

    return run


_PAIRS = "uid long, no int, pairs array<struct<x0:int,x1:int,y0:int,y1:int>>"


def _transfers(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.made(model.value)
        for b in batches:
            pairs = [[{"x0": x[0], "x1": x[1], "y0": y[0], "y1": y[1]} for x, y in codec.transfer(r["context"], r["a"], r["b"])]
                     for r in b.select(["context", "a", "b"]).to_pylist()]
            kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("x0", "x1", "y0", "y1")]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pairs, kind)], ["uid", "no", "pairs"])

    return run


def combine(left: set[tuple[State, State]], right: set[tuple[State, State]]) -> set[tuple[State, State]]:
    """The max-plus product of two transfer matrices (of weights 0 and minus infinity)."""
    by: dict[State, list[State]] = {}
    for y, z in right:
        by.setdefault(y, []).append(z)
    return {(x, z) for x, y in left for z in by.get(y, ())}


def boundary_states(matrices: list[set[tuple[State, State]]]) -> list[State]:
    """The states of the one path through all chunks, from FREE to FREE."""
    forward, backward = [{FREE}], [{FREE}]
    for m in matrices:
        forward.append({z for _, z in combine({(FREE, x) for x in forward[-1]}, m)})
    for m in reversed(matrices):
        backward.append({x for x, _ in combine(m, {(y, FREE) for y in backward[-1]})})
    return [min(f & g) for f, g in zip(forward, reversed(backward), strict=True)]


_STATES = "uid long, no int, x0 int, x1 int, y0 int, y1 int"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for uid, rows in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            rows = sorted(rows.as_py(), key=lambda r: r["no"])
            states = boundary_states([{((p["x0"], p["x1"]), (p["y0"], p["y1"])) for p in r["pairs"]} for r in rows])
            ints = [pa.array([v[i] for v in states], pa.int32()) for i in (0, 1)]
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([uid] * n), pa.array(range(n), pa.int32()), ints[0][:n], ints[1][:n], ints[0][1:], ints[1][1:]],
                ["uid", "no", "x0", "x1", "y0", "y1"])


def _backtrace(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.made(model.value)
        for b in batches:
            ids, ok = [], []
            for r in b.select(["context", "a", "b", "x0", "x1", "y0", "y1"]).to_pylist():
                s, a, e = r["context"], r["a"], r["b"]
                ids.append(codec.between(s, a, (r["x0"], r["x1"]), e, (r["y0"], r["y1"])))
                ok.append(codec.decode(ids[-1]) == s[a + r["x0"]:e + r["y0"]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), _lists(ids), pa.array(ok)], ["uid", "doc_id", "no", "ids", "ok"])

    return run


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Per row of ``docs``: doc_id, ids, and round_trip (the ids decode to the text)."""
    spark = docs.sparkSession
    python_ready(spark)
    with open(model_file, "rb") as f:  # the driver's installation; its content has a fixed size
        model = spark.sparkContext.broadcast(f.read())
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    giant = F.coalesce(F.char_length("text") >= chunk, F.lit(False))
    short = texts.filter(~giant).mapInArrow(_whole(model), _IDS)
    chunks = written(texts.filter(giant).mapInArrow(_split(model, chunk), _CHUNKS), "chunks")
    matrices = chunks.select("uid", "no", "context", "a", "b").mapInArrow(_transfers(model), _PAIRS)
    states = written(matrices.groupBy("uid").agg(F.collect_list(F.struct("no", "pairs")).alias("m"))  # one document's matrices
                     .mapInArrow(_scan, _STATES), "states")
    traced = chunks.join(states, ["uid", "no"]).select("uid", "doc_id", "no", "context", "a", "b", "x0", "x1", "y0", "y1")
    parts = traced.mapInArrow(_backtrace(model), "uid long, doc_id long, no int, ids array<int>, ok boolean")
    whole = parts.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("p"),
                                     F.min("ok").alias("round_trip"))
    return short.unionByName(whole.select("doc_id", F.flatten(F.col("p.ids")).alias("ids"), "round_trip"))


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with doc_id and ids."""
    spark = encoded.sparkSession
    python_ready(spark)
    with open(model_file, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.made(model.value)
        for b in batches:
            texts = [codec.plain(codec.decode(np.asarray(x.values, np.int32).tobytes() if x.is_valid else b"")) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")
