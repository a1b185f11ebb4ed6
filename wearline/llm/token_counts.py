"""Token counts of a tokenizer file, without materialising ids.

Merges never cross pre-tokens, so a document has the sum of its pre-tokens' counts.

1. A task cuts its texts into pre-tokens, counts them per document and turns a block of
   documents round: one row per distinct pre-token with the (document, frequency) list of
   the block. Pre-tokens that are entries of the vocabulary (a fixed, bounded table) are
   summed on the spot; a pre-token that occurs a million times in a block is still one row.
2. Rows are partitioned and sorted by pre-token: each distinct pre-token is run through the
   merges once, joined to its frequency lists, and gives partial sums per document.
3. Partial sums travel packed, one row per block, and are added up block by block.

Pre-tokens are cut with the tokenizer's published pattern where a text holds only
characters whose classes all Unicode versions share (ASCII and Latin letters), else by
the library's own pre-tokenizer; both give the same pieces.

Special strings inside a text are single tokens, as the library handles them by default.
Files of another kind than plain byte-level BPE (a normaliser, another pre-tokenizer, special strings that
take blanks along) are cut by the library's own normaliser and pre-tokenizer, and their texts with a special
string are counted by the library as a whole. A file with dropout has no definite counts and is refused.
The tokenizer file is a parameter; a task reads it from its own installation, or the
file's content is broadcast (a fixed size).

Defined cases: null and empty text: 0 bytes, 0 tokens; rows that repeat are counted each;
a null id keeps its row; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import documents, python_ready

LIMIT = 512
BLOCK_DOCS = 65_000
BLOCK_CHARS = 16_000_000
FLUSH_KEYS = 2_000_000
#: Fixed value: the pattern of byte-level BPE, as published with the vocabulary files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = re.compile("[\t\n\r\x20-\x7e\u00c0-\u017f]*")
_MADE: dict[int, _Pieces] = {}


def _alphabet() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


def _byte_level(made: dict) -> bool:
    """Whether the published pattern and byte alphabet give the file's pre-tokens."""
    cut = made.get("pre_tokenizer") or {}
    takes_more = any(t.get(k) for t in made.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word"))
    return (cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
            and not made.get("normalizer") and not takes_more)


class _Pieces:
    """Cuts texts into pre-tokens and counts the tokens of a pre-token."""

    def __init__(self, source: str):
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.byte_level = _byte_level(json.loads(source))
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.letters = _alphabet()
        self.cut = regex.compile(PATTERN).findall
        of = {c: b for b, c in enumerate(self.letters)}
        self.single: dict[str, int] = {}  # entries of the vocabulary, each counted when it is first met
        if not self.byte_level:
            self.single = dict.fromkeys(self.tokenizer.get_vocab(with_added_tokens=False), 0)
            return
        for token in self.tokenizer.get_vocab(with_added_tokens=False):
            try:
                self.single[bytes(of[c] for c in token).decode()] = 0
            except (KeyError, UnicodeDecodeError):
                continue  # not a text by itself: never a pre-token

    @classmethod
    def made(cls, source: str) -> _Pieces:
        """One per Python worker and tokenizer."""
        key = zlib.crc32(source.encode())
        if key not in _MADE:
            _MADE[key] = cls(source)
        return _MADE[key]

    def count(self, piece: str) -> int:
        if not self.byte_level:
            return len(self.tokenizer.model.tokenize(piece))
        return len(self.tokenizer.model.tokenize("".join([self.letters[b] for b in piece.encode()])))

    def of(self, text: str) -> tuple[Counter, int]:
        """Pre-tokens that aren't vocabulary entries, and the number of all other tokens."""
        if not self.byte_level:
            return self._of_any(text)
        parts = self.special.split(text) if self.special else [text]
        pieces: list[str] = []
        for part in parts:
            if _PLAIN.fullmatch(part):
                pieces += self.cut(part)
            else:
                pieces += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return self._split(Counter(pieces), len(parts) - 1)

    def _of_any(self, text: str) -> tuple[Counter, int]:
        normaliser, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        shown = normaliser.normalize_str(text) if normaliser else text
        if self.special and (self.special.search(text) or self.special.search(shown)):
            return Counter(), len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        pieces = [p for p, _ in cut.pre_tokenize_str(shown)] if cut else [shown]
        return self._split(Counter(p for p in pieces if p), 0)

    def _split(self, found: Counter, known: int) -> tuple[Counter, int]:
        single = self.single
        for piece in [p for p in found if p in single]:
            if not single[piece]:
                single[piece] = self.count(piece)
            known += single[piece] * found.pop(piece)
        return found, known


class _Numbers(dict):
    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class _Block:
    """Documents of a task, turned round: per pre-token its (document, frequency) list."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.pieces, self.word, self.freq = _Numbers(), array("I"), array("I")
        self.each: list[int] = []
        self.ids: list[int | None] = []
        self.size: list[int] = []
        self.known: list[int] = []

    def add(self, doc_id: int | None, text: str, pre: _Pieces) -> bool:
        found, known = pre.of(text)
        self.word.extend(map(self.pieces.__getitem__, found))
        self.freq.extend(found.values())
        self.each.append(len(found))
        self.ids.append(doc_id)
        self.size.append(len(text.encode()))
        self.known.append(known)
        self.chars += len(text)
        return len(self.ids) >= BLOCK_DOCS or self.chars >= BLOCK_CHARS

    def rows(self) -> Iterator[pa.RecordBatch]:
        doc = np.repeat(np.arange(len(self.each), dtype=np.uint16), self.each)
        w, f = np.frombuffer(self.word, np.uint32), np.frombuffer(self.freq, np.uint32)
        while len(f) and f.max() > 65_535:  # lists hold 16-bit frequencies: larger ones go in several entries
            big = f > 65_535
            w, doc = np.append(w, w[big]), np.append(doc, doc[big])
            f = np.append(np.where(big, np.uint32(65_535), f), f[big] - np.uint32(65_535))
        order = np.argsort(w, kind="stable")
        lists = pa.py_buffer(np.column_stack([doc[order], f[order].astype(np.uint16)]).astype("<u2").tobytes())
        at = np.searchsorted(w[order], np.arange(len(self.pieces) + 1)).astype(np.int32) * 4
        names = list(self.pieces)
        for lo in range(0, len(names), 50_000):
            hi = min(lo + 50_000, len(names))
            data = pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(at[lo:hi + 1]), lists])
            yield self._batch(names[lo:hi], False, data)
        docs = np.array([[x is None, x or 0, n, k] for x, n, k in zip(self.ids, self.size, self.known, strict=True)], "<i8")
        yield self._batch([str(self.number)], True, pa.array([docs.tobytes()], pa.binary()))

    def _batch(self, names: list[str], is_docs: bool, data: pa.Array) -> pa.RecordBatch:
        n = len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.full(n, is_docs)), pa.array(np.full(n, self.number, np.int64)), data],
            ["piece", "is_docs", "block", "packed"])


def _turn(source):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pre, block = _Pieces.made(source.value), _Block(TaskContext.get().partitionId() << 24)
        for b in batches:
            for x, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if block.add(x, text.as_py() or "", pre):
                    yield from block.rows()
                    block = _Block(block.number + 1)
        if block.ids:
            yield from block.rows()

    return run


def _merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    block, doc, n = (np.concatenate([h[i] for h in held]) for i in range(3))
    order = np.lexsort((doc, block))
    block, doc, n = block[order], doc[order], n[order]
    new = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (doc[1:] != doc[:-1])))
    return block[new], doc[new], np.add.reduceat(n, new)


def _packed(block: np.ndarray, doc: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row per block: its documents' partial sums as (document, sum) pairs."""
    cut = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block))
    pairs = np.column_stack([doc, n]).astype("<i8")
    data = [pairs[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[cut[:-1]]), pa.array(np.full(len(data), False)), pa.array(data, pa.binary())], ["block", "is_docs", "packed"])


def _sums(source):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = _Pieces.made(source.value)
        last, count = None, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_held = 0
        for b in batches:
            docs = b.filter(b.column(1))
            if docs.num_rows:
                yield pa.RecordBatch.from_arrays([docs.column(2), docs.column(1), docs.column(3)], ["block", "is_docs", "packed"])
            b = b.filter(pc.invert(b.column(1)))
            if not b.num_rows:
                continue
            piece, packed = b.column(0), b.column(3)
            new = np.append(True, np.asarray(pc.not_equal(piece.slice(1), piece.slice(0, len(piece) - 1))))
            firsts = np.flatnonzero(new)
            names = piece.take(pa.array(firsts)).to_pylist()
            counts = [count if i == 0 and name == last else pre.count(name) for i, name in enumerate(names)]
            last, count = names[-1], counts[-1]
            at = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
            lists = np.frombuffer(packed.buffers()[2], "<u2", (at[-1] - at[0]) // 2, at[0]).reshape(-1, 2)
            each = np.diff(at) // 4
            per_row = np.repeat(np.array(counts, np.int64), np.diff(np.append(firsts, len(piece))))
            held.append((np.repeat(b.column(2).to_numpy(), each), lists[:, 0].astype(np.int64),
                         lists[:, 1].astype(np.int64) * np.repeat(per_row, each)))
            n_held += len(lists)
            if n_held > FLUSH_KEYS:
                held = [_merged(held)]
                n_held = len(held[0][0])
                if n_held > FLUSH_KEYS // 2:
                    yield _packed(*held[0])
                    held, n_held = [], 0
        if held:
            yield _packed(*_merged(held))

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: the sums of a block's documents, once the block is complete."""
    block, sums, docs = None, np.zeros(BLOCK_DOCS, np.int64), None

    def out() -> pa.RecordBatch:
        n = len(docs)
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[:, 1].copy(), mask=docs[:, 0] == 1), pa.array(docs[:, 2].copy()), pa.array(docs[:, 3] + sums[:n])],
            ["doc_id", "n_bytes", "n_tokens"])

    for b in batches:
        for number, is_docs, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if number != block:
                if docs is not None:
                    yield out()
                block, docs = number, None
                sums[:] = 0
            if is_docs:
                docs = np.frombuffer(packed.as_py(), "<i8").reshape(-1, 4)
            else:
                part = np.frombuffer(packed.as_py(), "<i8").reshape(-1, 2)
                np.add.at(sums, part[:, 0], part[:, 1])
    if docs is not None:
        yield out()


def token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens."""
    spark = docs.sparkSession
    python_ready(spark)
    with open(tokenizer_file, encoding="utf-8") as f:  # the driver's installation; its content has a fixed size
        content = f.read()
    if json.loads(content)["model"].get("dropout"):
        raise ValueError(f"{tokenizer_file} has dropout, so its counts vary")
    source = spark.sparkContext.broadcast(content)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    turned = texts.mapInArrow(_turn(source), "piece string, is_docs boolean, block long, packed binary")
    sums = turned.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        _sums(source), "block long, is_docs boolean, packed binary")
    return sums.repartition("block").sortWithinPartitions("block").mapInArrow(
        _totals, "doc_id long, n_bytes long, n_tokens long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = token_counts(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
