"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

1. Documents are range-partitioned by id and sorted within each range; a task encodes its range as
   a stream, appends the end id to every document and numbers what it has: a row holds
   at most ``CHUNK`` ids, with the range (``part``), the document's number in it and the
   offset of its first id in it. Part files follow the order of the ranges, so files
   read in name order hold the ids in ascending order of document ids.
2. ORC writes the ids and offsets as run-length encoded integers in stripes, with statistics per stripe
   and row group and a Bloom filter on ``doc_id`` per row group.
3. ``manifest`` has one row per file: its range of document ids, documents, ids, and the ids of all
   files before it. The start of a document is its file's base plus its offset, so stripes
   are read in parallel and in any order.
4. ``find`` and ``span`` read only what the metadata can't rule out: ``find`` by Bloom filters and
   statistics of ``doc_id``, ``span`` by the manifest and the statistics of offsets.

Encoding gives the ids of the tokenizers library. The library itself takes about 950 CPU seconds a GB of the
check tool's input, so texts of ASCII and Latin letters (whose classes all Unicode versions share) are merged
by rank, after a proof on the file that this gives the library's ids (see ``_bytes_by_rank``); all other
texts, those with special strings, and all files without the proof go through the library.

Defined cases: null and empty text: the end id alone; null ids come first; rows of one id are ordered by a hash
of their text, then by the text; repeated rows are documents of their own; an empty table gives
an empty store and result; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import documents, python_ready, step_path

CHUNK = 16_384
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000
STRETCH = 1_000
BATCH_CHARS = 2_000_000
SCHEMA = ("part int, doc_no long, chunk int, n_chunks int, doc_id long, `at` long, n int, ids array<int>")
#: Fixed value: the pattern of byte-level BPE, as published with the vocabulary files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = re.compile("[\t\n\r\x20-\x7e\u00c0-\u017f]*")
_MADE: dict[int, Encoder] = {}


def _alphabet() -> list[str]:
    """The character that stands for each byte: itself where it prints, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


def _bytes_by_rank(library: Tokenizer, made: dict) -> dict[bytes, int] | None:
    """The bytes of each id, if merging by rank gives what the library's merges give.

    That holds where the merges make ids in their order, and every entry of the vocabulary is encoded as itself:
    then two neighbours whose bytes together are an entry are the pair that its merge names.
    """
    cut, model = made.get("pre_tokenizer") or {}, made["model"]
    plain = (model["type"] == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
             and not any(made.get(k) for k in ("normalizer", "truncation", "padding"))
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    if not plain:
        return None
    vocab, of = model["vocab"], {c: b for b, c in enumerate(_alphabet())}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    in_order = [vocab.get(a + b) for a, b in pairs] == list(range(256, 256 + len(pairs)))
    tokens = [t for t in vocab if vocab[t] < 256 + len(pairs)]
    if not in_order or sorted(map(vocab.get, tokens)) != list(range(len(tokens))) or not all(set(t) <= of.keys() for t in tokens):
        return None
    if any([x.id for x in library.model.tokenize(t)] != [vocab[t]] for t in tokens):
        return None
    return {bytes(of[c] for c in t): vocab[t] for t in tokens}


class Encoder:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, plus an end id."""

    def __init__(self, source: str, end_id: int):
        self.library, self.end = Tokenizer.from_str(source), np.array([end_id], np.int32)
        ranks = _bytes_by_rank(self.library, json.loads(source))
        self.by_rank = ranks and tiktoken.Encoding("by rank", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    @classmethod
    def made(cls, source: str, end_id: int) -> Encoder:
        """One per Python worker, tokenizer and end id."""
        key = zlib.crc32(source.encode(), end_id)
        if key not in _MADE:
            _MADE[key] = cls(source, end_id)
        return _MADE[key]

    def _plain(self, text: str) -> bool:
        """ASCII and Latin letters, no special string, no long stretch without a blank (merges of one take long)."""
        return (_PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)
                and all(text.find(" ", i, i + STRETCH) >= 0 or text.find("\n", i, i + STRETCH) >= 0 for i in range(0, len(text) - STRETCH, STRETCH)))

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with its end id, and the number of ids of each text."""
        out = []
        for text in texts:
            if self.by_rank and self._plain(text):
                own = self.by_rank.encode_to_numpy(text, disallowed_special=())
            else:
                own = self.library.encode(text, add_special_tokens=False).ids
            out += [np.asarray(own).astype(np.int32), self.end]
        sizes = np.fromiter(map(len, out), np.int64, len(out)).reshape(-1, 2).sum(axis=1)
        return (np.concatenate(out) if out else np.empty(0, np.int32)), sizes


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str]]]:
    ids, texts, chars = [], [], 0
    for x, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        t = text.as_py() or ""
        ids.append(x)
        texts.append(t)
        chars += len(t)
        if chars > BATCH_CHARS:
            yield ids, texts
            ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _encode(source, end_id: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, doc_no, at = Encoder.made(source.value, end_id), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for ids, texts in _groups(batch):
                flat, sizes = encoder.ids(texts)
                n_chunks = -(-sizes // chunk)
                doc = np.repeat(np.arange(len(ids)), n_chunks)
                no = np.arange(len(doc)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
                n = np.minimum(chunk, sizes[doc] - no * chunk)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), part, np.int32)), pa.array(doc + doc_no), pa.array(no.astype(np.int32)),
                     pa.array(n_chunks[doc].astype(np.int32)), pa.array(ids, pa.int64()).take(pa.array(doc)), pa.array(ends - n + at),
                     pa.array(n.astype(np.int32)), lists],
                    ["part", "doc_no", "chunk", "n_chunks", "doc_id", "at", "n", "ids"])
                doc_no, at = doc_no + len(ids), at + int(ends[-1])

    return run


def write_store(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                chunk: int = CHUNK, stripe_bytes: int = STRIPE_BYTES, index_rows: int = INDEX_ROWS) -> None:
    """Writes ``path``/ids (ORC, ascending document ids) and ``path``/manifest (one row per file of ids)."""
    if not 0 < chunk <= CHUNK:
        raise ValueError(f"chunk must be 1 to {CHUNK}")
    spark = docs.sparkSession
    python_ready(spark)
    with open(tokenizer_file, encoding="utf-8") as f:  # the driver's installation; its content has a fixed size
        source = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    ranges = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    made = ranges.mapInArrow(_encode(source, end_id, chunk), SCHEMA)
    options = {"orc.compress": "ZSTD", "orc.create.index": "true", "orc.row.index.stride": str(max(1_000, index_rows)),
               "orc.stripe.size": str(stripe_bytes), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
    made.write.options(**options).orc(f"{path}/ids")
    files = rows_of(spark, path).groupBy("part").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.max(F.col("doc_no") + 1).alias("n_docs"),
        F.max(F.col("at") + F.col("n")).alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long"))).write.orc(f"{path}/manifest")


def rows_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(f"{path}/ids")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """part, first_id, last_id, n_docs, n_tokens, base: one row per file of ids."""
    return spark.read.schema("part int, first_id long, last_id long, n_docs long, n_tokens long, base long").orc(f"{path}/manifest")


def _started(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``start``: the ids of all files before, plus those before in the file."""
    bases = manifest(rows.sparkSession, path).select("part", "base")
    return rows.join(bases, "part").withColumn("start", F.col("base") + F.col("at")).drop("base")


def find(spark: SparkSession, path: str, doc_ids: Iterable[int]) -> DataFrame:
    """The rows of some documents (doc_id, start, chunk, n_chunks, ids); stripes and row groups without them aren't read."""
    rows = rows_of(spark, path).filter(F.col("doc_id").isin([int(x) for x in doc_ids]))
    return _started(rows, path).select("doc_id", "start", "chunk", "n_chunks", "ids")


def span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """Ids ``start`` (included) to ``stop`` of the whole store as (start, ids) rows; only files and row groups that hold some are read."""
    held = manifest(spark, path).filter((F.col("base") < stop) & (F.col("base") + F.col("n_tokens") > start))
    ends = held.agg(F.min_by(F.struct("part", "base"), "part").alias("a"), F.max_by(F.struct("part", "base"), "part").alias("b")).first()
    rows = rows_of(spark, path)
    if ends["a"] is None or stop <= start:
        rows = rows.filter(F.lit(False))
    else:  # ids of a row lie less than CHUNK behind its offset
        (a, a_base), (b, b_base), part, at = ends["a"], ends["b"], F.col("part"), F.col("at")
        rows = rows.filter(part.between(a, b) & ((part > a) | (at > start - a_base - CHUNK)) & ((part < b) | (at < stop - b_base)))
    rows = _started(rows, path)
    first = F.greatest(F.lit(start) - F.col("start"), F.lit(0)).cast("int")
    last = F.least(F.lit(stop) - F.col("start"), F.col("n").cast("long")).cast("int")
    return rows.filter(last > first).select((F.col("start") + first).alias("start"), F.slice("ids", first + 1, last - first).alias("ids"))


def _bytes(ids: pa.Array) -> Iterator[memoryview]:
    """The little-endian 32-bit ids of each row."""
    flat = np.asarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
    at = np.asarray(ids.offsets)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield memoryview(flat[a:b]).cast("B") if b > a else memoryview(b"")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents from rows sorted by document and chunk: part, doc_id, at, n_tokens, ids_crc32."""
    crc, n, at = 0, 0, 0
    for b in batches:
        out: list[tuple] = []
        for part, chunk, n_chunks, doc_id, here, data in zip(
                *(b.column(c).to_pylist() for c in ("part", "chunk", "n_chunks", "doc_id", "at")), _bytes(b.column(b.schema.get_field_index("ids"))),
                strict=True):
            if chunk == 0:
                crc, n, at = 0, 0, here
            crc, n = zlib.crc32(data, crc), n + len(data) // 4
            if chunk == n_chunks - 1:
                out.append((part, doc_id, at, n, crc))
        names = ["part", "doc_id", "at", "n_tokens", "ids_crc32"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    Documents of one row are read stripe by stripe where they lie; the rows of longer ones, which a stripe's
    end may part, are brought together and go through in order, never whole.
    """
    python_ready(spark)
    kind = "part int, doc_id long, `at` long, n_tokens long, ids_crc32 long"

    def read(which: Column) -> DataFrame:
        return rows_of(spark, path).filter(which).drop("n")

    short = read(F.col("n_chunks") == 1).mapInArrow(_checksums, kind)
    long = read(F.col("n_chunks") > 1).repartition("part", "doc_no").sortWithinPartitions("part", "doc_no", "chunk").mapInArrow(_checksums, kind)
    return _started(short.unionByName(long), path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = step_path(spark, "token-ids")
    write_store(documents(spark, sf_dir, "doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return checksums(spark, path)
