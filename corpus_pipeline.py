"""A corpus pipeline of five stages, each one of the operators in ``wearline.llm``.

language ID -> exact dedup -> n-gram Jaccard join -> mixing to target weights -> SentencePiece.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of the documents they got (repeats of the mix as repeated rows); the last
returns doc_id, n_pieces, ids and round_trip. Nulls, empty texts, repeated rows and empty tables
follow the operators' docstrings.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import documents, lower_ascii, python_ready, written
from wearline.llm.exact_dedup import exact_dedup
from wearline.llm.language_id import UNKNOWN, identify, train
from wearline.llm.mixing import mixed_rows
from wearline.llm.ngram_join import jaccard_components, without_ids
from wearline.llm.sentencepiece_codec import encode


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows without a language (``und``): null texts, texts without a letter.

    The same rows go with and without labelled rows; the network's class doesn't decide.
    """
    python_ready(spark)
    model = train(docs, "doc_id", "text", "lang")
    if model is None:
        at = docs.columns.index("text")

        def lettered(batches):  # what ``identify`` calls a letter
            for b in batches:
                yield b.filter(pa.array([any(map(str.isalpha, x or "")) for x in b.column(at).to_pylist()], pa.bool_()))

        return docs.mapInArrow(lettered, docs.schema)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    return identify(rows, model).filter(F.col("lang_pred") != UNKNOWN).select("row.*")


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of equal texts: one with the largest id."""
    def key(digest: Column) -> Column:
        return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), digest)

    kept = exact_dedup(docs.select("doc_id", "text")).filter("kept").select(key(F.col("text_sha256")).alias("key")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       key(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)).alias("key"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component: the one with the smallest id; rows without an id stay."""
    parts = jaccard_components(docs.select("doc_id", "text"))
    gone = parts.filter("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return without_ids(docs, gone)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out rows so that each source comes near its target."""
    return mixed_rows(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each row, and whether they decode to its text."""
    import public_tokenizers

    out = encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES = [
    ("language ID", language),
    ("exact dedup", dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", sentencepiece),
]
#: SQL can't express the network, the components or the merges: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
