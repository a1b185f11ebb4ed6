"""Op 11 against the tokenizer library and zlib, and the files' own metadata."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wearline.llm import queries
from wearline.llm import token_store as S
from wearline.llm.common import step_path

FILE = public_tokenizers.path("byte_bpe_50k.json")
SOURCE = open(FILE, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(FILE)


def stream(rows):
    """(doc_id, start, n, crc) in ascending id order (rows of one id: any order), and all ids."""
    out, ids = [], []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, len(ids), len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        ids += own
    return out, ids


def got(df):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=lambda r: r[1])


def test_query_equals_library(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    df = queries.REGISTRY["op11_token_ids"](spark, sf_small)
    assert dict(df.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert got(df) == stream(rows)[0]


ROWS = [(5, "b a"), (3, None), (9, ""), (None, "no id"), (4, "x\ty  z \n\n q"), (7, "<|endoftext|> <|endoftext|>a"), (1, "é😀 　x\x85y\x1fz it's we'LL"),
        (12, "word " * 9_000), (11, "zq" * 6_000), (20, "same"), (21, "same"), (-4, "end\n\nof. Line\nNext 'quoted' 12 34")]


@pytest.mark.parametrize("chunk", [7, 16_384])
def test_defined_cases_and_reads(spark, chunk):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, ids string, at int").repartition(5)
    path = step_path(spark, "store-test")
    S.write_store(df, path, FILE, chunk=chunk)
    want, ids = stream(ROWS)
    assert got(S.checksums(spark, path)) == want
    rows = S.find(spark, path, [12, 20, 77]).collect()
    assert {r["doc_id"] for r in rows} == {12, 20}
    again = [x for r in sorted((r for r in rows if r["doc_id"] == 12), key=lambda r: r["chunk"]) for x in r["ids"]]
    assert again[:-1] == LIBRARY.encode("word " * 9_000, add_special_tokens=False).ids and again[-1] == 0
    for start, stop in [(0, 3), (10, 5_000), (len(ids) - 4, len(ids) + 50), (8, 8)]:
        parts = sorted((r["start"], r["ids"]) for r in S.span(spark, path, start, stop).collect())
        assert [x for _, p in parts for x in p] == ids[start:stop]
        assert not parts or parts[0][0] == start
    files = S.manifest(spark, path).collect()
    assert sum(f["n_tokens"] for f in files) == len(ids) and sum(f["n_docs"] for f in files) == len(ROWS)


def test_repeated_rows_and_empty_table(spark):
    rows = [(3, "one two"), (3, "one two"), (3, "other"), (None, None), (None, None)]
    path = step_path(spark, "store-test")
    S.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, FILE)
    out = got(S.checksums(spark, path))
    assert sorted((str(r[0]), r[2], r[3]) for r in out) == sorted((str(r[0]), r[2], r[3]) for r in stream(rows)[0])
    assert [r[1] for r in out] == list(np.cumsum([0] + [r[2] for r in out])[:-1])
    path = step_path(spark, "store-test")
    S.write_store(spark.createDataFrame([], "doc_id long, text string"), path, FILE)
    assert S.checksums(spark, path).count() == 0 and S.manifest(spark, path).count() == 0 and S.span(spark, path, 0, 9).count() == 0


def test_files_have_stripes_and_bloom_filters(spark):
    df = spark.range(30_000).selectExpr("id * 3 as doc_id", "sha2(cast(id as string), 512) as text").coalesce(1)
    path = step_path(spark, "store-test")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        S.write_store(df, path, FILE, stripe_bytes=200_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    name = [f for f in S.rows_of(spark, path).inputFiles() if f.endswith(".orc")][0]
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    stripes = reader.getStripes()
    assert stripes.size() > 2
    kinds = [str(s.getKind()) for s in reader.rows().readStripeFooter(stripes.get(0)).getStreamsList()]
    assert "ROW_INDEX" in kinds and any("BLOOM_FILTER" in k for k in kinds)
    assert reader.rows().readStripeFooter(stripes.get(0)).getColumns(5).getKind().toString().endswith("_V2")
    plan = S.find(spark, path, [3, 9])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan


def test_other_tokenizers_go_through_the_library():
    other = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Some Words, here", "x", ""]
    encoder = S.Encoder(open(other, encoding="utf-8").read(), 0)
    assert not encoder.by_rank
    ids, sizes = encoder.ids(texts)
    want = [[*Tokenizer.from_file(other).encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))


ENCODER = S.Encoder(SOURCE, 0)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z's'll,.1 \n\té 😀"), max_size=40), max_size=5))
def test_ranks_equal_library(texts):
    assert ENCODER.by_rank
    ids, sizes = ENCODER.ids(texts)
    want = [[*LIBRARY.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
