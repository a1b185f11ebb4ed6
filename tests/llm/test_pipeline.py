"""The pipeline, stage by stage, against brute-force versions."""

import hashlib
import string
from collections import Counter

import public_tokenizers
import sentencepiece
from test_mixing import brute as mix_brute
from test_ngram_join import brute as near_brute

import corpus_pipeline as C
from wearline.session import BATCH_BYTES, PLAN_CONF

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def staged(spark, docs, sf_dir, stage):
    return stage(spark, docs, sf_dir)


def expected(rows):
    """Rows (doc_id, text, source) kept by the first three stages, and the counter of the mix."""
    rows = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    best = {}
    for r in rows:
        t = r[1].translate(LOWER)
        if t not in best or (best[t][0] is None) or (r[0] is not None and r[0] > best[t][0]):
            best[t] = r
    rows = list(best.values())
    part = near_brute([(r[0], r[1]) for r in rows if r[0] is not None])
    rows = [r for r in rows if r[0] is None or part[r[0]][1] == r[0]]
    plan = mix_brute(rows)
    out = Counter()
    for r in rows:
        h = int(hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest()[:15], 16)
        out[r] += plan[r[2]][2][h]
    return rows, +out


def test_stages_and_run_on_documents(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    kept, mixed = expected(rows)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter({(i, tuple(model.encode(t))): n for (i, t, _), n in mixed.items()})
    got = C.run(spark, sf_small)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == want
    assert got.filter("NOT round_trip").count() == 0 and 0 < len(kept) < len(rows)


def test_defined_cases(spark):
    rows = [(1, "the a of and", "en", "s", 12, "x"), (2, "THE a of and", "en", "s", 12, "x"), (3, None, "en", "s", None, "x"),
            (4, "123 !!", "en", None, 1, None), (5, "", None, "s", 0, "x"), (None, "no id here", "en", None, 10, "x"),
            (6, "der die und das", "de", "t", 15, "x"), (6, "der die und das", "de", "t", 15, "x"), (7, "ein Wort " * 4000, "de", "t", 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for stage in (s for _, s in C.STAGES[:-1]):
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    kept, mixed = expected([(r[0], r[1], r[3]) for r in rows])
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in docs.collect()) == mixed
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_letterless_texts_go_without_labels_too(spark):
    import corpus_pipeline

    rows = [(1, "some words", None), (2, "12 34 ...", None), (3, None, None), (4, "", None), (5, "é", None), (None, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.language(spark, df, "")
    assert got.columns == df.columns and sorted((r["doc_id"] for r in got.collect()), key=str) == [1, 5, None]


def test_a_stage_called_alone_has_its_batches_cut_by_bytes(spark):
    docs = spark.createDataFrame([(1, "a text of words", None, "s"), (2, "one more", None, "s")], "doc_id long, text string, lang string, source string")
    try:
        for stage in (C.language, C.near_dedup, C.sentencepiece):
            spark.conf.unset(BATCH_BYTES)  # no entry has set it
            assert stage(spark, docs, "").count() == 2
            assert spark.conf.get(BATCH_BYTES) == PLAN_CONF[BATCH_BYTES]
    finally:
        spark.conf.set(BATCH_BYTES, PLAN_CONF[BATCH_BYTES])
