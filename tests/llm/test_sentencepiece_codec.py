"""Op 7 against the SentencePiece library, and round trips."""

import random

import public_tokenizers
import sentencepiece

from wearline.llm import queries
from wearline.llm.sentencepiece_codec import Codec, boundary_states, decode, encode

FILE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)
MODEL = open(FILE, "rb").read()


def test_query_equals_library(spark, sf_small):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = queries.REGISTRY["op7_sentencepiece"](spark, sf_small).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in got} == {i: LIBRARY.encode(t, num_threads=1) for i, t in rows.items()}
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in got)


def ids(packed):
    return list(memoryview(packed).cast("i"))


def texts(seed):
    rng = random.Random(seed)
    alphabet = ["the", "tion", "a", "e", " ", " ", "  ", "\n", "é", "😀", "ing", "ed", "1", "00", "==", "----", "\t", "aaaa", "zq", "▁", "中", "."]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(150)]


def test_chunks_anywhere_equal_whole():
    codec = Codec(MODEL)
    for text in texts(1) + ["a" * 100, "international" * 12, "=" * 90, "\n\n\n", " " * 70]:
        s = codec.normal(text)
        want = LIBRARY.encode(text)
        assert ids(codec.encode(s)) == want, text
        assert codec.decode(codec.encode(s)) == s
        for size in (17, 23, 40):
            ends = [len(s) * k // -(-len(s) // size) for k in range(-(-len(s) // size) + 1)]
            windows = [(max(0, a - 17), a, b, min(len(s), b + 17)) for a, b in zip(ends, ends[1:])]
            states = boundary_states([set(codec.transfer(s[lo:hi], a - lo, b - lo)) for lo, a, b, hi in windows])
            got = [i for k, (lo, a, b, hi) in enumerate(windows)
                   for i in ids(codec.between(s[lo:hi], a - lo, states[k], b - lo, states[k + 1]))]
            assert got == want, (text, size)


def test_defined_cases(spark):
    rows = [(i, t) for i, t in enumerate([*texts(2)[:40], None, "", " ", "▁", "x" * 3000, "ab " * 5000])]
    rows += [(0, "again"), (0, "again"), (None, "no id " * 30), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "'x' as uid").repartition(3)
    out = encode(df, FILE, chunk=50)
    got = sorted(((r["doc_id"], list(r["ids"])) for r in out.collect()), key=str)
    assert got == sorted(((i, LIBRARY.encode(t or "")) for i, t in rows), key=str)
    assert out.filter("NOT round_trip").count() == 0
    back = sorted(((r["doc_id"], r["text"]) for r in decode(out, FILE).collect()), key=str)
    assert back == sorted(((i, (t or "").replace("▁", " ")) for i, t in rows), key=str)
    assert encode(df.limit(0), FILE).count() == 0
