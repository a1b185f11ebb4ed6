"""Op 10 against the tokenizer library itself."""

import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wearline.llm import queries
from wearline.llm.token_counts import token_counts

FILE = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows, file=FILE):
    t = Tokenizer.from_file(file)
    return sorted(((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in df.collect()), key=str)


def test_query_equals_library(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    df = queries.REGISTRY["op10_token_counts"](spark, sf_small)
    assert df.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert got(df) == brute(rows)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in df.collect())


def test_defined_cases(spark):
    texts = [None, "", " ", "\n\n  x  \t y", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext| >", "é😀 　x\x85y\x1fz",
             "it's we'LL 'S 12345 ٣ !!?? ", "zq" * 40_000, "ab " * 70_000, "qzx " * 70_000, "\x00\x01", "  \n x", "a\r\n\r\nb"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "dup", "y", 2), (3, "dup", "y", 2), (None, "no id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string, n_bytes long").repartition(3)
    assert got(token_counts(df, FILE)) == brute([(r[0], r[1]) for r in rows])
    assert token_counts(df.limit(0), FILE).count() == 0


TEXTS = ["", None, "It's we'LL 'S 12345 ٣ !!?? ", "Cafe\u0301 CAFÉ  \n\t x", "é😀 　x\x85y\x1fz İstanbul", "zq" * 4_000, "ab " * 7_000, "a<|endoftext|> b",
         "A<|ENDOFTEXT|>b", "<|startoftext|>x <|endoftext|>  y", "Hello, World! hello, world!", "\x00\x01 \ufeff", "日本語 テキスト 한국어"]


def other_files(tmp_path):
    """The second public file, and the first one with settings that change its pre-tokens."""
    yield public_tokenizers.path("word_bpe_49k.json")
    with open(FILE, encoding="utf-8") as f:
        made = json.load(f)
    changes = {"prefix": {"pre_tokenizer": made["pre_tokenizer"] | {"add_prefix_space": True}}, "lower": {"normalizer": {"type": "Lowercase"}},
               "strip": {"added_tokens": [t | {"lstrip": True, "rstrip": True} for t in made["added_tokens"]]},
               "cut": {"truncation": {"direction": "Right", "max_length": 5, "strategy": "LongestFirst", "stride": 0}}}
    for name, change in changes.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(made | change), encoding="utf-8")
        yield str(path)


def test_other_kinds_of_files(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for file in other_files(tmp_path):
        t = Tokenizer.from_file(file)
        t.no_truncation()
        want = sorted(((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows), key=str)
        assert got(token_counts(df, file)) == want, file


def test_dropout_is_refused(spark, tmp_path):
    with open(FILE, encoding="utf-8") as f:
        made = json.load(f)
    made["model"]["dropout"] = 0.1
    (tmp_path / "dropout.json").write_text(json.dumps(made), encoding="utf-8")
    with pytest.raises(ValueError, match="dropout"):
        token_counts(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "dropout.json"))
