"""Ops 3 and 8: held-out accuracy, defined cases, folds."""

import zlib

import numpy as np

from wearline.llm import queries
from wearline.llm.language_id import ByteNet, language_id
from wearline.llm.quality_classifier import isotonic, quality_scores


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.REGISTRY["op3_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_defined_cases(spark):
    rows = [(i, ("the house and the garden " if i % 2 else "das Haus und der Garten ") * (1 + i % 40), "en" if i % 2 else "de") for i in range(80)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 !?", None), (103, "DER GARTEN UND DAS HAUS", None), (None, "the garden", "en"),
             (104, "the house " * 30_000, None), (104, "the house " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'x' as lang_pred", "true as held_out")
    got = {}
    for r in language_id(df).collect():
        assert got.setdefault((r["doc_id"]), (r["lang_pred"], r["score"])) == (r["lang_pred"], r["score"])
    assert [got[i][0] for i in (100, 101, 102, 103, 104, None)] == ["und", "und", "und", "de", "en", "en"]
    assert got[100][1] == 0.0 and len(got) == 86
    assert {r["lang_pred"] for r in language_id(df.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
    assert language_id(df.limit(0)).count() == 0


def test_network_gradients():
    net = ByteNet(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 255, (4, 256)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        return -np.log(net.probabilities(x)[np.arange(4), y]).mean()

    g = net.gradients(x, y)
    for k, at in [("u", (3, 1)), ("c", (2,)), ("w3", (5, 2)), ("b2", (1,)), ("e", (int(x[0, 0]), 1))]:
        old = net.p[k][at]
        net.p[k][at] = old + 1e-6
        up = loss()
        net.p[k][at] = old - 1e-6
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2e-6 - g[k][at]) < 1e-4


def test_quality_held_out_ranking(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.REGISTRY["op8_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) for r in out)
    good, bad = [r["score"] for r in held if r["quality"] == 1], [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9


def test_quality_defined_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b " * 100), (3, "a b " * 100), (None, "x"), (5, "w " * 60_000)],
                                 "doc_id long, text string").selectExpr("*", "1 as x", "2 as score", "3 as m")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((str(r["doc_id"]), r["score"], r["predicted"]) for r in quality_scores(docs, none).collect()) == sorted(
        (str(i), 0.5, 1) for i in (1, 2, 3, 3, None, 5))
    learned = next(i for i in (1, 2, 3, 5) if zlib.crc32(str(i).encode()) % 3 != 1)
    one = spark.createDataFrame([(learned, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert {r["score"] for r in quality_scores(docs, one).collect()} == {1.0}
    assert quality_scores(docs.limit(0), none).count() == 0


def test_isotonic_is_monotone_and_pools():
    x, y = isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0, 1, 0, 1, 1]))
    assert np.all(np.diff(y) > 0) and np.allclose(y, [0, 0.5, 1]) and np.allclose(x, [0.1, 0.25, 0.45])


def test_held_out_labels_dont_reach_the_language_model(spark, sf_small):
    from pyspark.sql import functions as F

    from wearline.llm import language_id as LI

    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang").limit(120)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    held = LI.held_out(F.col("doc_id")) if hasattr(LI, "held_out") else F.crc32(F.col("doc_id").cast("string")) % LI.FOLDS == LI.HELD_OUT
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    a, b = (LI.train(d, "doc_id", "text", "lang") for d in (docs, other))
    assert a.languages == b.languages and all((a.p[k] == b.p[k]).all() for k in a.p)
