"""Op 2 against counts in plain Python."""

import random
import re

from wearline.llm import queries
from wearline.llm.quality_rules import RULES, STOP_WORDS, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    w = re.findall(WORD, t)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(8)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    m = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
         "n_upper": len(re.findall("[A-Z]", t)), "n_letters": len(re.findall("[A-Za-z]", t)),
         "n_stop_words": sum(x in STOP_WORDS for x in w)}
    failed = []
    for name, measure, op, limit in RULES:
        a, b = (100 * m[measure[0]], limit * m[measure[1]]) if isinstance(measure, tuple) else (m[measure], limit)
        if a < b if op == "<" else a > b:
            failed.append(name)
    return m, failed


def test_equals_plain_python(spark):
    rng = random.Random(2)
    words = ["the", "of", "Ab", "x|y", "###", "LOUD", "é", "😀", "und"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 7, 8, 9, 20, 60]))) for _ in range(120)]
    texts += [" ".join(f"w{i % k}" for i in range(90)) for k in (1, 3, 8, 20, 45, 80, 90)]
    texts += [None, "", " \t\n\x0b", "a\na\n\na\n b", "x" * 30_000, "of the " * 20_000, "one two three four five six seven eight " * 2, "   "]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "dup"), (3, "dup")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as m", "'x' as failed", "2 as n_words").repartition(4)
    got = [(str(r["doc_id"]), {k: r[k] for k in brute("")[0]}, list(r["failed"]), r["kept"]) for r in quality_rules(df).collect()]
    want = [(str(i), *brute(t), not brute(t)[1]) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert quality_rules(df.limit(0)).count() == 0


def test_clean_documents_stay(spark, sf_small):
    out = queries.REGISTRY["op2_quality_rules"](spark, sf_small).join(spark.read.parquet(f"{sf_small}/labels.parquet"), "doc_id")
    assert out.filter("quality = 1 AND NOT kept AND NOT base_failed").count() == 0
    assert out.filter("quality = 0 AND kept").count() <= 0.1 * out.filter("quality = 0").count()
