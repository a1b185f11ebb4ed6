"""Op 12 against counts and sums in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from wearline.llm import divergence as D


def brute(rows, min_docs=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []

    def ranked(lang, source, part, values, most=None):
        order = sorted(values.items(), key=lambda kv: (-kv[1], kv[0].encode()))[:most]
        out.extend((lang, source, part, item, value, rank) for rank, (item, value) in enumerate(order, 1))

    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def p(s, lang=lang, kept=kept):
            n = counts[lang, s]
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        own, whole = p(source), p(None)
        ranked(lang, source, "pair", {s: sum((own[t] - q) ** 2 // q for t, q in p(s).items()) for g, s in groups if g == lang and s != source})
        ranked(lang, source, "term", {t: (own[t] - whole[t]) ** 2 // whole[t] for t in kept if counts[lang, source][t] and own[t] > whole[t]}, top)
    return sorted(out)


def got(df):
    assert dict(df.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(seed, n, langs, sources, vocab):
    rng = random.Random(seed)
    words = [w + str(rng.choice(["", "é", "ß", "ñ", "日"])) for w in (f"{chr(97 + i % 26)}{'xyz'[i % 3] * (i // 26 + 1)}" for i in range(vocab))]
    return [(" ".join(rng.choice([w, w.upper(), w + "!", "1" + w]) for w in rng.choices(words, [1 / (i + 1) for i in range(vocab)], k=rng.randrange(60))),
             rng.choice(langs), rng.choice(sources)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, n int, term string, word int")


@pytest.mark.parametrize("sources, words, top", [(32, 256, 200), (2, 1, 5)])
def test_equals_plain_python(spark, monkeypatch, sources, words, top):
    monkeypatch.setattr(D, "SOURCES", sources)
    monkeypatch.setattr(D, "WORDS", words)
    rows = corpus(words, 300, ["en", "de", None], ["a", "a", "a", "b", "é", None, "z"], 150)
    rows += [("", "en", "empty"), (None, "en", "none"), ("only two", "fr", "a"), ("only two", "fr", "b"), (None, "xx", "a"), ("same same", "en", "a")] * 2
    df = frame(spark, rows).repartition(3)
    assert got(D.divergence(df, top=top)) == brute(rows, top=top)


def test_small_dictionaries_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(D, "ENTRIES", 20)
    rows = corpus(3, 60, ["en"], ["a", "b"], 80) + [("long " * 50_000 + "Tail", "en", "b"), ("a" * 100_000, "en", "a")] * 3
    assert got(D.divergence(frame(spark, rows).coalesce(1))) == brute(rows)


def test_empty_table(spark):
    assert got(D.divergence(frame(spark, []))) == []


def test_large_counts_stay_exact():
    import numpy as np

    x = (np.array([0]), np.array([10**9 + 1]), np.array([1], np.uint64), np.int64(1))
    y = (np.array([0]), np.array([1]), np.array([1], np.uint64), np.int64(1))
    assert D._joint(x, y) == (1, 10**18, (10**18) // (10**9 + 1))
