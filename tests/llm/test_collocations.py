"""Op 13 against counts in plain Python, and the double array against a set."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from wearline.llm import collocations as C


def brute(rows, min_count=10, max_words=3, top=2000, percent=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, *words[i:i + k]) for i in range(len(words) - k + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    dropped = set()
    for p, a in cands.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                sub = (p[0], *p[i:i + k])
                if 100 * a >= percent * cands[sub]:
                    dropped.add(sub)
    out = []
    for lang in n:
        rows = []
        for p, a in cands.items():
            if p[0] == lang and p not in dropped:
                score, _, left, right = min((10**6 * a * a // (f[p[:k + 1]] * f[(lang, *p[k + 1:])]), k, f[p[:k + 1]], f[(lang, *p[k + 1:])])
                                            for k in range(1, len(p) - 1))
                rows.append((" ".join(p[1:]), a, left, right, n[lang], score))
        rows.sort(key=lambda r: (-r[-1], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert set(dict(df.dtypes).values()) == {"string", "bigint"}
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n, vocab=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab - 6)] + ["É", "ß日", "\x00", "a\xa0b", "x\x1fy", "-"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice([w, w.upper()]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "; "])
                       for w in rng.choices(words, [1 / (i + 1) for i in range(vocab)], k=rng.randrange(50)))
        if rng.random() < 0.3:
            text += " New york CITY hall"
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, n int, phrase string")


@pytest.mark.parametrize("how", [{}, {"block": 200, "shard_size": 15, "bits": 8}, {"max_words": 4, "shard_size": 40}])
def test_equals_plain_python(spark, how):
    rows = corpus(len(how), 250) + [(None, "en"), ("", "de"), (" . , ", "fr"), ("solo", "fr"), ("same same same", "es"), ("same same same", "es")] * 6
    rows += [("long tail " * 5_000, "en")]
    words = how.get("max_words", 3)
    want = brute(rows, max_words=words)
    assert len({r[0] for r in want}) >= 4
    assert got(C.collocations(frame(spark, rows).repartition(3), **how)) == want


def test_ties_and_top(spark):
    rows = [("a b. c d. e f g. b a", "en")] * 10 + [("h i", "en")] * 20
    df = frame(spark, rows)
    assert got(C.collocations(df, top=4)) == brute(rows, top=4)
    assert got(C.collocations(df, min_count=11)) == brute(rows, min_count=11)


def test_empty_table(spark):
    assert got(C.collocations(frame(spark, []))) == []
    assert got(C.collocations(frame(spark, [("rare words only", "en")]))) == []


def test_long_texts_go_in_slices(monkeypatch):
    monkeypatch.setattr(C, "_SLICE", 10)
    block = C._Open()
    text = b"Aa bb. cc  dddddddddddddddd\tee!ff " * 5
    block.add(text)
    names = {n: w for w, n in block.numbers.items()}
    words = [names[i] for i in np.concatenate(block.parts).tolist()]
    assert [w for w in words if w != b"\n"] == re.findall(rb"[^ \t.!]+", text.lower())


@pytest.mark.parametrize("n, width, values", [(1, 3, 256), (3_000, 3, 256), (4_000, 6, 4), (20_000, 6, 256)])
def test_double_array(n, width, values):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, values, (n, width)).astype(np.uint8), axis=0)
    base, check = C.double_array(keys)

    def walk(row):
        state = 0
        for b in row.tolist():
            to = base[state] + b
            if check[to] != state:
                return None
            state = to
        return -1 - base[state]

    assert [walk(r) for r in keys] == list(range(len(keys)))
    held = {r.tobytes() for r in keys}
    for r in rng.integers(0, values, (3_000, width)).astype(np.uint8):
        assert (walk(r) is not None) == (r.tobytes() in held)


class Held:
    """A broadcast's value."""

    def __init__(self, value):
        self.value = value


def test_hashes_are_summed_over_the_blocks_of_a_task():
    rng, blocks = np.random.default_rng(4), []
    for _ in range(12):  # blocks that share most pairs
        texts = [" ".join(f"w{i}" for i in rng.integers(0, 30, 200)) + "." for _ in range(20)]
        rows = pa.RecordBatch.from_arrays([pa.array(["en"] * 20), pa.array(texts, pa.binary())], ["lang", "text"])
        blocks += [b.select(["lang", "ids", "ends", "words"]) for b in C._to_blocks(10**6)(iter([rows]))]
    every = Held(np.full(1 << 5, 255, np.uint8))  # all words are frequent
    out = list(C._hash_counts(2, every, 8, 8, 10)(iter(blocks)))
    rows = pa.Table.from_batches(out)
    assert sum(len(x.as_buffer()) for x in rows.column("low")) // 4 == sum(len(x.as_buffer()) for x in rows.column("n")) <= 900  # pairs of 30 words
    codes = {}
    for bucket, low, n in zip(*(rows.column(c).to_pylist() for c in ("bucket", "low", "n")), strict=True):
        for c, m in zip(np.frombuffer(low, "<u4").tolist(), n, strict=True):
            codes[bucket << 32 | c] = codes.get(bucket << 32 | c, 0) + m
    whole = Counter()
    for lang, ids, words in C._rows(iter(blocks)):
        whole.update(C._codes(C._hopeful(lang, ids, words, 2, every.value, 8)[1], 8).tolist())
    assert codes == {c: min(n, 10) for c, n in whole.items()}


def test_a_trie_counts_only_its_own_shards_phrases_and_looks_up_few_words():
    texts = ["a b a b c " * 30 + " ".join(f"u{i}" for i in range(500))]
    rows = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(texts, pa.binary())], ["lang", "text"])
    blocks = [b.select(["lang", "ids", "ends", "words"]) for b in C._to_blocks(10**6)(iter([rows]))]
    lang, ids, words = next(C._rows(iter(blocks)))
    every = Held(np.full(1 << 5, 255, np.uint8))
    named = pa.Table.from_batches(list(C._named(2, every, every, 8, 8)(iter(blocks))))
    true, got = Counter(zip(texts[0].split(), texts[0].split()[1:])), Counter()
    assert sorted(named.column("phrase").to_pylist()) == sorted(map(" ".join, true))
    for shard in range(3):
        own = named.filter(pa.array(named.column("h").to_numpy() % 3 == shard))
        trie = C._build(2)((pa.scalar(shard),), own)
        top = trie.filter(pc.is_valid(trie["base"]))
        value = (top["base"][0].as_py(), top["check"][0].as_py(), {"en": 1}, {"en": pa.array(top["words"][0].as_py()[0], pa.binary())})
        for b in C._count(2, Held(value), shard, 3, every, 8, 8)(iter(blocks)):
            phrases = trie["phrase"].to_pylist()
            got.update({tuple(phrases[i].split()): n for i, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)})
    assert got == true


def blocks_of(texts):
    """One block a text."""
    out = []
    for text in texts:
        rows = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text], pa.binary())], ["lang", "text"])
        out += [b.select(["lang", "ids", "ends", "words"]) for b in C._to_blocks(10**6)(iter([rows]))]
    return out


def test_a_phrase_is_named_by_the_blocks_that_its_hash_was_given():
    rng = np.random.default_rng(6)
    blocks = blocks_of(" ".join(f"w{i}" for i in rng.integers(0, 20, 4_000)) for _ in range(16))  # all hold the 400 pairs
    every = Held(np.full(1 << 5, 255, np.uint8))
    sums = pa.concat_tables([pa.Table.from_batches(list(C._hash_counts(2, every, 8, 8, 10)(iter([b])))) for b in blocks])
    kept = [C._kept(10)((x,), sums.filter(pc.equal(sums["bucket"], x))) for x in pc.unique(sums["bucket"])]
    hashes = pa.concat_tables(kept)
    bits, holders = 20, np.zeros(1 << 17, np.uint8)
    for b in hashes.to_batches():
        for at in next(C._holder_places(bits)(iter([b]))).column(0).to_pylist():
            holders[at >> 3] |= 1 << (at & 7)
    full = Held(np.full(1 << 17, 255, np.uint8))
    named = [pa.Table.from_batches(list(C._named(2, full, full, bits, 8, Held(holders))(iter([b])))) for b in blocks]
    phrases = [p for t in named for p in t.column("phrase").to_pylist()]
    assert len(hashes) == len(set(phrases)) == 400
    assert len(phrases) <= 420  # 6,400 if each block names what it holds
    assert max(map(len, named)) < 100  # dealt over the blocks


def test_a_phrase_that_shares_a_hash_with_the_named_one_is_counted(monkeypatch):
    blocks = blocks_of(["a b " * 20 + ". " + "c d " * 30])
    every = Held(np.full(1 << 5, 255, np.uint8))
    monkeypatch.setattr(C, "_codes", lambda h, first: np.zeros(len(h), np.int64))  # one hash for all
    named = pa.table({"lang": ["en", "en"], "phrase": ["a b", "b a"], "h": pa.array([0, 0], pa.int64())})
    trie = C._build(2)((pa.scalar(0),), named)
    top = trie.filter(pc.is_valid(trie["base"]))
    value = (top["base"][0].as_py(), top["check"][0].as_py(), {"en": 1}, {"en": pa.array(top["words"][0].as_py()[0], pa.binary())}, top["codes"][0].as_py())
    out = pa.Table.from_batches(list(C._count(2, Held(value), 0, 1, every, 8, 8)(iter(blocks)))).to_pylist()
    phrases = trie["phrase"].to_pylist()
    assert {(phrases[r["idx"]] if r["stray"] is None else r["stray"]["phrase"]): r["n"] for r in out} == {"a b": 20, "b a": 19, "c d": 30, "d c": 29}
