"""Op 1 against all pairs on whole small tables, and its defined cases."""

import random
import re
import string
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pytest

from wearline.llm import queries
from wearline.llm.ngram_join import ANY, FINE_RATIO, _across, _parity, allocate, band_starts, jaccard_components, placed_prefixes, prefixes
from wearline.llm.shingles import blocks, shingle_sets

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """{doc_id: (n_shingles, component_id)} from all pairs of distinct sets."""
    sets = [(i, frozenset(shingles(t))) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    first = {}
    for i, s in sorted(sets, key=lambda x: x[0]):
        if s:
            join(i, first.setdefault(s, i))
    by_size = sorted(first, key=len)
    for a, b in combinations(by_size, 2):
        if len(b) * 4 <= len(a) * 5:
            both = len(a & b)
            if 100 * both >= 80 * (len(a) + len(b) - both):
                join(first[a], first[b])
    return {i: (len(s), root(i)) for i, s in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_equals_all_pairs(spark, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert result(queries.REGISTRY["op1_ngram_jaccard_join"](spark, sf_small)) == brute(rows)


def test_near_copies_of_all_sizes(spark):
    rng, rows = random.Random(3), []
    for base in range(60):
        words = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(rng.choice([3, 6, 9, 14, 30, 80, 300]))]
        for _ in range(6):
            w = words[:]
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = "x" + str(rng.randrange(1000))
            w += [f"t{rng.randrange(9)}"] * rng.randrange(0, 2)
            rows.append((len(rows), " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(len(rows) + i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 90))))
             for i in range(80)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(jaccard_components(df)) == brute(rows)


def test_defined_cases(spark):
    rows = [(1, "A b c", "x", 1), (2, "a B c", "x", 2), (3, None, None, 3), (4, " \n\t", "x", 4), (5, "", "y", 5),
            (6, "a b c d", "x", 6), (None, "a b c", "x", 7), (8, "w " * 50_000, "x", 8), (9, "w " * 9, "x", 9), (9, "a b c", "x", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string, sig long")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(df).collect()), key=str)
    # rows of one id are one node: 9 links the repeated words and "a b c"
    assert got == sorted([(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (None, 1, None), (8, 1, 1),
                          (9, 1, 1), (9, 1, 1)], key=str)
    assert jaccard_components(df.limit(0)).count() == 0


def test_shingles_of_blocks_equal_a_loop():
    texts = ["a b c d e f", "", None, "É x y", " A  b\tC\nd\x0be ", "one", "q " * 12]
    at = 0
    for lo, hi, data, off in blocks(pa.array(texts)):
        doc, s = shingle_sets(data, off)
        assert np.bincount(doc, minlength=hi - lo).tolist() == [len(shingles(t)) for t in texts[lo:hi]]
        at = hi
    assert at == len(texts)


def test_segments_outnumber_differences():
    starts = band_starts(100_000)
    for n in (10, 10**6):
        for j, (m, near) in enumerate(allocate(starts, dict.fromkeys(range(len(starts)), n))):
            k = (starts[j + 1] - 1) // 4
            assert 2 * m > k if near else m > k


def test_linked_sets_of_all_sizes_share_a_prefix():
    starts, none = band_starts(150, FINE_RATIO), (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    rng = np.random.default_rng(5)
    for a in range(4, 121):
        for b in range(a, 5 * a // 4 + 1):
            both = -(-4 * (a + b) // 9)  # the least that links
            x = rng.integers(0, 2**63, a + b - both, dtype=np.uint64)
            s = np.concatenate([np.sort(x[:a]), np.sort(x[a - both:])])
            d, sig, role = prefixes(np.repeat([0, 1], [a, b]), s, 2, starts, none)
            held = [set(zip(sig[d == i].tolist(), role[d == i].tolist(), strict=True)) for i in (0, 1)]
            assert any((g, r if r == ANY else 3 - r) in held[1] for g, r in held[0]), (a, b)


def test_all_sizes_by_the_finer_index(spark):
    rng, rows = random.Random(8), []
    passage = [f"p{i}" for i in range(18)]
    for n in range(4, 121):  # texts that share a passage; one contains another that is a fifth shorter
        words = passage[:n // 2] + [f"w{rng.randrange(10**9)}" for _ in range(n + 4 - n // 2)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words + [f"z{n}x{i}" for i in range(n // 4)]))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(jaccard_components(df, pair_rows=10**6)) == brute(rows)


def test_a_null_id_before_its_copy_hides_no_link(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(None, " ".join(words)), (1, " ".join(words)), (2, " ".join([*words, "more"])), (None, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert [r["doc_id"] for r in df.collect()] == [None, 1, 2, None]
    got = [(r["doc_id"], r["component_id"]) for r in jaccard_components(df).collect()]
    assert sorted(got, key=str) == [(1, 1), (2, 1), (None, None), (None, None)]


@pytest.mark.parametrize("pair_rows", [1, 10**6])
def test_an_id_has_the_links_of_all_its_texts(spark, pair_rows):
    rows, expected = [], set()
    for g, order in enumerate(permutations([1, 1, 2, 4])):  # every order of a group's rows
        short, long, seen = [f"s{g}x{i}" for i in range(60)], [f"l{g}x{i}" for i in range(400)], 0
        for i in order:
            words = {2: [*short, "x"], 4: [*long, "x"], 1: (short, long)[seen]}[i]
            seen ^= i == 1
            rows.append((10 * g + i, " ".join(words)))
        expected |= {(10 * g + i, 10 * g + 1) for i in (1, 2, 4)}
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {(r["doc_id"], r["component_id"]) for r in jaccard_components(df, pair_rows=pair_rows).collect()} == expected


def test_folded_parities_bound_the_difference():
    rng = np.random.default_rng(7)
    for a, b, both in ((3, 3, 1), (30, 37, 20), (500, 530, 300), (1000, 1100, 950), (3000, 3700, 2000)):
        x = np.unique(rng.integers(0, 2**63, 2 * (a + b), dtype=np.uint64))[:a + b - both]
        rng.shuffle(x)
        at, words = _parity(np.repeat([0, 1], [a, b]), np.concatenate([x[:a], x[a - both:]]), 2)
        p, q = words[at[0]:at[1]], words[at[1]:at[2]]
        assert len(q) in (len(p), 2 * len(p))
        if len(q) > len(p):
            q = q[:len(p)] ^ q[len(p):]
        apart = sum(int(v).bit_count() for v in (p ^ q).view(np.uint64))
        assert 0.6 * (a + b - 2 * both) < apart <= a + b - 2 * both


def test_the_finer_index_has_fewer_rows_than_shingles():
    sizes = np.arange(40, 2_000, 37)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    s = np.random.default_rng(2).integers(0, 2**63, len(doc), dtype=np.uint64)
    d, sig, _ = prefixes(doc, s[np.lexsort((s, doc))], len(sizes), band_starts(2_000, FINE_RATIO), (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    rows = np.bincount(d, minlength=len(sizes))
    assert (rows > sizes // 9).all() and (rows <= 6 * sizes // 10 + 4).all()


def test_texts_around_one_passage_make_no_pairs_in_the_finer_index(spark):
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 2**63, 130, dtype=np.uint64)
    # the lists of both kinds reach the passage; two of the smaller ones link, one of either kind doesn't
    sets = [np.append(passage, rng.integers(0, 2**63, 14 if i % 2 else 26, dtype=np.uint64)) for i in range(60)]
    doc, s = np.repeat(np.arange(60), [len(x) for x in sets]), np.concatenate([np.sort(x) for x in sets])
    found = placed_prefixes(doc, s, 60, band_starts(300, FINE_RATIO), (np.sort(passage), np.full(130, 60)))
    rows = [(int(g), int(i), int(r), len(sets[i]), int(x), int(i)) for i, g, r, x in zip(found[0], found[1].view(np.int64), *found[2:], strict=True)]
    df = spark.createDataFrame(rows, "sig long, doc_id long, role byte, n long, rest int, label long")
    linked = {(u, v) for u, v in combinations(range(60), 2) if u % 2 and v % 2}
    assert {tuple(sorted(r)) for r in _across(df).collect()} == linked
    assert len({tuple(sorted(r)) for r in _across(df.drop("rest")).collect()}) == len(linked) + 900
