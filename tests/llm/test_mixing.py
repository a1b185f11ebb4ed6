"""Op 5 against water-filling and a sorted prefix in plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from wearline.llm.mixing import mix_sources


def brute(rows):
    """{source: (source_size, target, {hash: repeats})}."""
    size = defaultdict(int)
    by = defaultdict(lambda: defaultdict(int))
    for i, text, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        size[source] += n
        by[source][int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16)] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(size.values()))
    while free:
        share = rest / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= 3 * size[s]}
        if not over:
            target |= {s: share * weight[s] for s in free}
            break
        target |= {s: 3.0 * size[s] for s in over}
        rest -= sum(3 * size[s] for s in over)
        free -= over
    out = {}
    for s in names:
        full = int(target[s] // size[s]) if size[s] else 0
        extra, used, below = target[s] - full * size[s], 0, None
        for h in sorted(h for h, n in by[s].items() if n):
            if used + by[s][h] > extra:
                below = h + 1 if used + by[s][h] - extra <= extra - used else h
                break
            used += by[s][h]
        out[s] = size[s], target[s], {h: full + (below is not None and h < below) for h in by[s]}
    return out


@pytest.mark.parametrize("bits", [2, 12])
def test_equals_plain_python(spark, bits):
    rng = random.Random(bits)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.choice([0, 1, 5, 40]))),
             rng.choice(["a"] * 8 + ["B", "é", "c", None, "z"])) for i in range(400)]
    rows += [(None, "x y", "B"), (7, "again", "a"), (7, "again", "a"), (900, None, "empty"), (901, "big " * 3000, "c"), (902, "t", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "'x' as target")
    want = brute(rows)
    got = mix_sources(df, bits=bits).collect()
    assert len(got) == len(rows)
    for r in got:
        size, target, repeats = want[r["source"]]
        h = int(hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest()[:15], 16)
        assert r["source_size"] == size and r["target"] == pytest.approx(target, rel=1e-12)
        assert r["repeats"] == repeats[h] and r["taken"] == r["size"] * r["repeats"] <= 3 * r["size"]


def test_empty_table(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
