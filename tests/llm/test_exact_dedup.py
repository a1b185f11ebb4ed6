"""Op 4 against a dictionary of normalised texts, and the directory's invariants."""

import hashlib
import random
import string

import pytest

from wearline.llm.exact_dedup import directory, exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for i, t in rows:
        n = (t or "").translate(LOWER)
        ids = [x for x in groups[n] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("bucket_rows", "max_depth"), [(65_536, 16), (3, 6)])
def test_equals_a_dictionary(spark, bucket_rows, max_depth):
    rng = random.Random(bucket_rows)
    texts = ["Ab c", "aB C", "ab  c", "É", "é", "", None, "x" * 50_000, "X" * 50_000, "\n", "ÀA", "Àa"] + [f"t{i}" for i in range(60)]
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(7, "ab c"), (7, "ab c"), (None, "ab c"), (None, "only null id"), (None, "only null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'x' as bucket", "2 as id").repartition(4)
    out = exact_dedup(df, bucket_rows=bucket_rows, max_depth=max_depth)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in out.collect()), key=str) == brute(rows)
    assert exact_dedup(df.limit(0)).count() == 0


def test_directory_doubles_until_buckets_fit():
    rng = random.Random(1)
    histogram = {rng.randrange(1 << 10): rng.randrange(1, 40) for _ in range(300)} | {5: 1000}
    depth, slots = directory(histogram, 50, 10)
    assert len(slots) == 1 << depth and slots == sorted(slots)
    held = {}
    for prefix, n in histogram.items():
        bucket = slots[prefix >> (10 - depth)]
        held.setdefault(bucket, []).append((prefix, n))
    assert sum(n for b in held.values() for _, n in b) == sum(histogram.values())
    assert all(sum(n for _, n in b) <= 50 or len(b) == 1 for b in held.values())
    assert directory({}, 50, 10) == (0, [0])
