"""N-gram Jaccard join: universe partitioning with the pigeonhole principle, verified exactly.

Documents are sets of distinct 5-word shingles; two link at 100 * |A n B| >= 80 * |A u B|.
Such sets differ in at most k = (|A| + |B|) / 9 shingles, and |B| <= 5/4 |A|.

1. Size bands: a document belongs to the band of its size, and as the larger partner to
   the band below where a partner could lie there.
2. Universe partition: in a band, shingle hashes are dealt into m > k segments. Two linked
   documents agree on at least m - k whole segments (exact index), or, with m > k / 2, on at
   least one segment up to one shingle: then a segment is indexed with its neighbourhood
   of one deletion. ``allocate`` picks the form by the cost in index rows and chance
   candidates, per band, from the band sizes of all documents.
3. Segment subsets: a document indexes only as many segments as its own size needs and
   leaves out the most expensive ones. The cost of a signature is how often the corpus holds
   it (counted over all documents; only the ``COST_ROWS`` most frequent are told apart), then
   its hash: an order on which both partners agree, so at least one common segment
   is indexed by both whatever the costs are. Empty segments come last in that order. An exact
   index has twice the segments it needs, so that those a shared passage fills can be left out.
4. Documents that share a signature become candidates. Of a signature's documents, the
   one is verified against the others first, by turns the least and the greatest, as long as
   at least one in ``STAR_SHARE`` such pairs links; components of the links found so far then
   leave only pairs across components, so a group of copies isn't expanded into all its pairs.
   Where the pairs of a signature's documents cost less than indexing their shingles (a pair
   counts as ``PAIR_ROWS`` index rows), all pairs across are verified. The
   documents of the other, crowded signatures (sharing much, yet not enough) are indexed once more among
   themselves, by single shingles: the rarest ones of each set, of which linked partners share at
   least one, about half as many rows as the set has shingles. A row knows how much of its set is not rarer: where linked
   partners first meet, that is enough on both sides to link, and other meetings (over a passage behind shingles of
   their own) make no pair. The pairs across that are left are verified too, so no link between components is lost.
5. Verification: sizes and parities of two to four bits a shingle rule pairs out (they bound the
   difference from below), then the two shingle sets are intersected in full.

Identical sets are one class from the start. A bitmap of 2**23 bits (fixed size) tells tasks
which texts may be candidates before their sets are shuffled; a join on the id decides.

Defined cases: null or blank text gives an empty set, linked with nothing; rows that
carry one id are one node of the graph, with the links of each of its texts; a null id gets a null component; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, python_ready, written
from .components import components
from .shingles import blocks, mix, shingle_sets, sums

BAND_RATIO = 1.5625
COST_ROWS = 1_000_000
MIN_COST = 4
CHANCE = 0.002
SLOTS = 1 << 23
STAR_SHARE = 5
PAIR_ROWS = 16
FINE_RATIO = 1.25
ANY, UPPER, LOWER = 0, 1, 2  # roles in an index: two UPPER or two LOWER meet elsewhere; LOWER is the smaller one


def band_starts(largest: int, ratio: float = BAND_RATIO) -> list[int]:
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * ratio)))
    return out


def allocate(starts: list[int], counts: dict[int, int]) -> list[tuple[int, bool]]:
    """Per band: number of segments and whether they are indexed with one-deletion neighbourhoods."""
    out = []
    for j in range(len(starts) - 1):
        top = starts[j + 1] - 1
        k, n = top // 4, counts.get(j, 0) + counts.get(j + 1, 0)
        exact, near = 2 * k + 3, k // 2 + 1
        lone = near * (1 + top / near) * math.exp(-top / near) if near > 1 else 0.0
        exact_cost = k + 1 + 4 * n * exact * CHANCE ** (top / exact)
        near_cost = near + top + 4 * n * (top * CHANCE ** max(top / near - 1, 0) + lone * lone)
        out.append((near, True) if near_cost < exact_cost else (exact, False))
    return out


def _classes(doc: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.bincount(doc, minlength=n), sums(mix(s, 1), doc, n).view(np.int64), sums(mix(s, 2), doc, n).view(np.int64))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, off in blocks(b.column(1)):
            n, h1, h2 = _classes(*shingle_sets(data, off), hi - lo)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(h1), pa.array(h2)],
                ["doc_id", "n_shingles", "h1", "h2"])


def signatures(doc: np.ndarray, s: np.ndarray, n: int, starts: list[int], plan: list[tuple[int, bool]],
               costs: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, signature, role) rows of a block; without ``costs`` all segments, else the cheapest that suffice."""
    size = np.bincount(doc, minlength=n)
    starts, seg_of, near_of = np.array(starts), np.array([p[0] for p in plan]), np.array([p[1] for p in plan])
    own = np.searchsorted(starts, size, "right") - 1
    out = []
    for upper in (False, True):
        band = own - upper
        top = starts[np.clip(band + 1, 0, len(starts) - 1)] - 1
        ok = (size > 0) & (band >= 0) & (top // 4 > 0)
        if upper:
            ok &= 4 * size <= 5 * top
        who = np.flatnonzero(ok)
        k = np.minimum(size[who] // 4, (size[who] + top[who]) // 9) if upper else size[who] // 4
        d, sig = _segments(s, size, who, band[who], k, seg_of[band[who]], near_of[band[who]], costs)
        out.append((d, sig, np.full(len(d), UPPER if upper else ANY, np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def prefixes(doc: np.ndarray, s: np.ndarray, n: int, starts: list[int], costs: tuple[np.ndarray, np.ndarray],
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The (document, signature, role) of ``placed_prefixes``."""
    return placed_prefixes(doc, s, n, starts, costs)[:3]


def placed_prefixes(doc: np.ndarray, s: np.ndarray, n: int, starts: list[int], costs: tuple[np.ndarray, np.ndarray],
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, signature, role, rest) rows of single shingles: the rarest ones that any linked partner must meet.

    Sets of s and at least t shingles link only with 4/9 (s + t) in common, so they share one of the
    s - 4/9 (s + t) + 1 rarest of either. The smaller set of a pair (LOWER) has one list, under its band; the
    larger one (UPPER) a list for every band where a smaller partner can lie: with bands of 5/4, its own and the one below.
    ``rest``: how many shingles of the set are not rarer than the row's. Where two sets first meet, they have no more in common
    than the lesser rest, so of linked sets that row has a rest of at least 4/9 (s + t) on both sides.
    """
    size = np.bincount(doc, minlength=n)
    edges = np.array(starts)
    own = np.searchsorted(edges, size, "right") - 1
    first = np.cumsum(size) - size
    order = np.lexsort((s, _costs(s, costs), doc))
    x = s[order]
    rank = np.arange(len(x)) - first[doc]
    # bands are cut at whole sizes, so how many lie between linked sizes follows from the edges, not from the ratio
    farthest = int((np.searchsorted(edges, 5 * (edges[1:] - 1) // 4, "right") - 1 - np.arange(len(edges) - 1)).max())
    lists = [(LOWER, own, size)] + [(UPPER, own - apart, np.maximum(edges[np.maximum(own - apart, 0)], -(-4 * size // 5))) for apart in range(1 + farthest)]
    out = []
    for role, band, least in lists:  # ``least``: of the partner's size
        ok = (size > 0) & (band >= 0)
        if role == UPPER:
            ok &= least <= np.minimum(size, edges[np.clip(band + 1, 0, len(edges) - 1)] - 1)
        keep = np.where(ok, size - -(-4 * (size + least) // 9) + 1, 0)
        take = rank < keep[doc]
        d = doc[take]
        sig = mix(x[take] ^ mix(band[d].astype(np.uint64), 9), 10)
        out.append((d, sig, np.full(len(d), role, np.int8), (size[doc] - rank)[take]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segments(s: np.ndarray, size: np.ndarray, who: np.ndarray, group: np.ndarray, k: np.ndarray, m: np.ndarray,
              near: np.ndarray, costs) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of documents ``who`` in a group each, of m segments; exact ones are cut to the k + 1 cheapest."""
    if not len(who):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = (np.cumsum(size) - size)[who]
    base = np.concatenate([[0], np.cumsum(m)])
    rows = np.repeat(np.arange(len(who)), size[who])
    x = s[np.arange(len(rows)) - np.repeat(np.cumsum(size[who]) - size[who], size[who]) + np.repeat(first, size[who])]
    slot = base[rows] + (mix(x, 3) % m[rows].astype(np.uint64)).astype(np.int64)
    total = sums(mix(x, 4), slot, int(base[-1]))
    owner = np.repeat(np.arange(len(who)), m)
    tag = mix((np.arange(len(owner)) - base[owner]).astype(np.uint64) + (group[owner].astype(np.uint64) << np.uint64(32)), 5)
    sig = mix(total ^ tag, 6)
    empty = np.bincount(slot, minlength=int(base[-1])) == 0
    if costs is None:
        take = ~empty | near[owner]
    else:
        cost = _costs(sig, costs)
        cost[empty] = np.iinfo(np.int64).max
        order = np.lexsort((sig, cost, owner))
        rank = np.empty(len(owner), np.int64)
        rank[order] = np.arange(len(owner)) - base[owner[order]]
        take = near[owner] | (rank <= k[owner])
    lone = near[rows]
    with np.errstate(over="ignore"):
        without = mix((total[slot[lone]] - mix(x[lone], 4)) ^ tag[slot[lone]], 6)
    return np.append(who[owner[take]], who[rows[lone]]), np.append(sig[take], without)


def _costs(sig: np.ndarray, costs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, count = costs
    if not len(known):
        return np.zeros(len(sig), np.int64)
    at = np.minimum(np.searchsorted(known, sig), len(known) - 1)
    return np.where(known[at] == sig, count[at], 0)


def _text_rows(starts, plan):
    """(document id, signature) rows of texts; of documents with one set, a task indexes the first that has an id."""
    def rows(batches, costs) -> Iterator[tuple]:
        seen: set[tuple[int, int]] = set()
        for b in batches:
            for lo, hi, data, off in blocks(b.column(1)):
                ids = b.column(0).slice(lo, hi - lo)
                doc, s = shingle_sets(data, off)
                _, h1, h2 = _classes(doc, s, hi - lo)
                new = ~np.asarray(ids.is_null())  # a row without an id never stands for its set
                for i, key in enumerate(zip(h1.tolist(), h2.tolist(), strict=True)):
                    if new[i]:
                        new[i] = key not in seen
                        seen.add(key)
                keep = new[doc]
                d, sig, role = signatures(doc[keep], s[keep], hi - lo, starts, plan, costs)
                yield np.asarray(ids.fill_null(0))[d], sig, role, None

    return rows


def _set_rows(starts):
    """(document id, signature) rows of shingle sets by their prefixes; without costs, the shingles themselves."""
    def rows(batches, costs) -> Iterator[tuple]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, min(256, b.num_rows - lo))
                doc = np.repeat(np.arange(len(part)), np.diff(part.column(1).offsets.to_numpy()))
                d, sig, role, rest = doc, part.column(1).flatten().to_numpy().view(np.uint64), None, None
                if costs is not None:
                    d, sig, role, rest = placed_prefixes(doc, sig, len(part), starts, costs)
                yield part.column(0).to_numpy()[d], sig, role, rest

    return rows


def _counter(rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out():
            sig, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(sig[often].view(np.int64)), pa.array(count[often].astype(np.int64))], ["sig", "n"])

        for _, sig, _, _ in rows(batches, None):
            held.append(sig)
            n += len(sig)
            if n > 1_000_000:
                yield out()
                held, n = [], 0
        if held:
            yield out()

    return run


def _indexer(rows, costs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sig, role, rest in rows(batches, costs.value):
            columns = {"sig": sig.view(np.int64), "doc_id": ids.astype(np.int64), "role": role}
            if rest is not None:
                columns["rest"] = rest.astype(np.int32)
            yield pa.RecordBatch.from_pydict({c: pa.array(x) for c, x in columns.items()})

    return run


_INDEX = "sig long, doc_id long, role byte"
_PLACED = f"{_INDEX}, rest int"


def _index(source: DataFrame, rows, schema: str = _INDEX) -> DataFrame:
    """(sig, doc_id) of signatures that at least two rows hold: costs over all rows, then the index."""
    spark = source.sparkSession
    often = (source.mapInArrow(_counter(rows), "sig long, n long").groupBy("sig").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= MIN_COST).orderBy(F.desc("n"), "sig").limit(COST_ROWS).toArrow())  # 16 bytes a row
    known, count = (often.column(i).to_numpy() for i in (0, 1))
    known = known.view(np.uint64)
    by = np.argsort(known)
    costs = spark.sparkContext.broadcast((known[by], count[by]))
    index = source.mapInArrow(_indexer(rows, costs), schema)
    return written(index.repartition("sig").sortWithinPartitions("sig").mapInArrow(_shared, schema), "shared")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature, those whose signature occurs more than once."""
    held, carried = None, False  # the last row so far; its signature has occurred before
    for b in batches:
        if not b.num_rows:
            continue
        rows = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        sig = rows.column(0).to_numpy()
        same = np.append(sig[1:] == sig[:-1], False)
        keep = same | np.append([carried], same[:-1])
        carried = bool(keep[-1])
        keep[-1] = False  # held until the next row is known
        yield rows.filter(pa.array(keep))
        held = rows.slice(len(sig) - 1)
    if carried:
        yield held


def _hits(bits: np.ndarray, ids: pa.Array) -> pa.Array:
    """Which ids a bitmap may hold."""
    slot = (mix(np.asarray(ids.fill_null(0)).astype(np.uint64), 7) % np.uint64(SLOTS)).astype(np.int64)
    hit = (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
    return pa.array(hit & ~np.asarray(ids.is_null()))


def _parity(doc: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and words of a bit set per text: whether an odd number of its shingles falls on the bit.

    A set of n shingles has the least power of two of bits from 2 n on, at least 64. The shingle's low bits choose
    the bit, so the two halves of a set of bits, XORed, are the set of half as many.
    """
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * np.bincount(doc, minlength=n), 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(bits)])
    spot = first[doc] + (mix(s, 8) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(spot, minlength=int(first[-1])) & 1).astype(np.uint8)
    return (first // 64).astype(np.int32), np.packbits(odd, bitorder="little").view(np.int64)


def _sets(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(_hits(bitmap.value, b.column(0)))
            for lo, hi, data, off in blocks(b.column(1)):
                doc, s = shingle_sets(data, off)
                n = hi - lo
                at = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
                first, words = _parity(doc, s, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n).cast(pa.int64()), pa.array(np.diff(at)),
                     pa.ListArray.from_arrays(pa.array(first), pa.array(words)),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(s.view(np.int64)))],
                    ["doc_id", "n", "parity", "shingles"])

    return run


def _only(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(_hits(bitmap.value, b.column(0)))

    return run


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        slot = (mix(b.column(0).to_numpy().astype(np.uint64), 7) % np.uint64(SLOTS)).astype(np.int64)
        bit = np.uint64(1) << (slot & 63).astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array((slot >> 6).astype(np.int64)), pa.array(bit.view(np.int64))], ["word", "bit"])


def _bitmap(ids: DataFrame):
    """A broadcast bitmap of SLOTS bits (1 MB at every size) that holds the ids."""
    words = (ids.mapInArrow(_slots, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit"))
             .collect())  # at most SLOTS / 64 rows
    bits = np.zeros(SLOTS // 64, np.uint64)
    for r in words:
        bits[r["word"]] = np.uint64(r["bit"] & 0xFFFFFFFFFFFFFFFF)
    return ids.sparkSession.sparkContext.broadcast(bits)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link.

    Sizes and parities settle most pairs: sets differ at least in as many shingles as
    parity bits, and linked sets in few enough. Near sizes have as many bits or twice as many,
    which are then folded. The others have their whole sets intersected.
    """
    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    def folded(own: str, other: str) -> Column:
        half = F.floor(F.size(own) / 2).cast("int")
        halves = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > F.size(other), halves).otherwise(F.col(own))

    sized = pairs.join(side("u", "n", "parity"), "u").join(side("v", "n", "parity"), "v")
    sized = sized.filter((percent * F.col("u_n") <= 100 * F.col("v_n")) & (percent * F.col("v_n") <= 100 * F.col("u_n")))
    differ = F.zip_with(folded("u_parity", "v_parity"), folded("v_parity", "u_parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differ, F.lit(0), lambda a, x: a + x)
    total = F.col("u_n") + F.col("v_n")  # |A| + |B| - apart >= 2 |A n B|, and linked: |A n B| >= total * p / (100 + p)
    maybe = (100 + percent) * (total - apart) >= 2 * percent * total
    left = written(sized.filter(maybe).select("u", "v").distinct(), "pairs")
    bits = _bitmap(left.select("u").union(left.select("v")))
    whole = sets.select("doc_id", "shingles").mapInArrow(_only(bits), "doc_id long, shingles array<long>")
    a = whole.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    b = whole.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = left.join(a, "u").join(b, "v").withColumn("both", F.size(F.array_intersect("a", "b")))
    return both.filter(F.lit(100) * F.col("both") >= F.lit(percent) * (F.size("a") + F.size("b") - F.col("both"))).select("u", "v")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair_rows: int = PAIR_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, class_id (least id with the same set)."""
    percent = 80  # the bands and segments above are those of 0.8
    spark = docs.sparkSession
    python_ready(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = written(texts.mapInArrow(_profile, "doc_id long, n_shingles long, h1 long, h2 long"), "profile")
    classes = written(profile.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2")
                      .agg(F.min("doc_id").alias("class_id"), F.max("n_shingles").alias("n")), "classes")
    largest = classes.agg(F.max("n")).first()[0] or 1
    starts = band_starts(largest)
    band = sum((F.col("n") >= F.lit(x)).cast("int") for x in starts) - 1
    counts = {r["band"]: r["count"] for r in classes.groupBy(band.alias("band")).count().collect()}  # one row per band
    plan = allocate(starts, counts)
    shared = _index(texts, _text_rows(starts, plan))
    member = profile.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(classes, ["h1", "h2"])
    member = written(member.select("doc_id", "class_id", "n"), "members")
    shared = shared.join(member.distinct(), "doc_id").select("sig", F.col("class_id").alias("doc_id"), "role", "n")
    rows = _open_rows(written(shared.distinct(), "rows"), None)
    bits = _bitmap(rows.select("doc_id"))
    sets = written(texts.mapInArrow(_sets(bits), "doc_id long, n int, parity array<long>, shingles array<long>"), "sets")
    links = member.filter("doc_id != class_id").select(F.col("doc_id").alias("u"), F.col("class_id").alias("v"))
    links = written(links.distinct(), "links")
    tried, turn, linking = None, 0, True
    label = None
    while linking:  # stars, as long as they link
        pairs = _pairs(_star(rows, turn % 2 == 0), tried)
        found = written(verify(pairs, sets, percent).distinct(), "found")
        links = written(links.unionByName(found), "links")
        label = components(links)
        turn, tried = turn + 1, pairs if tried is None else tried.unionByName(pairs)
        linking = found.count() * STAR_SHARE >= pairs.count() > 0
        rows = _open_rows(rows.select("sig", "doc_id", "role", "n"), label)
    of = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    crowded = written(of.filter(pair_rows * F.col("c") * (F.col("c") - 1) / 2 > F.col("n")).select("sig"), "crowded")
    crowd = written(rows.join(crowded, "sig", "left_semi").select("doc_id").distinct(), "crowd")
    pairs = _across(rows.join(crowded, "sig", "left_anti"))
    if not crowd.isEmpty():
        members = sets.select("doc_id", "shingles").mapInArrow(_only(_bitmap(crowd)), "doc_id long, shingles array<long>")
        members = written(members.join(crowd, "doc_id", "left_semi"), "crowd-sets")
        fine = _index(members, _set_rows(band_starts(largest, FINE_RATIO)), _PLACED)
        sizes = members.select("doc_id", F.size("shingles").cast("long").alias("n")).distinct()
        fine = _open_rows(fine.join(sizes, "doc_id").select("sig", "doc_id", "role", "n", "rest").distinct(), label)
        pairs = pairs.unionByName(_across(fine))
    found = verify(_pairs(pairs, tried), sets, percent).distinct()
    label = components(written(links.unionByName(found), "links"))
    ids = member.select(F.col("doc_id").alias("node")).distinct().join(label, "node", "left")
    ids = ids.select(F.col("node").alias("doc_id"), F.coalesce("label", "node").alias("component_id"))
    out = profile.select("doc_id", "n_shingles", "h1", "h2").join(ids, "doc_id", "left")
    out = out.join(classes.select("h1", "h2", "class_id"), ["h1", "h2"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.coalesce("class_id", "doc_id").alias("class_id"))


def _pairs(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    return written(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"), "pairs")


def _open_rows(shared: DataFrame, label: DataFrame | None) -> DataFrame:
    """Of distinct index rows, those of signatures that (still) meet in more than one component.

    An aggregate and a join on the signature, so that a frequent one is summed in part and its rows can be split.
    """
    rows = shared.withColumn("label", F.col("doc_id"))
    if label is not None:
        rows = shared.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        rows = rows.select(*shared.columns, F.coalesce("label", "doc_id").alias("label"))
    apart = rows.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("sig")
    return written(rows.join(apart, "sig", "left_semi"), "open")


def _near(n: str, other: str) -> Column:
    """Sizes that linked sets can have."""
    return (4 * F.col(n) <= 5 * F.col(other)) & (4 * F.col(other) <= 5 * F.col(n))


def _star(rows: DataFrame, least: bool) -> DataFrame:
    """Of each signature, one document (of the least or greatest component) against those of other components."""
    pick, key = (F.min_by if least else F.max_by), F.struct("label", "doc_id")
    hub = rows.groupBy("sig").agg(pick(F.struct("doc_id", "n", "label"), key).alias("hub"))
    return (rows.join(hub, "sig").filter((F.col("label") != F.col("hub.label")) & _near("n", "hub.n"))
            .select(F.col("doc_id").alias("u"), F.col("hub.doc_id").alias("v")).distinct())


def _across(rows: DataFrame) -> DataFrame:
    """Per signature, the documents of different components against each other (of one role, ANY only).

    Rows with a ``rest`` meet only where it leaves enough in common to link.
    """
    placed = "rest" in rows.columns
    other = rows.select("sig", F.col("doc_id").alias("v"), F.col("label").alias("other"), F.col("n").alias("m"), F.col("role").alias("part"),
                        *[F.col("rest").alias("left")] * placed)
    role, part = F.col("role"), F.col("part")
    roles = ((role == ANY) | (part == ANY) | ((role == LOWER) & (part == UPPER) & (F.col("n") <= F.col("m")))
             | ((role == UPPER) & (part == LOWER) & (F.col("n") >= F.col("m"))))
    meet = (F.col("label") > F.col("other")) & _near("n", "m") & roles
    if placed:
        meet &= 9 * F.least("rest", "left") >= 4 * (F.col("n") + F.col("m"))
    return rows.join(other, "sig").filter(meet).select(F.col("doc_id").alias("u"), "v").distinct()


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id isn't in ``ids`` (a column of ids); null ids stay.

    A bitmap lets most rows pass where they are; only rows that it may hold are shuffled for the join.
    """
    bits = _bitmap(ids.toDF("doc_id").select(F.col("doc_id").cast("long")))
    at = docs.columns.index(id_col)

    def split(hit: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = _hits(bits.value, b.column(at).cast(pa.int64()))
                yield b.filter(found if hit else pc.invert(found))

        return run

    apart = docs.mapInArrow(split(False), docs.schema)
    maybe = docs.mapInArrow(split(True), docs.schema)
    gone = ids.toDF("gone_id")
    return apart.unionByName(maybe.join(gone, maybe[id_col] == gone["gone_id"], "left_anti"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir, "doc_id", "text"))
