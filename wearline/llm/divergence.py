"""Source divergence audit by count-level bitmaps.

A group is a (lang, source). Each lang keeps the terms in at least ``MIN_DOCS`` of its documents; a group
gives each kept term p = 1 + floor(SCALE * (count + 1) / (N + V)), N the sum of its counts, V the
kept terms. A group's value against q is the sum of f = floor((p - q)^2 / q) over the kept terms.

1. Tally: a task counts occurrences and documents per (lang, source, term) in dictionaries of bounded
   size; sums follow. Kept terms are numbered by falling total, 64 to a word, so that the terms of a word
   have few different counts; the numbers come from range partitions, not from one sorted task.
2. Bitmaps: a row per (group, count, word) holds the bits of the terms with this count; terms of count 0
   have no row. The lang itself is a group with its totals. N is the sum of count * popcount.
3. Pairs: per lang and ``WORDS`` words, the rows of two groups meet word by word. AND and popcount give the joint
   cells (count of one, count of the other), each multiplied by its f in either direction. Zeros follow
   by complement: what a level has left after all joint cells meets count 0 of the other group, and
   the terms in neither meet as zeros on both sides. Groups of sources (``SOURCES`` each) meet in tasks of their own.
4. Terms: AND with the lang's bitmaps gives cells of one f each; of a chunk only cells that can hold the
   first ``TOP`` terms go on, and only their bits become terms.

Counts are 64-bit, p is made with decimals, f and its sums stay below 4 * SCALE^2: all exact.

Defined cases: null text, lang and source are ''; a group without terms has count 0 for each kept term; a
lang without kept terms gives its pairs 0; ties go to the smaller item in UTF-8 order; repeated rows
are documents of their own; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, python_ready, written

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
ENTRIES = 300_000
WORDS = 256
SOURCES = 32
#: ASCII letters in lower case and all bytes of other characters; what else there is parts terms.
_LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_CELLS = "lang string, x int, y int, either long, xy long, yx long, word long, bits long, value long"


def _tally(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, source, term, n, docs) of some documents; one row without a term for each group met."""
        counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        docs: dict[tuple[str, str], Counter] = defaultdict(Counter)
        size = 0
        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                terms = text.translate(_LETTERS).split()
                own = counts[lang, source]
                before = len(own)
                own.update(terms)
                docs[lang, source].update(set(terms))
                size += len(own) - before
                if size > entries:
                    yield from _counted(counts, docs)
                    counts.clear()
                    docs.clear()
                    size = 0
        yield from _counted(counts, docs)

    return run


def _counted(counts: dict[tuple[str, str], Counter], docs: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, source), n in counts.items():
        terms, held = list(n), docs[lang, source]
        size = len(terms) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * size), pa.array([source] * size), pa.array([None, *terms], pa.binary()).cast(pa.string()),
             pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(held.__getitem__, terms)], pa.int64())],
            ["lang", "source", "term", "n", "docs"])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted terms with the word and bit of each; a word holds terms of one lang."""
    from pyspark import TaskContext

    word, bit, last = TaskContext.get().partitionId() << 32, -1, None
    for b in batches:
        words, bits = [], []
        for lang in b.column(0).to_pylist():
            bit += 1
            if bit == 64 or (lang != last and last is not None):
                word, bit = word + 1, 0
            last = lang
            words.append(word)
            bits.append(bit)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(words, pa.int64()), pa.array(bits, pa.int32())], [*b.schema.names, "word", "bit"])


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _met(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in two sorted arrays of words that are equal."""
    lo = np.searchsorted(b, a, "left")
    n = np.searchsorted(b, a, "right") - lo
    return np.repeat(np.arange(len(a)), n), np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)


def _joint(x: tuple, y: tuple) -> tuple[int, int, int]:
    """Terms with either, and the sums of f(p of x, p of y) and f(p of y, p of x) over them."""
    (x_word, x_p, x_bits, x_zero), (y_word, y_p, y_bits, y_zero) = x, y
    i, j = _met(x_word, y_word)
    both = np.bitwise_count(x_bits[i] & y_bits[j]).astype(np.int64)
    some = both > 0
    i, j, both = i[some], j[some], both[some]
    x_rest = np.bitwise_count(x_bits).astype(np.int64)
    y_rest = np.bitwise_count(y_bits).astype(np.int64)
    np.subtract.at(x_rest, i, both)
    np.subtract.at(y_rest, j, both)
    xy = both @ _f(x_p[i], y_p[j]) + x_rest @ _f(x_p, y_zero) + y_rest @ _f(x_zero, y_p)
    yx = both @ _f(y_p[j], x_p[i]) + x_rest @ _f(y_zero, x_p) + y_rest @ _f(y_p, x_zero)
    return int(both.sum() + x_rest.sum() + y_rest.sum()), int(xy), int(yx)


def _top(x: tuple, whole: tuple, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (word, bits, f) of a group against its lang where p is larger; those that can hold the first ``top`` terms."""
    i, j = _met(x[0], whole[0])
    bits = x[2][i] & whole[2][j]
    some = (bits != 0) & (x[1][i] > whole[1][j])
    i, j, bits = i[some], j[some], bits[some]
    f = _f(x[1][i], whole[1][j])
    order = np.argsort(-f, kind="stable")
    upto = np.cumsum(np.bitwise_count(bits[order]).astype(np.int64))
    if len(upto) and upto[-1] > top:
        last = f[order[np.searchsorted(upto, top)]]
        order = order[f[order] >= last]
    return x[0][i[order]], bits[order], f[order]


def _cells(top: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Rows of two sets of sources over the same words (no ``source_no``: the lang itself)."""
        lang, _, a, b = (k.as_py() for k in key)
        table = table.combine_chunks()
        no = table.column("source_no").fill_null(-1).to_numpy()
        word, p, zero = (table.column(c).to_numpy() for c in ("word", "p", "zero"))
        bits = table.column("bits").to_numpy().view(np.uint64)
        order = np.lexsort((word, zero, no))  # a group's zero row comes last
        no, word, p, bits, zero = no[order], word[order], p[order], bits[order], zero[order]
        ends = {int(n): (np.searchsorted(no, n, "left"), np.searchsorted(no, n, "right")) for n in np.unique(no)}
        rows = {}
        for n, (lo, hi) in ends.items():
            cut = hi - 1 if n >= 0 else hi
            rows[n] = word[lo:cut], p[lo:cut], bits[lo:cut], p[cut] if n >= 0 else None
        out: dict[str, list] = {c.split()[0]: [] for c in _CELLS.split(", ")}

        def add(**values) -> None:
            for c, held in out.items():
                held.append(values.get(c))

        sources = sorted(n for n in rows if n >= 0)
        for x in sources:
            if x // SOURCES != a:
                continue
            for y in sources:
                if y > x and y // SOURCES == b:
                    either, xy, yx = _joint(rows[x], rows[y])
                    add(lang=lang, x=x, y=y, either=either, xy=xy, yx=yx)
            if a == b and -1 in rows:
                for w, s, f in zip(*(v.tolist() for v in _top(rows[x], rows[-1], top)), strict=True):
                    add(lang=lang, x=x, word=w, bits=s - (1 << 64) if s >> 63 else s, value=f)
        kinds = {"lang": pa.string(), "x": pa.int32(), "y": pa.int32()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    return run


def _p(n: Column, total: Column, terms: Column) -> Column:
    def big(c: Column) -> Column:
        return c.cast("decimal(20,0)")

    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * big(n + F.lit(1)), big(total + terms))).cast("long")


def _f_col(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _bits(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """terms (lang, term, n, word, bit), levels (lang, source, n, word, bits; null source: the lang itself),
    groups (lang, source, source_no, total, terms), all written."""
    python_ready(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))],
                        text.alias("text"))
    tally = given.mapInArrow(_tally(ENTRIES), "lang string, source string, term string, n long, docs long")
    tally = written(tally.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "tally")
    kept = tally.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = written(kept.filter(F.col("docs") >= min_docs).select("lang", "term", "n"), "kept")
    order = ["lang", F.desc("n"), "term"]
    terms = written(kept.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _number, "lang string, term string, n long, word long, bit int"), "terms")
    counts = tally.select("lang", "source", "term", "n").join(terms.drop("n"), ["lang", "term"])
    whole = _bits(terms, "lang", "n", "word").select("lang", F.lit(None).cast("string").alias("source"), "n", "word", "bits")
    levels = written(_bits(counts, "lang", "source", "n", "word").unionByName(whole), "levels")
    totals = levels.groupBy("lang", "source").agg(F.sum(F.col("n") * F.bit_count("bits")).alias("total"),
                                                  F.sum(F.bit_count("bits").cast("long")).alias("size"))
    sizes = totals.filter("source IS NULL").select("lang", F.col("size").alias("terms"))
    none = F.lit(0).cast("long")
    groups = tally.filter("term IS NULL").select("lang", "source").withColumn(
        "source_no", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.join(totals.filter("source IS NOT NULL").drop("size"), ["lang", "source"], "left").join(sizes, "lang", "left")
    return terms, levels, written(groups.select(
        "lang", "source", "source_no", F.coalesce("total", none).alias("total"), F.coalesce("terms", none).alias("terms")), "groups")


def _dealt(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of all sets of sources that meet: lang, words, a, b, source_no, word, p, bits, zero."""
    words = F.expr(f"word div {WORDS}")
    own = levels.filter("source IS NOT NULL").join(groups, ["lang", "source"])
    own = own.select("lang", words.alias("words"), "source_no", "word", _p(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "bits",
                     F.lit(False).alias("zero"))
    whole = levels.filter("source IS NULL")
    size = whole.groupBy("lang").agg(F.sum(F.col("n") * F.bit_count("bits")).alias("total"), F.sum(F.bit_count("bits").cast("long")).alias("terms"))
    whole_rows = whole.join(size, "lang").select(
        "lang", words.alias("words"), F.lit(None).cast("int").alias("source_no"), "word",
        _p(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "bits", F.lit(False).alias("zero"))
    chunks = whole.select("lang", words.alias("words")).distinct()
    zeros = chunks.join(groups, "lang").select(
        "lang", "words", "source_no", F.lit(0).cast("long").alias("word"), _p(F.lit(0), F.col("total"), F.col("terms")).alias("p"),
        F.lit(0).cast("long").alias("bits"), F.lit(True).alias("zero"))
    sets = groups.groupBy("lang").agg(F.expr(f"max(source_no) div {SOURCES}").cast("int").alias("last"))
    rows = own.unionByName(zeros).unionByName(whole_rows).join(sets, "lang")
    mine = F.expr(f"cast(source_no div {SOURCES} as int)")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    rows = rows.withColumn("a", F.least(F.coalesce(mine, "other"), "other")).withColumn("b", F.greatest(F.coalesce(mine, "other"), "other"))
    return rows.drop("other", "last")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    terms, levels, groups = bitmaps(docs, min_docs, text_col, lang_col, source_col)
    cells = written(_dealt(levels, groups).groupBy("lang", "words", "a", "b").applyInArrow(_cells(top), _CELLS), "cells")

    sums = cells.filter("y IS NOT NULL").groupBy("lang", "x", "y").agg(*[F.sum(c).alias(c) for c in ("either", "xy", "yx")])
    zero = _p(F.lit(0), F.col("total"), F.col("terms"))
    some = F.col("terms") > 0
    one = groups.select("lang", "source", F.col("source_no").alias("i"), F.when(some, zero).alias("p"), "terms")
    other = groups.select("lang", F.col("source").alias("item"), F.col("source_no").alias("j"), F.when(some, zero).alias("q"))
    pairs = one.join(other, "lang").filter("i != j")  # the result has a row for each
    pairs = pairs.withColumn("x", F.least("i", "j")).withColumn("y", F.greatest("i", "j")).join(sums, ["lang", "x", "y"], "left")
    value = F.when(F.col("i") < F.col("j"), F.col("xy")).otherwise(F.col("yx")) + (F.col("terms") - F.col("either")) * _f_col(F.col("p"), F.col("q"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce(value, F.lit(0).cast("long")).alias("value"))
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(own))

    held = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("getbit", F.col("bits"), b) == 1)
    found = cells.filter("word IS NOT NULL").select("lang", F.col("x").alias("source_no"), "word", "value", F.explode(held).alias("bit"))
    found = found.join(terms.select(F.col("term").alias("item"), "word", "bit"), ["word", "bit"])
    found = found.join(groups.select("lang", "source", "source_no"), ["lang", "source_no"])
    found = found.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(own))
    return pairs.unionByName(found.filter(F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir, "text", "lang", "source"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
full_c AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
                  sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
           FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (full_c.total::HUGEINT + v) AS p FROM full_c JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 1)) // (total + v) AS q FROM kept JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term),
pairs AS (SELECT every.*, coalesce(pair.value, 0) AS value FROM every LEFT JOIN pair USING (lang, source, item))
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value::BIGINT, rank::INT FROM ranked WHERE rank <= 200
"""
