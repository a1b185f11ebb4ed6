"""Quality rules: a threshold table compiled into one Spark projection. No user functions.

``RULES`` is the table: name, measure, comparison, threshold. ``measures`` derives the
counts of a text from built-in array and string functions, row by row (no shuffle), and
``compile_rules`` turns the table into columns of that projection; ``failed`` lists
the rules a text breaks.

Words in repeated windows: all window hashes of a text are compared first; only windows
whose hash occurs twice are written out as strings and compared exactly, so a
hash collision can't make a repeat.

Defined cases: null and blank texts have no words, every count is 0 and ``base_failed``
is true; ratios with an empty denominator are 0; repeated rows are judged alike; columns
of the input other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, words_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "are", "with", "as", "be", "at", "by",
    "this", "from", "or", "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "des", "sich", "nicht", "ein",
    "eine", "als", "auch", "auf", "le", "la", "les", "de", "des", "et", "du", "un", "une", "que", "qui", "dans", "est",
    "pour", "par", "sur", "avec", "pas", "el", "los", "las", "en", "y", "a", "se", "no", "con", "del", "para", "una", "su",
]
#: Fixed values: (rule, measure, comparison that fails, threshold). Ratios are in percent and cross-multiplied.
RULES = [
    ("too_few_words", "n_words", "<", MIN_WORDS),
    ("repeated_windows", ("n_repeat_words", "n_words"), ">", MAX_REPEAT_PERCENT),
    ("symbols", ("n_symbols", "n_words"), ">", 30),
    ("short_words", ("word_chars", "n_words"), "<", 200),
    ("long_words", ("word_chars", "n_words"), ">", 1500),
    ("shouting", ("n_upper", "n_letters"), ">", 60),
    ("repeated_lines", ("n_dup_lines", "n_lines"), ">", 50),
    ("no_stop_words", ("n_stop_words", "n_words"), "<", 1),
]
BASE_RULES = ("too_few_words", "repeated_windows")


def _size(a: Column) -> Column:
    return F.size(a).cast("long")


def _chars(text: Column, pattern: str) -> Column:
    """Number of characters of ``text`` in a one-character class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def _twice(keyed: str, field: str) -> Column:
    """The elements of a sorted array column whose ``field`` equals a neighbour's."""
    a = F.col(keyed)
    return F.filter(a, lambda x, i: (F.get(a, i - 1)[field].eqNullSafe(x[field])
                                     | F.get(a, i + 1)[field].eqNullSafe(x[field])))


def _repeats(df: DataFrame) -> DataFrame:
    """``m_starts``: sorted starts of the windows of WINDOW words that occur at least twice in the row.

    Each array is a column of its own, as a lambda evaluates what it holds once per element
    (and ``slice`` reads its whole array each time, so windows are put together word by word).
    """
    win, key = F.col("m_windows"), F.col("m_keys")
    windows = F.when(F.size(key) >= WINDOW, F.transform(
        F.slice(key, 1, F.greatest(F.size(key) - (WINDOW - 1), F.lit(0))),
        lambda k, i: F.xxhash64(k, *[F.get(key, i + j) for j in range(1, WINDOW)]))).otherwise(
            F.array().cast("array<bigint>"))
    df = df.withColumn("m_windows", windows)
    keyed = F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("m_sorted", F.when(F.size(F.array_distinct(win)) == F.size(win), none)
                       .otherwise(F.sort_array(keyed)))
    df = df.withColumn("m_twice", _twice("m_sorted", "h"))
    words = F.col("m_words")
    df = df.withColumn("m_exact", F.sort_array(F.transform("m_twice", lambda x: F.struct(
        F.concat_ws(" ", *[F.get(words, x["i"] + j) for j in range(WINDOW)]).alias("w"), x["i"].alias("i")))))
    df = df.withColumn("m_twice", _twice("m_exact", "w"))
    return df.withColumn("m_starts", F.sort_array(F.transform("m_twice", lambda x: x["i"])))


def _covered() -> Column:
    starts = F.col("m_starts")
    each = F.transform(starts, lambda s, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column ``m`` of the counts the rules use."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("m_text", text)
    df = df.withColumn("m_words", words_of(F.col("m_text")))
    words = F.col("m_words")
    keys = F.transform(words, lambda w: F.xxhash64(w))
    df = df.withColumn("m_keys", keys)
    df = _repeats(df)
    df = df.withColumn("m_lines", F.filter(F.split("m_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = F.col("m_text")
    m = F.struct(
        _size(words).alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _chars(t, SYMBOLS).alias("n_symbols"),
        (F.size("m_lines") - F.size(F.array_distinct("m_lines"))).cast("long").alias("n_dup_lines"),
        _covered().alias("n_repeat_words"),
        _size(F.col("m_lines")).alias("n_lines"),
        _chars(t, r"[A-Z]").alias("n_upper"),
        _chars(t, r"[A-Za-z]").alias("n_letters"),
        _size(F.filter(words, lambda w: w.isin(list(dict.fromkeys(STOP_WORDS))))).alias("n_stop_words"),
    )
    # a generator: filters on the result aren't pushed below it, into the inputs of lambdas
    return df.select(*docs.columns, F.explode(F.array(m)).alias("m"))


def compile_rules(rules: list[tuple] = RULES) -> Column:
    """The threshold table as one expression: the names of the rules that a row fails."""
    def fails(measure, op: str, limit: int) -> Column:
        if isinstance(measure, tuple):
            left, right = F.lit(100) * F.col(f"m.{measure[0]}"), F.lit(limit) * F.col(f"m.{measure[1]}")
        else:
            left, right = F.col(f"m.{measure}"), F.lit(limit)
        return left < right if op == "<" else left > right

    return F.filter(F.array(*[F.when(fails(m, op, limit), F.lit(name)) for name, m, op, limit in rules]),
                    lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rules: list[tuple] = RULES) -> DataFrame:
    """Per row: id, the measures, ``failed`` (rule names) and ``kept``."""
    base = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))
    judged = measures(base, "text").withColumn("failed", compile_rules(rules))
    return judged.select(id_col, "m.*", "failed", (F.size("failed") == 0).alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(documents(spark, sf_dir, "doc_id", "text"))
    base = F.arrays_overlap("failed", F.array(*[F.lit(r) for r in BASE_RULES]))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept")


def _sql_rule(measure, op: str, limit: int) -> str:
    if isinstance(measure, tuple):
        return f"100 * {measure[0]} {op} {limit} * {measure[1]}"
    return f"{measure} {op} {limit}"


OP2_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w,
             generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
wc AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars,
              count(*) FILTER (w IN ({", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))})) AS n_stop_words
       FROM w GROUP BY r),
win AS (SELECT r, i, {" || ' ' || ".join(["w"] + [f"lead(w, {j}) OVER (PARTITION BY r ORDER BY i)" for j in range(1, 8)])} AS s
        FROM w),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win WHERE s IS NOT NULL) WHERE c > 1),
cov AS (SELECT r, sum(least(8, coalesce(nx - i, 8))) AS n_repeat_words
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM rep) GROUP BY r),
ln AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
lc AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM ln
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_stop_words, 0) AS n_stop_words,
             length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
             length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters
      FROM d LEFT JOIN wc USING (r) LEFT JOIN cov USING (r) LEFT JOIN lc USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({" OR ".join(_sql_rule(m, op, lim) for n, m, op, lim in RULES if n in BASE_RULES)}) AS base_failed,
       NOT ({" OR ".join(_sql_rule(m, op, lim) for _, m, op, lim in RULES)}) AS kept
FROM m
"""
