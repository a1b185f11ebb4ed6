"""Secret scans with multipart credential linking. DataFrame functions only.

Base kinds (``assign``, ``access``, ``hex``) stand on their own. The parts of a multipart
credential are weak alone: an ``identifier`` (user, client or key id), an ``endpoint`` (URL or
host) and a ``weak`` secret (a keyed value too short for ``assign`` or
of a weaker key, a long mixed run). They are reported only
where complementary parts lie within one scope: a secret within ``SCOPE`` characters of an
identifier or an endpoint, and those within ``SCOPE`` characters of a secret; base spans count
as parts too. Weak parts that overlap a base span are left out.

1. Texts are matched with one regular expression per kind; a match's place follows from the
   lengths of the pieces between matches. Matches become rows (key, kind, number, gap,
   length); running sums per key and kind give their places.
2. Interval join: per key, parts are ordered by place and each looks at the nearest end
   before and the nearest start after it of the other role. This needs one sort, and no
   pairs, however many parts a scope holds.
3. Spans are summed up per key and joined back to the rows. Keys are (id, hash of the text), so rows
   that repeat share them and are matched once; nothing else is shuffled but counts.

Defined cases: null and empty text: no spans (digest of the empty string); null ids are keys like
any other; repeated rows get the same result each; an empty table gives an empty result;
extra columns are not read. Places are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, written

SCOPE = 200


def _any(word: str) -> str:
    """A word in either case; (?i) would also match letters like the long s in some engines."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Kind, role (identifier, endpoint or secret), pattern, what a match needs to stand.
KINDS = [
    ("assign", "S", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "value8"),
    ("access", "I", r"AKIA[A-Z0-9]+", "length16"),
    ("hex", "S", r"[0-9a-f]+", "length32"),
    ("identifier", "I", rf"""(?:{_any("client")}_?{_any("id")}|{_any("access")}_?{_any("key")}_?{_any("id")}|{_any("user")}(?:{_any("name")})?|{_any("login")})["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{{3,}}""", "any"),
    ("endpoint", "E", rf"""(?:{_any("https")}|{_any("http")}|{_any("jdbc")}|{_any("s3")}|{_any("postgres")}|{_any("mysql")}|{_any("mongodb")}|{_any("redis")})://[^\x20\x09-\x0D"'<>]+|(?:{_any("host")}|{_any("endpoint")}|{_any("server")}|{_any("url")})["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.:/-]{{4,}}""", "any"),
    ("weak", "S", rf"""(?:{_any("pwd")}|{_any("pass")}|{_any("key")}|{_any("auth")}|{_any("credential")})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{4,}}|[A-Za-z0-9+/]{{40,}}""", "mixed"),
    # the keys of ``assign`` with shorter values, apart from the above so that neither hides a match of the other
    ("weak", "S", rf"""(?:{_any("password")}|{_any("passwd")}|{_any("secret")}|{_any("token")})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{4,7}}""", "any"),
]
BASE = 3


def _found(text: Column, number: int) -> Column:
    """Matches of one kind in a text: kind, n, gap before, length, ok."""
    _, _, pattern, need = KINDS[number]
    # runs shorter than 32 fail anyway, and maximal runs are disjoint
    pattern = r"[0-9a-f]{32,}" if need == "length32" else pattern
    rx = F.lit(pattern)
    value = F.regexp_extract_all(text, rx, F.lit(2)) if need == "value8" else F.regexp_extract_all(text, rx, F.lit(0))
    zipped = F.arrays_zip(F.regexp_extract_all(text, rx, F.lit(0)).alias("hit"), F.split(text, pattern, -1).alias("gap"), value.alias("value"))
    ok = {
        "value8": lambda x: F.char_length(x["value"]) >= 8,
        "length16": lambda x: F.char_length(x["hit"]) >= 16,
        "length32": lambda x: F.lit(True),
        "any": lambda x: F.lit(True),
        "mixed": lambda x: x["hit"].rlike("[:=]") | (x["hit"].rlike("[A-Z]") & x["hit"].rlike("[a-z]") & x["hit"].rlike("[0-9]")),
    }[need]
    rows = F.transform(F.filter(zipped, lambda x: x["hit"].isNotNull()), lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("n"), F.char_length(x["gap"]).alias("gap"),
        F.char_length(x["hit"]).alias("len"), ok(x).alias("ok")))
    none = F.array().cast("array<struct<kind:int,n:int,gap:int,len:int,ok:boolean>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as (doc_id, key), and the spans as (key, kind, start, end)."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(F.xxhash64("text")))
    found = F.concat(*[_found(F.col("text"), i) for i in range(len(KINDS))])
    rows = keyed.select("doc_id", key.alias("key"), found.alias("found"))
    rows = written(rows, "found")
    once = rows.filter(F.size("found") > 0).select("key", F.inline("found")).dropDuplicates(["key", "kind", "n"])
    upto = Window.partitionBy("key", "kind").orderBy("n")
    placed = once.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).withColumn("start", F.col("end") - F.col("len"))
    parts = placed.filter("ok").select("key", "kind", "start", "end")
    role = F.element_at(F.lit([k[1] for k in KINDS]), F.col("kind") + 1)
    secret, base = role == "S", F.col("kind") < BASE
    order = Window.partitionBy("key").orderBy("start", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def near(which: Column) -> Column:
        last = F.max(F.when(which, F.col("end"))).over(before)
        following = F.min(F.when(which, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= SCOPE, F.lit(False)) | F.coalesce(following - F.col("end") <= SCOPE, F.lit(False))

    clear = ~(F.coalesce(F.max(F.when(base, F.col("end"))).over(before) > F.col("start"), F.lit(False))
              | F.coalesce(F.min(F.when(base, F.col("start"))).over(after) < F.col("end"), F.lit(False)))
    parts = parts.withColumn("clear", base | clear).filter("clear")
    linked = parts.withColumn("reported", base | F.when(secret, near(~secret)).otherwise(near(secret)))
    return rows.select("doc_id", "key"), linked.filter("reported").select("key", "kind", "start", "end")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, spans (array of kind, start, end; by start, then kind)."""
    rows, found = spans(docs, id_col, text_col)
    ordered = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))  # one text's spans
    per_key = found.groupBy("key").agg(ordered.alias("s")).select("key", F.transform("s", lambda x: F.struct(
        F.element_at(F.lit([k[0] for k in KINDS]), x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.join(per_key, "key", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan(documents(spark, sf_dir, "doc_id", "text"))
    names = [k[0] for k in KINDS[:BASE]]

    def text(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"].isin(names))
    counts = [count(k) for k in names]
    return out.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def _sql() -> str:
    kinds = []
    for i, (_, _, pattern, need) in enumerate(KINDS):
        rx = "'" + pattern.replace("'", "''") + "'"
        ok = {"value8": f"length(regexp_extract(hit, {rx}, 2)) >= 8", "length16": "length(hit) >= 16", "length32": "length(hit) >= 32",
              "any": "true", "mixed": "regexp_matches(hit, '[:=]') OR (regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[0-9]'))"}[need]
        kinds.append(f"SELECT r, {i} AS kind, n, length(gap) AS gap, length(hit) AS len, ({ok}) AS ok FROM (SELECT r, "
                     f"unnest(regexp_extract_all(t, {rx})) AS hit, unnest(regexp_split_to_array(t, {rx})) AS gap, "
                     f"generate_subscripts(regexp_split_to_array(t, {rx}), 1) AS n FROM d) WHERE hit IS NOT NULL")
    roles = "[" + ", ".join(f"'{k[1]}'" for k in KINDS) + "]"
    names = "[" + ", ".join(f"'{k[0]}'" for k in KINDS) + "]"
    near = "(coalesce(start - max(end_) FILTER (WHERE {0}) OVER b <= {1}, false) OR coalesce(min(start) FILTER (WHERE {0}) OVER a - end_ <= {1}, false))"
    both = ("WINDOW b AS (PARTITION BY r ORDER BY start, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), "
            "a AS (PARTITION BY r ORDER BY start, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(kinds)}),
p AS (SELECT r, kind, end_ - len AS start, end_, kind < {BASE} AS base, {roles}[kind + 1] AS role
      FROM (SELECT *, sum(gap + len) OVER (PARTITION BY r, kind ORDER BY n) AS end_ FROM m) WHERE ok),
c AS (SELECT * FROM p {both} QUALIFY base OR NOT (coalesce(max(end_) FILTER (WHERE base) OVER b > start, false)
                                                  OR coalesce(min(start) FILTER (WHERE base) OVER a < end_, false))),
l AS (SELECT * FROM c {both}
      QUALIFY base OR CASE WHEN role = 'S' THEN {near.format("role <> 'S'", SCOPE)} ELSE {near.format("role = 'S'", SCOPE)} END),
s AS (SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
             count(*) FILTER (WHERE kind = 2) AS n_hex,
             string_agg({names}[kind + 1] || ':' || start::BIGINT || ':' || end_::BIGINT, ',' ORDER BY start, kind) FILTER (WHERE base) AS b,
             string_agg({names}[kind + 1] || ':' || start::BIGINT || ':' || end_::BIGINT, ',' ORDER BY start, kind) AS spans
      FROM l GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (r)
"""


OP6_SQL = _sql()
