"""Language ID: a byte convolutional network, trained and applied with numpy.

Bytes of the lower-cased UTF-8 text are embedded; filters of several widths slide over a
window of fixed length, their maxima go through a rectifier into a softmax. A text's score
per language is the mean over all its windows, weighted by their bytes.

Training: windows from a bounded sample of labelled rows (``SAMPLE_DOCS`` a language,
``SAMPLE_WINDOWS`` windows each, taken at hashed places over the whole text) are collected
and fitted on the driver with Adam; the model (a few thousand numbers) is broadcast.
Prediction: every window of every whole text, in batches of fixed size, so memory
doesn't follow the length of a text. It sees the text only.

Defined cases: null text, or text without a letter: ``und`` with score 0; nothing to learn
from: ``und`` with score 0; null labels or ids aren't learned from; rows that repeat are
predicted alike; ties go to the first language in code-point order; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import documents, python_ready

WINDOW = 256
DIM = 6
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 3
EPOCHS = 8
BATCH = 128
UNKNOWN = "und"
FOLDS, HELD_OUT = 5, 0


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _windows(text: str) -> np.ndarray:
    """Rows of WINDOW bytes that cover the whole text; the last one is filled with zeros."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros((max(1, -(-len(raw) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[:len(raw)] = raw
    return out


class ByteNet:
    """Embedding, filters of several widths, maximum over places, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"e": rng.normal(0, 0.5, (256, DIM)), "u": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))),
                  "c": np.zeros(len(languages))}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        e = self.p["e"][x]
        tops, places = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            patches = np.concatenate([e[:, j:j + n] for j in range(w)], axis=2)
            r = (patches.reshape(-1, w * DIM) @ self.p[f"w{w}"]).reshape(len(x), n, FILTERS)
            at = r.argmax(axis=1)
            places.append(at)
            tops.append(np.take_along_axis(r, at[:, None], 1)[:, 0] + self.p[f"b{w}"])
        return np.concatenate(tops, axis=1), places

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for lo in range(0, len(x), BATCH):
            e = self.p["e"][x[lo:lo + BATCH]]
            tops = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                patches = np.concatenate([e[:, j:j + n] for j in range(w)], axis=2)
                r = (patches.reshape(-1, w * DIM) @ self.p[f"w{w}"]).reshape(len(e), n, FILTERS)
                tops.append(r.max(axis=1) + self.p[f"b{w}"])
            z = np.maximum(np.concatenate(tops, axis=1), 0) @ self.p["u"] + self.p["c"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        top, places = self._pooled(x)
        h = np.maximum(top, 0)
        z = h @ self.p["u"] + self.p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g = {"u": h.T @ d, "c": d.sum(axis=0), "e": np.zeros_like(self.p["e"])}
        dh = (d @ self.p["u"].T) * (top > 0)
        for i, w in enumerate(WIDTHS):
            dw = dh[:, i * FILTERS:(i + 1) * FILTERS]
            spot = places[i][:, :, None] + np.arange(w)  # sample, filter, offset
            chars = x[np.arange(len(x))[:, None, None], spot]
            patch = self.p["e"][chars].reshape(len(x), FILTERS, w * DIM)
            g[f"w{w}"] = np.einsum("nf,nfk->kf", dw, patch)
            g[f"b{w}"] = dw.sum(axis=0)
            back = dw[:, :, None] * self.p[f"w{w}"].T[None]
            np.add.at(g["e"], chars.reshape(-1), back.reshape(-1, DIM))
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 11) -> ByteNet:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(p) for k, p in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 64):
                step += 1
                part = order[lo:lo + 64]
                for k, g in self.gradients(x[part], y[part]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (0.004 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> ByteNet | None:
    """Fit on a bounded, hashed sample of the labelled rows outside the held-out fold."""
    base = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"),
                       F.col(lang_col).cast("string").alias("y"))
    base = base.filter(F.col("y").isNotNull() & (F.crc32("i") % FOLDS != HELD_OUT))
    counts = {r["y"]: r["count"] for r in base.groupBy("y").count().collect()}  # of learnable rows only; reads no text
    base = base.filter(F.col("t").rlike(r"\p{L}"))
    if not counts:
        return None
    share = F.coalesce(*[F.when(F.col("y") == y, F.lit(2.0 * SAMPLE_DOCS / n)) for y, n in sorted(counts.items())])
    place = F.pmod(F.xxhash64("i"), F.lit(1 << 20))
    starts = [F.substr("t", (F.lit(1) + F.floor(F.greatest(F.char_length("t") - WINDOW, F.lit(0)) * k / max(1, SAMPLE_WINDOWS - 1))).cast("int"),
                       F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)]
    rows = (base.filter(place < share * (1 << 20)).select("y", F.xxhash64("i", F.lit(1)).alias("h"), F.array(*starts).alias("w"))
            .orderBy("h", "w").limit(2 * SAMPLE_DOCS * len(counts)).collect())
    held: dict[str, list] = {}
    for r in rows:
        part = held.setdefault(r["y"], [])
        if len(part) < SAMPLE_DOCS:
            part.append(r["w"])
    languages = sorted(held)
    if not languages:
        return None
    x = [(_windows(w)[0], i) for i, y in enumerate(languages) for ws in held[y] for w in dict.fromkeys(ws)]
    net = ByteNet(languages)
    return net.fit(np.stack([a for a, _ in x]), np.array([i for _, i in x])) if len(languages) > 1 else net


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: ByteNet | None = model.value
        for b in batches:
            langs, scores = [UNKNOWN] * b.num_rows, [0.0] * b.num_rows
            held, owner, weight, n_held = [], [], [], 0
            total = np.zeros((b.num_rows, len(net.languages) if net else 0))

            def flush():
                np.add.at(total, np.concatenate(owner), net.probabilities(np.concatenate(held)) * np.concatenate(weight)[:, None])
                held.clear(), owner.clear(), weight.clear()

            column = b.column(b.num_columns - 1)
            for i in range(b.num_rows if net else 0):
                text = column[i].as_py()
                if not text or not any(map(str.isalpha, text)):
                    continue
                x = _windows(text)
                n = len(text.lower().encode("utf-8", "surrogatepass"))
                w = np.full(len(x), float(WINDOW))
                w[-1] = n - WINDOW * (len(x) - 1)
                held.append(x)
                owner.append(np.full(len(x), i))
                weight.append(w / n)
                langs[i] = ""
                n_held += len(x)
                if n_held >= 4096:
                    flush()
                    n_held = 0
            if held:
                flush()
            for i, lang in enumerate(langs):
                if lang == "":
                    best = int(total[i].argmax())
                    langs[i], scores[i] = net.languages[best], float(min(1.0, total[i][best]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs), pa.array(scores)], [*b.schema.names[:-1], "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: ByteNet | None, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, and lang_pred and score (replacing columns of these names)."""
    spark = docs.sparkSession
    python_ready(spark)
    keep = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    given = docs.select(*keep, F.col(text_col).cast("string").alias(text_col))
    kept = [f for f in given.schema.fields if f.name != text_col]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return given.mapInArrow(_predict(spark.sparkContext.broadcast(model)), schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: id, held_out, lang_pred, score."""
    model = train(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return identify(rows, model)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir, "doc_id", "text", "lang"))
