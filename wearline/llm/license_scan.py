"""License scans: a trained paragraph classifier with template confirmation. DataFrame functions and Spark ML only.

A paragraph is what lies between blank lines (lines without a letter or digit, so bare comment marks too); its lines
are joined. It is scanned as a whole, for notices wrapped over lines, and line by line, for several notices in one
paragraph. Features are the word pairs (n-grams of two) that occur in any template, present or not; the pairs are
looked up in literal tables of a fixed size. Punctuation is no part of a word, so comment marks go; ``rem`` and
``dnl`` at the start of a line go too.

1. Paragraphs without ``CONFIRM`` percent of the pairs of any template are left out: no line of theirs has more.
2. Training rows: templates, alone, with surrounding words and in halves, by licence
   family; the class ``unknown`` is learned from everyday sentences about licences and from all
   lines of the corpus, without those of step 1's paragraphs; these lines together weigh ``CORPUS_WEIGHT`` rows at most.
3. Sparse multinomial logistic regression (L1) in Spark ML; its weights (pairs x families) enter
   one projection as literals.
4. Calibration, by family: a prediction counts only if its probability is above the ``QUANTILE`` of that family's
   among the held-back ``unknown`` rows, the corpus's by their number (0 for rows predicted otherwise) and above one half; all else is ``unknown``.
5. Confirmation: a predicted paragraph or line must hold ``CONFIRM`` percent of the pairs of a template of that family.
6. Confirmed ones (few) are summed up by (id, hash of the text) and joined back to all rows. A whole paragraph has its
   first line's number and counts only where none of its lines has the same family.

Defined cases: null and empty texts have no licence; repeated rows share their result; null ids are kept;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written

UNKNOWN = "unknown"
SLOTS = 1 << 16
CORPUS_WEIGHT = 2_000
CONFIRM = 60
QUANTILE = 0.99
#: Line numbers are marked with private-use digits, which are no words, letters or digits.
DIGITS, MARKED, END = "0123456789", "".join(chr(0xE000 + i) for i in range(10)), "\uE00A"
BLANK = r"(?:^|\n)[^\p{L}\p{N}\n]*(?=\n|\z)"
WORDS = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Short notices of licence families.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited."),
]
#: Sentences that are no notices.
EVERYDAY = [
    "The driver had lost a license and was fined under the new law.",
    "A fishing license is issued under the terms of the state act.",
    "The software is free of charge for any person who asks the office for a copy of it.",
    "You may not use this file to store a version of the report.",
    "This work is about the general public and the terms of the treaty, version 3 of the draft.",
    "The conditions are met with or without the help of the author.",
    "Version 2.0 of the program was released under the name of the founder.",
    "The library is open to the public and the source of the river is near.",
    "Copying of this kind is common and the rights of the artist are related to the work.",
    "The committee released the report into the public domain of debate.",
    "He was granted permission to use the hall for any purpose.",
    "Either version of the story is possible under the law.",
]
CONTEXT = ["copyright 2021 the authors", "see the file for details", "notice", "all contributors", "the text below", "end of page"]


def pairs_of(text: str) -> list[str]:
    w = re.findall(WORDS, text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:], strict=False)))


FEATURES = list(dict.fromkeys(p for _, t in TEMPLATES for p in pairs_of(t)))
FAMILIES = [UNKNOWN, *dict.fromkeys(f for f, _ in TEMPLATES)]


def _constant(values: list, kind: str) -> Column:
    """A literal array: one string that the optimizer cuts and casts once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _training() -> tuple[list[tuple[str, int, bool]], list[tuple[str, int, bool]]]:
    """(text, class, held back) rows of notices and of everyday sentences."""
    known = []
    for family, t in TEMPLATES:
        c, words = FAMILIES.index(family), t.split()
        half = len(words) // 2
        known += [(t, c, False)] * 4 + [(f"{a} {t} {b}", c, False) for a in CONTEXT for b in CONTEXT if a != b][::4]
        if len(words) > 12:
            known += [(" ".join(words[:half + 4]), c, False), (" ".join(words[half - 4:]), c, False)]
    return known, [(t, 0, i % 3 == 0) for i, t in enumerate(EVERYDAY)] * 4


def _found(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``lines`` (with a column ``line``) with ``f``: sorted numbers (from 1) of the features present."""
    slots = spark.createDataFrame([(p,) for p in FEATURES], "p string").select(
        "p", F.pmod(F.xxhash64("p"), F.lit(SLOTS)).alias("slot")).collect()  # as many as FEATURES
    held: list[list[str]] = []
    table = [0] * SLOTS
    numbers = {p: i + 1 for i, p in enumerate(FEATURES)}
    for r in slots:  # a slot leads to the features that share it
        if not table[r["slot"]]:
            held.append([])
            table[r["slot"]] = len(held)
        held[table[r["slot"]] - 1].append(r["p"])
    slot_of, names = _constant(table, "int"), _constant(FEATURES, "string")
    first = _constant([numbers[h[0]] for h in held], "int")
    second = _constant([numbers[h[1]] if len(h) > 1 else 0 for h in held], "int")
    assert all(len(h) < 3 for h in held)
    df = lines.withColumn("w", F.regexp_extract_all(F.lower("line"), F.lit(WORDS), F.lit(0)))
    df = df.withColumn("p", F.transform("w", lambda w, i: F.concat(w, F.lit(" "), F.coalesce(F.get(F.col("w"), i + 1), F.lit("")))))
    # (pair, slot's list) for pairs whose slot is taken, then the feature whose name the pair is
    near = F.filter(F.transform("p", lambda p: F.struct(p.alias("p"), F.get(slot_of, F.pmod(F.xxhash64(p), F.lit(SLOTS)).cast("int")).alias("s"))),
                    lambda x: x["s"] > 0)
    df = df.withColumn("near", near)
    which = F.transform("near", lambda x: F.when(F.get(names, F.get(first, x["s"] - 1) - 1) == x["p"], F.get(first, x["s"] - 1))
                        .when(F.get(names, F.get(second, x["s"] - 1) - 1) == x["p"], F.get(second, x["s"] - 1)))
    df = df.withColumn("f", F.array_sort(F.array_distinct(F.filter(which, lambda x: x.isNotNull()))))
    return df.drop("w", "p", "near")


def _shares(of: Column | None = None) -> list[Column]:
    """Percent of each template's pairs among ``f``; with ``of``, only of templates of that class."""
    number = {p: i + 1 for i, p in enumerate(FEATURES)}
    shares = [100 * F.size(F.array_intersect("f", _constant([number[p] for p in pairs_of(t)], "int"))) / F.lit(len(pairs_of(t)))
              for _, t in TEMPLATES]
    return shares if of is None else [F.when(of == FAMILIES.index(family), s) for (family, _), s in zip(TEMPLATES, shares, strict=True)]


def _paragraphs(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) by paragraph: ``paragraph``, whose lines each begin with their marked number."""
    text = F.regexp_replace("text", r"(?i)(?<![^\n])[ \t]*(?:rem|dnl)(?=[ \t])", "")
    marked = F.transform(F.split(text, "\n", -1), lambda x, i: F.concat(F.translate(i.cast("string"), DIGITS, MARKED), F.lit(END), x))
    others = [c for c in rows.columns if c != "text"]
    return rows.select(*others, F.explode(F.split(F.array_join(marked, "\n"), BLANK, -1)).alias("paragraph")).filter("paragraph != ''")


def _lines(paragraph: Column) -> Column:
    return F.filter(F.split(paragraph, "\n"), lambda x: x != "")


def _unmarked(line: Column) -> Column:
    return F.regexp_replace(line, f"^[{MARKED}]+{END}", "")


def _only(df: DataFrame, test) -> DataFrame:
    """Rows that pass ``test``, as a generator: a filter would be pushed below the columns it reads and compute
    them again inside their lambdas, once per element."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.explode(F.filter(F.array(row), test)).alias("only")).select("only.*")


class Model:
    """Weights by family and feature, and the thresholds above which the families count."""

    def __init__(self, weights: list[list[float]], bias: list[float], thresholds: list[float]):
        self.weights, self.bias, self.thresholds = weights, bias, thresholds

    def logits(self) -> Column:
        def one(w: list[float], b: float) -> Column:
            table = _constant(w, "double")
            return F.aggregate("f", F.lit(b), lambda a, x: a + F.get(table, x - 1))

        return F.array(*[one(w, b) for w, b in zip(self.weights, self.bias, strict=True)])

    def score(self, found: DataFrame) -> DataFrame:
        """Adds ``best`` (class number) and ``p`` (its probability)."""
        df = found.withColumn("z", self.logits())
        df = df.withColumn("e", F.transform("z", lambda x: F.exp(x - F.array_max("z"))))
        df = df.withColumn("best", F.array_position("z", F.array_max("z")) - 1)
        return df.withColumn("p", F.lit(1.0) / F.aggregate("e", F.lit(0.0), lambda a, x: a + x)).drop("z", "e")


def _read(spark: SparkSession, paragraphs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass over the paragraphs: the lines of those without a notice, for ``fit``, and the others.

    Only the features of a line count there, so lines with the same features are one row (f, held) with their number.
    The others are rows of doc_id, key and paragraph.
    """
    lines = F.filter(F.transform(_lines(F.col("paragraph")), _unmarked), lambda x: (F.char_length(x) > 0) & ~x.rlike(
        "(?i)licen[cs]|copyright|redistribut|spdx|cc ?by|public domain|rights"))
    # of the whole paragraph: a line may hold just a part of its notice
    found = _found(spark, paragraphs.withColumn("line", F.col("paragraph")))
    notice = (F.size("f") > 1) & (F.greatest(*_shares()) >= CONFIRM)
    found = found.select("doc_id", "key", "paragraph", notice.alias("notice"))
    none = F.lit(None)
    whole = F.struct(F.col("doc_id").alias("doc_id"), F.col("key").alias("key"), F.col("paragraph").alias("paragraph"), F.lit("").alias("line"))
    plain = F.transform("lines", lambda x: F.struct(none.cast(found.schema["doc_id"].dataType).alias("doc_id"), none.cast("long").alias("key"),
                                                    none.cast("string").alias("paragraph"), x.alias("line")))
    # the lines of a notice's paragraph are left out of the training rows, and not cut
    found = found.withColumn("lines", F.when(~F.col("notice"), lines).otherwise(F.array().cast("array<string>")))
    # the outer form: for the plain one the optimizer adds a test of the array, which computes all of it again
    units = found.select(F.explode_outer(F.when(F.col("notice"), F.array(whole)).otherwise(plain)).alias("unit")).filter("unit IS NOT NULL").select("unit.*")
    units = _found(spark, units.withColumn("held", F.pmod(F.xxhash64("line"), F.lit(3)) == 0))
    both = units.groupBy("doc_id", "key", "paragraph", "f", "held").agg(F.count(F.lit(1)).alias("n"))
    both = written(both, "licence-paragraphs")
    return both.filter("paragraph IS NULL").select("f", "held", "n"), both.filter("paragraph IS NOT NULL").select("doc_id", "key", "paragraph")


def fit(spark: SparkSession, sample: DataFrame) -> Model:
    """Train on the templates, everyday sentences and all lines of the corpus that hold no notice (``sample``, see ``_read``).

    All lines together weigh as much as ``CORPUS_WEIGHT`` rows, so the classes' balance does not hang on the corpus's size.
    """
    known, everyday = _training()
    fixed = _found(spark, spark.createDataFrame(known + everyday, "line string, y int, held boolean").coalesce(1))
    fixed = fixed.groupBy("f", "y", "held").agg(F.count(F.lit(1)).alias("n")).withColumn("weight", F.col("n").cast("double"))
    sample = written(sample, "licence-lines")
    total = sample.agg(F.sum("n")).first()[0] or 0
    sample = sample.select("f", F.lit(0).alias("y"), "held", "n", (F.col("n") * F.lit(min(1.0, CORPUS_WEIGHT / max(1, total)))).alias("weight"))
    rows = fixed.select("f", "y", "held", "n", "weight").unionByName(sample)
    rows = written(rows, "licence-training")
    vector = array_to_vector(F.transform(F.sequence(F.lit(1), F.lit(len(FEATURES))),
                                         lambda i: F.array_contains("f", i).cast("double")))
    train = rows.filter("NOT held").select(vector.alias("features"), F.col("y").cast("double").alias("label"), "weight")
    lr = LogisticRegression(family="multinomial", weightCol="weight", regParam=2e-4, elasticNetParam=1.0, maxIter=60, standardization=False)
    got = lr.fit(train.cache())
    train.unpersist()
    model = Model(got.coefficientMatrix.toArray().tolist(), [float(x) for x in got.interceptVector], [0.5] * len(FAMILIES))
    scored = model.score(rows.filter("held AND y = 0"))
    high = scored.agg(*[F.percentile(F.when(F.col("best") == i, F.col("p")).otherwise(0.0), F.lit(QUANTILE), F.col("n")) for i in range(len(FAMILIES))]).first()
    model.thresholds = [max(0.5, x or 0.0) for x in high]
    return model


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and licences, an array of (line number, family, p, share of a template in percent)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))
    sample, found = _read(spark, _paragraphs(rows))
    model = fit(spark, sample)
    number = F.translate(F.regexp_extract("line", f"^\n?([{MARKED}]+){END}", 1), MARKED, DIGITS).cast("int")
    whole = F.when(F.size(_lines(F.col("paragraph"))) > 1, F.array("paragraph")).otherwise(F.array().cast("array<string>"))
    units = F.concat(F.transform(_lines(F.col("paragraph")), lambda x: F.struct(x.alias("line"), F.lit(False).alias("whole"))),
                     F.transform(whole, lambda x: F.struct(x.alias("line"), F.lit(True).alias("whole"))))
    first = F.regexp_extract("paragraph", f"^\n?([{MARKED}]+){END}", 1)
    units = found.select("doc_id", "key", first.alias("first"), F.explode(units).alias("unit")).select("doc_id", "key", "first", "unit.*")
    units = units.withColumn("line_no", number)
    scored = _only(model.score(_found(spark, units)), lambda x: (x["best"] > 0) & (x["p"] > F.get(F.lit(model.thresholds), x["best"].cast("int"))))
    scored = scored.withColumn("share", F.greatest(*_shares(F.col("best")))).filter(F.col("share") >= CONFIRM)
    family = F.get(F.lit(FAMILIES), F.col("best").cast("int"))
    confirmed = scored.select("doc_id", "key", "first", "whole", F.struct("line_no", family.alias("family"), "p", "share").alias("x"))
    # of a paragraph and its lines, per family: the lines, else the paragraph
    confirmed = confirmed.groupBy("doc_id", "key", "first", F.col("x.family")).agg(
        F.collect_set(F.when(~F.col("whole"), F.col("x"))).alias("lines"), F.collect_set(F.when(F.col("whole"), F.col("x"))).alias("all"))
    confirmed = confirmed.select("doc_id", "key", F.explode(F.when(F.size("lines") > 0, F.col("lines")).otherwise(F.col("all"))).alias("x"))
    per_text = confirmed.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("x")).alias("licences"))  # one text's lines
    per_text = per_text.select(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key"), "licences")
    out = rows.select("doc_id", "key").join(per_text, F.col("key").eqNullSafe(F.col("r_key")) & F.col("doc_id").eqNullSafe(F.col("r_id")), "left")
    none = F.array().cast(per_text.schema["licences"].dataType)
    return out.select("doc_id", F.coalesce("licences", none).alias("licences"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", F.size("licences").cast("long").alias("n_licences"),
                      F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",").alias("families"), "licences")
