"""Op 9 on notices planted between other lines, and its defined cases."""

import re

from wearline.llm import queries
from wearline.llm.license_scan import license_scan

NOTICES = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
           "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
           "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}


def test_query_finds_the_planted_notices(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    want = {r["doc_id"]: {f for n, f in NOTICES.items() if n in r["text"]} for r in docs}
    got = queries.REGISTRY["op9_license_scan"](spark, sf_small).collect()
    assert {r["doc_id"]: set(filter(None, r["families"].split(","))) for r in got} == want
    assert all(bool(re.search("[Ll]icen[cs]e", t["text"])) == bool(want[t["doc_id"]]) for t in docs)


def test_defined_cases(spark):
    rows = [(1, "Intro\nThis program is released under the MIT license, see below.\n\nBye"), (2, None), (3, ""), (4, "A fishing license is a license."),
            (5, "x\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0\nlicensed under cc by-sa 4.0"), (6, "of the " * 20_000),
            (1, "Intro\nThis program is released under the MIT license, see below.\n\nBye"), (None, "SPDX-License-Identifier: GPL-2.0-only"),
            (8, "Das ist unter der Lizenz.\nThe terms of the treaty, version 3 of the draft.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as line", "2 as f", "3 as p")
    got = sorted(((r["doc_id"], [(x["line_no"], x["family"]) for x in r["licences"]]) for r in license_scan(df).collect()), key=str)
    assert got == sorted([(1, [(1, "MIT")]), (1, [(1, "MIT")]), (2, []), (3, []), (4, []), (5, [(1, "Apache-2.0"), (2, "CC-BY-SA")]), (6, []),
                          (None, [(0, "GPL-2.0")]), (8, [])], key=str)
    assert license_scan(df.limit(0)).count() == 0


def test_grants_among_the_sampled_lines_are_no_unknown_text(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, item "
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, item "
    rows = [(i, (mit if i % 2 else isc) + str(i)) for i in range(40)] + [(100, "Licensed under CC BY 4.0."), (101, "The end of the story.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [x["family"] for x in r["licences"]] for r in license_scan(df).collect()}
    assert got == {i: ["MIT" if i % 2 else "ISC"] for i in range(40)} | {100: ["CC-BY"], 101: []}


WRAPPED = [
    ("BSD", "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:"),
    ("GPL-3.0", "/*\n * This program is free software: you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n"
                " * as published by the Free Software Foundation, either version 3\n * of the License, or any later version.\n */"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this\r\nsoftware for any purpose with or without fee is\r\nhereby granted, provided"),
    ("MIT", "dnl Permission is hereby granted, free of charge, to any\ndnl person obtaining a copy of this software\ndnl and associated documentation files, to deal"),
]


def test_notices_wrapped_over_lines(spark):
    rows = [(i, "Intro of the text\n \t\n" + t + "\n\nThe end of it.", f) for i, (f, t) in enumerate(WRAPPED)]
    df = spark.createDataFrame(rows, "doc_id long, text string, family string")
    got = {r["doc_id"]: [(x["line_no"], x["family"]) for x in r["licences"]] for r in license_scan(df).collect()}
    assert got == {i: [(3 if t.startswith("/*") else 2, f)] for i, (f, t) in enumerate(WRAPPED)}


def test_the_fit_learns_from_all_lines(spark, monkeypatch):
    from wearline.llm import license_scan as L

    kept, real = {}, L.written
    monkeypatch.setattr(L, "written", lambda df, name, *by: kept.setdefault(name, real(df, name, *by)))
    rows = [(i, f"The end of the story.\nItem {i} of the list.\n\nx{i}") for i in range(3000)] + [(9000, "SPDX-License-Identifier: MIT\nMore of it.")]
    license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert kept["licence-lines"].agg({"n": "sum"}).first()[0] == 9000  # the line beside the notice is left out
    assert abs(kept["licence-training"].filter("y = 0 AND n > 100").agg({"weight": "sum"}).first()[0] - L.CORPUS_WEIGHT) < 1


def test_the_texts_are_cut_once(spark, monkeypatch):
    from wearline.llm import license_scan as L

    cut, real = [], L.written
    monkeypatch.setattr(L, "written", lambda df, name, *by: (cut.append((name, "rem|dnl" in df._jdf.queryExecution().optimizedPlan().toString())), real(df, name, *by))[1])
    rows = [(1, "Released under the MIT License.\n\nThe end of the story."), (1, "Released under the MIT License.\n\nThe end of the story."), (None, "x")]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [name for name, cuts in cut if cuts] == ["licence-paragraphs"]  # training and scan read what this step wrote
    assert "rem|dnl" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((str(r["doc_id"]), [x["family"] for x in r["licences"]]) for r in got.collect()) == [("1", ["MIT"]), ("1", ["MIT"]), ("None", [])]
