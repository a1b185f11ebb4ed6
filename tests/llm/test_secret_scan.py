"""Op 6: base spans against re, linking against all pairs in plain Python."""

import random
import re

from wearline.llm.secret_scan import BASE, KINDS, SCOPE, secret_scan


def brute(text):
    text = text or ""
    parts = []
    for i, (_, role, pattern, need) in enumerate(KINDS):
        for m in re.finditer(pattern, text):
            hit = m.group()
            ok = {"value8": lambda: len(m.group(2)) >= 8, "length16": lambda: len(hit) >= 16, "length32": lambda: len(hit) >= 32,
                  "any": lambda: True, "mixed": lambda: bool(re.search("[:=]", hit)) or all(re.search(c, hit) for c in ("[A-Z]", "[a-z]", "[0-9]"))}[need]()
            if ok:
                parts.append((m.start(), i, m.end(), role))
    base = [p for p in parts if p[1] < BASE]
    parts = base + [p for p in parts if p[1] >= BASE and not any(b[0] < p[2] and p[0] < b[2] for b in base)]

    def linked(p):
        others = [q for q in parts if (q[3] == "S") != (p[3] == "S")]
        return any(q[0] - p[2] <= SCOPE and p[0] - q[2] <= SCOPE for q in others)

    return sorted((s, k, e) for s, k, e, r in parts if k < BASE or linked((s, k, e, r)))


def test_equals_plain_python(spark):
    rng = random.Random(4)
    bits = ["user=alice", "login: bob@x", "https://db.example.com/x", "host = 10.0.0.1:5432", "pass=ab12", "key: zzzz", "AKIA" + "A1B2" * 4,
            "AKIA12", 'PassWord = "hunter2hunter2"', "token=abc", "secret: api_key = abcdefghij", "0123456789abcdef" * 3, "Ab1" * 15,
            "ſecret=abcdefgh12", "é😀 ü", "word " * 30, "\n", "x" * 250, "apikey='A/b+c=d-e.f_g'"]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(0, 14)))) for i in range(300)]
    rows += [(5, None), (None, "token=abcdefgh1"), (7, "user=al " * 3000 + "pass=abcd1"), (8, ""), (9, "token=abcdefgh1"), (9, "token=abcdefgh1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'x' as found").repartition(4)
    got = sorted((str(r["doc_id"]), [(s["start"], s["kind"], s["end"]) for s in r["spans"]]) for r in secret_scan(df).collect())
    want = sorted((str(i), [(s, KINDS[k][0], e) for s, k, e in brute(t)]) for i, t in rows)
    assert got == want
    assert any(s[1] == "weak" for _, ss in got for s in ss)
    assert secret_scan(df.limit(0)).count() == 0


def test_common_multipart_credentials(spark):
    rows = [("user=admin password=hunter2 host=db1.local", ["identifier", "weak", "endpoint"]),
            ("DB_USER=root\nDB_PASS=s3cr\nDB_HOST=10.0.0.1", ["identifier", "weak", "endpoint"]),
            ("LOGIN: joe\nTOKEN=ab12c", ["identifier", "weak"]), ("Url = db.local passwd: \'abcd\'", ["endpoint", "weak"]),
            ("HTTPS://db.local/x SECRET=abcdefg", ["endpoint", "weak"]), ("PWD=abcd USERNAME=abc", ["weak", "identifier"]),
            ("API_KEY=abcd CLIENT_ID=abc", ["weak", "identifier"]), ("user=al password=abcdefgh1", ["assign"]),
            ("user=alice password=abcdefgh1", ["identifier", "assign"]), ("password=hunter2 alone", []), ("user=alice token=abc", []),
            ("user=alice secret: api_key = abcdefghij", ["identifier", "weak", "weak"])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secret_scan(df).collect()}
    assert got == {i: k for i, (_, k) in enumerate(rows)}
