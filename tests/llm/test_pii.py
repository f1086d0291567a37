import re

from pyspark.sql import functions as F

from platewise.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def valid(kind, m):
    digits = [int(c) for c in m if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        odd = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
        return 12 <= len(digits) <= 19 and (sum(digits[-1::-2]) + sum(odd)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_base(text):
    out = [(m.start(), i, m.end()) for i, (k, r) in enumerate(BASE.items()) for m in re.finditer(r, text or "") if valid(k, m[0])]
    return [(a, b, i) for a, i, b in sorted(out)]


HARD = ["a@b.c_d@e.f x@y.zz@q.com", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004 0000255.1.1.1 1.2.3.99999999999999999999",
        "4111 1111-1111 1111  4111111111111111 41111111111111111111111", "+1 (555) 123-4567. +49.30.1234567 +12 +1234567890123456",
        "+1 4111 1111 1111 1111", "é\U0001f642 a@b.de 中 10.0.0.1", "9" * 3000, "a" * 5000 + "@", "1-" * 4000, "+1" + " " * 3000,
        "@a.b a@.b a@b a@b. .@-.-", "+1(5)5", "x" * 300 + "12345@" + "y" * 300 + " card", "..." + "1234567" + "..." + " next"]


def test_spans_equal_brute_force(spark, docs_rows):
    from .test_pii_groups import brute

    # base formats teach "customer", "member" and the word behind; the context then finds other numbers
    teach = [f"dear customer 10.0.0.{k} bought on paid member u{k}@mail.org wrote" for k in range(12)]
    unseen = ["dear customer 77.88.99.1x said", "dear customer 300.20.30.400 bought", "the member zz91@mail said zz91@mail wrote",
              "order 1234567 shipped"]
    rows = docs_rows + [(5 * 10**6 + i, t) for i, t in enumerate(HARD + teach + unseen)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("cand", F.lit(2))
    got = {r.doc_id: r for r in pii.find(df).collect()}
    want, context = brute(rows), 0
    assert len(got) == len(rows)
    for i, t in rows:
        assert [tuple(s) for s in got[i].base] == brute_base(t), t[:200]
        assert [tuple(s) for s in got[i].spans] == want[i], t[:200]
        context += sum(s[2] == 4 for s in want[i])
    assert context >= 1 and any(s[2] == 4 for s in want[5 * 10**6 + len(HARD + teach) + 1])


def test_text_and_mask(spark):
    text = "é 4111 1111 1111 1111, 10.0.0.1 a@b.de"
    df = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    r = df.select(pii.as_text(F.col("spans")).alias("t"), pii.mask(F.lit(text), F.col("spans")).alias("m")).first()
    want = brute_base(text)
    assert r.t == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in want) and "card" in r.t
    assert r.m == "é <CARD>, <IP> <EMAIL>"


def test_null_ids_repeats_and_empty(spark):
    rows = [(None, "10.0.0.1"), (1, "10.0.0.1"), (1, "10.0.0.1"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, len(r.base), len(r.spans)) for r in pii.find(df).collect())
    assert got == [(0, 1, 1), (1, 1, 1), (1, 1, 1), (2, 0, 0), (3, 0, 0)]
    assert pii.find(df.limit(0)).count() == 0
