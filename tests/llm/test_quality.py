import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from platewise.llm import quality_model, quality_rules

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    text = text or ""
    w = WORD.findall(text)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(wins)
    covered = {i + o for i, x in enumerate(wins) if count[x] > 1 for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum("A" <= c <= "Z" for c in text), len(lines),
            len(lines) - len(set(lines)), len(covered))


def test_stats_equal_brute_force(spark, docs, docs_rows):
    texts = dict(docs_rows)
    got = quality_rules.text_stats(docs.select("doc_id", "text", "lang")).collect()
    assert len(got) == len(docs_rows)
    for r in got:
        assert tuple(r[c] for c in quality_rules.STATS) == brute_stats(texts[r.doc_id]), r.doc_id


def test_rules_equal_sql(spark):
    got = quality_rules.judge(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")), alpha=0.05)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    want = con.sql(quality_rules.oracle(alpha=0.05))
    assert sorted(got.columns) == sorted(want.columns)
    rows = sorted(tuple(r) for r in got.select(*want.columns).collect())
    assert rows == sorted(want.fetchall())
    assert any(r[want.columns.index("cut_symbols")] for r in rows)


def test_binomial_tail(spark):
    cases = [(n, k) for n in (1, 5, 60, 1000, 20000) for k in (0, 1, 3, 40, 150) if k <= n]
    df = spark.createDataFrame(cases, "n long, k long")
    for terms in (4096, 20):
        for r in df.select("n", "k", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.01, terms).alias("p")).collect():
            exact = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1)
                                 + i * math.log(0.01) + (r.n - i) * math.log(0.99)) for i in range(r.k + 1))
            if r.k >= r.n * 0.01:
                assert r.p == 1.0
            elif r.k <= terms:
                assert math.isclose(r.p, exact, rel_tol=1e-9)
            else:
                assert exact * (1 - 1e-9) <= r.p <= exact * 1.05


def test_rules_without_labels_nulls_and_empty(spark, docs):
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, quality int")
    got = quality_rules.judge(docs, labels).collect()
    assert all(r.kept == (not r.base_failed) and r.cut_symbols is None for r in got)
    assert quality_rules.judge(docs.limit(0), labels.limit(0)).count() == 0


def test_model_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.withColumn("x", F.lit("clash"))
    model = quality_model.train(docs.select("doc_id", "text"), labels)
    known = docs.join(labels, "doc_id").where(quality_model.held_out("doc_id"))
    rows = quality_model.score(known, model).select("doc_id", "quality", "quality_score", "x").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows) and len(rows) > 500
    good, bad = ([r.quality_score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert np.mean([s >= 0.7 for s in good]) > 0.99 and np.mean([s < 0.7 for s in bad]) > 0.95


def test_model_cases(spark, docs, docs_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.quality_score > 0.99 for r in quality_model.score(docs, quality_model.train(docs, none)).collect()} == {True}
    bad = spark.createDataFrame([(r[0], 0) for r in docs_rows], "doc_id long, quality int")
    assert {r.quality_score < 0.01 for r in quality_model.score(docs, quality_model.train(docs, bad)).collect()} == {True}
    assert quality_model.score(docs.limit(0), quality_model.train(docs, none)).count() == 0
    x = quality_model.features(["", None, "A b!! b b\nA b!! b b\n"])
    assert not x[:2].any() and np.isfinite(x).all() and len(x[0]) == len(quality_model.FEATURES)
    assert quality_model.features([]).shape == (0, len(quality_model.FEATURES))


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(x, y)
    assert {0, 1} in [{f, g} for f, g, _ in model.pairs]
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.97


def test_verdict_keeps_its_risk(spark, monkeypatch):
    """200 draws as strata, each tested at 5 %: the rules together reject more than alpha in few of them."""
    alpha, draws, n, cuts = 0.02, 200, 2000, (100, 200, 300, 400, 500, 600)
    monkeypatch.setattr(quality_rules, "RULES", {r: (r, "one", cuts) for r in "abc"})
    rng, rows, truth = np.random.default_rng(3), [], {}
    for d in range(draws):
        scale = rng.uniform(0.03, 0.12, 3)
        rows += [(str(d), *map(int, x)) for x in (rng.exponential(scale, (n, 3)) * 10**6)]
        truth[str(d)] = [1 - np.prod(1 - np.exp(-c / 1000 / scale)) for c in cuts]
    good = spark.createDataFrame(rows, "stratum string, a long, b long, c long").withColumn("one", F.lit(10**6))
    got = quality_rules.choose_cutoffs(good, alpha, 0.05 * draws).collect()
    assert all(r.cut_a == r.cut_b == r.cut_c for r in got) and len({r.cut_a for r in got}) > 2
    assert len(got) > draws / 2 and sum(truth[r.stratum][cuts.index(r.cut_a)] > alpha for r in got) <= 0.08 * draws


def test_copies_are_one_trial(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, text if i < 400 else f"{text} {i}", "en") for i in range(500)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    few = quality_rules.judge(docs, labels, alpha=0.02).first()
    assert few.cut_symbols is None  # 101 texts are too few for 2 %; 500 would do
    docs = docs.withColumn("text", F.concat_ws(" ", "text", F.col("doc_id").cast("string")))
    assert quality_rules.judge(docs, labels, alpha=0.02).first().cut_symbols == 10


def brute_features(text):
    text = text or ""
    w, lead = WORD.findall(text), len(text)
    some, share = max(1, len(w)), lambda members: sum(text.count(c) for c in members) / max(1, lead)
    lines = [x for x in text.split("\n") if x]
    pairs = list(zip(w, w[1:]))
    wide = sum(0xC0 <= b for b in text.encode()) / max(1, lead)
    marks = "\"'()[]{}:;=+-_/\\@^~`?"
    return [math.log1p(len(w)), min(lead / some, 1e4), min(max([len(x.encode()) for x in w], default=0), 1e4),
            share(map(chr, range(65, 91))), share("0123456789"), share("#*$%&<>"), share("!"), share("|"), share(marks), wide,
            len(set(w)) / some, sum(a == b for a, b in pairs) / some, (len(pairs) - len(set(pairs))) / max(1, len(pairs)),
            len(w) / max(1, len(lines)), (len(lines) - len(set(lines))) / max(1, len(lines)), text.count(".") / some]


def test_features_equal_brute_force(docs_rows):
    texts = [t for _, t in docs_rows] + ["a a b\n\n a a b\n\na a b", "É. É.\tx!|\n"]
    got = quality_model.features(texts)
    for t, x in zip(texts, got):
        np.testing.assert_allclose(x, brute_features(t), rtol=1e-12, atol=1e-12)


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(3000, 4))
    model = quality_model.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float))
    for row, score in zip(x[:200], model.score(x[:200])):
        where = [int(sum(e < v for e in edges)) for edges, v in zip(model.edges, row)]
        z = model.base + sum(t[b] for t, b in zip(model.tables, where)) + sum(t[where[f], where[g]] for f, g, t in model.pairs)
        assert math.isclose(score, 1 / (1 + math.exp(-z)), rel_tol=1e-9)
