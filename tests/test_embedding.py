"""Embedding bag: bags, descent and average against plain loops, accuracy beside the regression model."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise import operator_queries as oq
from platewise.plans import embedding as E
from platewise.plans import ml
from platewise.session import work_path

from conftest import SF_MID, SF_SMALL

M = 2 ** 64


def plain_bag(text, ngram, slots):
    points, counts = [ord(c) for c in f" {text} "], {}
    for i in range(len(points) - ngram + 1):
        h = 0
        for j in range(ngram):
            h = (h ^ points[i + j]) * E.HASH[j % 3] % M
            h ^= h >> 29
        slot = (h * E.HASH[3] % M >> 33) % slots
        counts[slot] = counts.get(slot, 0) + 1
    total = sum(counts.values())
    return {k: n / total for k, n in sorted(counts.items())}


def plain_epoch(model, shape, rows, rate, size):
    """Dense Adagrad, row by row, on (label, bag) pairs."""
    e, w, b, se, sw, sb = [p.copy() for p in shape.parts(model)]
    for at in range(0, len(rows), size):
        ge, gw, gb = np.zeros_like(e), np.zeros_like(w), np.zeros_like(b)
        part = rows[at:at + size]
        for y, bag in part:
            h = sum((v * e[s] for s, v in bag.items()), np.zeros(shape.width))
            z = [math.exp(float(w[c] @ h + b[c])) for c in range(shape.classes)]
            for c in range(shape.classes):
                g = (z[c] / sum(z) - (c == y)) / len(part)
                gw[c] += g * h
                gb[c] += g
                for s, v in bag.items():
                    ge[s] += g * v * w[c]
        se += (ge * ge).mean(axis=1)
        sw += gw * gw
        sb += gb * gb
        hit = sorted({s for _, bag in part for s in bag})
        e[hit] -= rate * ge[hit] / np.sqrt(se[hit] + 1e-12)[:, None]
        w -= rate * gw / np.sqrt(sw + 1e-12)
        b -= rate * gb / np.sqrt(sb + 1e-12)
    return np.concatenate([x.ravel() for x in (e, w, b, se, sw, sb)])


def test_bags_equal_a_plain_loop(monkeypatch):
    rng = random.Random(3)
    texts = ["", "a", "ab", "ข้าวผัด กุ้ง", "aaaaaaaaaa", "𝒳y" * 9] + ["".join(rng.choice("abc é") for _ in range(rng.randrange(400))) for _ in range(40)]
    for piece in (E.PIECE, 64, 7):  # long texts go piece by piece
        monkeypatch.setattr(E, "PIECE", piece)
        for ngram in (1, 2, 3, 4):
            got = list(E.bags(texts, ngram, 97))
            assert len(got) == len(texts)
            for (slots, shares), text in zip(got, texts):
                want = plain_bag(text, ngram, 97)
                assert slots.tolist() == list(want) and np.allclose(shares, list(want.values()), rtol=0, atol=1e-15)


def test_one_learner_equals_a_plain_loop(spark):
    shape = E.Shape(3, slots=53, width=4)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randrange(12))), rng.randrange(3), "train") for i in range(70)]
    rows += [(100, None, 1, "train"), (101, "", 2, "train"), (102, "abc", None, "train"), (103, "abc", 0, "test")]
    path = work_path(spark, "texts")
    spark.createDataFrame(rows, "key long, name string, label int, split string").coalesce(1).write.parquet(path)
    data = spark.read.parquet(path)
    model = E.train(data, "name", shape=shape, epochs=3, batch=8, learners=1)
    seen = ml.with_clean_text(data.where("split = 'train'"), "name").withColumn("at", F.xxhash64(F.monotonically_increasing_id()))
    order = [(r.label, plain_bag(r._clean.lower(), 3, 53)) for r in sorted(seen.collect(), key=lambda r: r["at"]) if r.label is not None]
    assert len(order) == 72
    want = E.start(shape, 17)
    for _ in range(3):
        want = plain_epoch(want, shape, order, 0.5, 8)
    assert np.abs(model.flat - want).max() < 1e-9
    assert [h["loss"] for h in model.history] == [None] * 3  # no val rows


@pytest.mark.parametrize("learners", [2, 16, 40])
def test_average_in_a_tree(spark, learners):
    rng = np.random.default_rng(learners)
    copies = [(i, b, int(rng.integers(1, 9)), rng.normal(size=5)) for i in range(learners) if i != 1 for b in range(2)]  # learner 1 had no rows
    n = {i: k for i, b, k, _ in copies if b == 0}
    copies = [(i, b, n[i], v) for i, b, _, v in copies]
    df = spark.createDataFrame([(i, b, k, v.tobytes()) for i, b, k, v in copies], E.COPY)
    got = {r.block: r for r in E._average(df, learners).collect()}
    assert len(got) == 2
    for b in range(2):
        want = sum(k * v for _, c, k, v in copies if c == b) / sum(n.values())
        assert got[b].n == sum(n.values()) and np.allclose(np.frombuffer(got[b].copy), want, rtol=0, atol=1e-12)


def test_accuracy_plateau_and_stored_model(spark):
    data = oq._text_data(spark, SF_MID)
    test = data.where("split = 'test'")
    model = E.train(data, "dish_name", learners=4)
    told = ml.evaluate(E.predict(model, test, "dish_name")).first()
    regression, _ = ml.train_and_validate(data, "dish_name", max_iter=20, num_features=1 << 12)
    other = ml.evaluate(ml.predict(regression, test, text_col="dish_name")).first()
    assert told.n == other.n and told.accuracy >= max(0.9, other.accuracy - 0.01), (told, other)
    rates = [h["rate"] for h in model.history]
    assert rates == sorted(rates, reverse=True) and rates[-1] < rates[0] and len(rates) < 30  # lowered, then stopped
    path = work_path(spark, "bag")
    E.save(model, spark, path)
    again = E.load(spark, path)
    assert again.shape == model.shape and np.array_equal(again.flat, model.flat)


def test_probabilities_and_odd_texts(spark):
    data = oq._text_data(spark, SF_SMALL)
    model = E.train(data, "dish_name", learners=2, epochs=2, shape=E.Shape(0, slots=512, width=8))
    e, w, b = model.shape.parts(model.flat)[:3]
    rows = [(1, None), (2, ""), (3, "x"), (4, "Früh am Morgen " * 3000), (4, "ฉันกินข้าว")]
    df = spark.createDataFrame(rows, "id long, name string")
    for r in E.predict(model, df, "name").collect():
        clean = ml.with_clean_text(df.where(F.col("name").eqNullSafe(F.lit(r.name))), "name").first()._clean.lower()
        z = w @ sum((v * e[s] for s, v in plain_bag(clean, 3, 512).items()), np.zeros(8)) + b
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(r.probs, p, rtol=0, atol=1e-9) and r.category_id == p.argmax() and abs(r.prob - p.max()) < 1e-9
    assert E.predict(model, df.limit(0), "name").count() == 0
    with pytest.raises(ValueError):
        E.train(data.limit(0), "dish_name")
    with pytest.raises(ValueError, match="broadcast"):
        E.train(data, "dish_name", shape=E.Shape(0, slots=1 << 24))


def test_cleaning_by_lookup_equals_the_regular_expression(spark, monkeypatch):
    """Bags and scores come without the regular expression, over every code point, malformed bytes, NULL and long texts."""
    from platewise.functions.text import clean_text

    monkeypatch.setattr(E, "PIECE", 1000)
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, points[at:at + 3000])) for at in range(0, len(points), 3000)] + [None, "", "A B", "ÄİK\u212a Z" * 2000]
    rows = spark.createDataFrame([(i, None if t is None else t.encode()) for i, t in enumerate(texts)] + [(-1, b"a\xffB\xe0\xb8C\xc3")], "i int, b binary")
    df = rows.select("i", F.expr("CAST(b AS STRING)").alias("t"), "b")
    want = {r.i: r.c for r in df.select("i", F.lower(F.coalesce(clean_text("t"), F.lit(""))).alias("c")).collect()}
    table = E._lower_kept()
    assert {r.i: E.clean_lower(None if r.b is None else bytes(r.b), table) for r in rows.collect()} == want
    made = E._bag_rows(df.withColumn("y", F.lit(0)), "t", "y", E.Shape(2, slots=64))
    assert "regexp_replace" not in made._jdf.queryExecution().optimizedPlan().toString() and made.count() == len(texts) + 1
