import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from platewise.operators import counting
from platewise.operators.relational import decile
from platewise.plans import ml

SCHEMA = "g string, v long, t string, c int, decile string"


def plain(df):
    """By numbering whole groups."""
    order = [F.col("v").asc(), F.col("t").asc_nulls_first(), F.col("c").asc()]
    place, size = F.row_number().over(Window.partitionBy("g").orderBy(*order)), F.count(F.lit(1)).over(Window.partitionBy("g"))
    return df.withColumn("_p", place).withColumn("_s", size).withColumn("decile", decile("_p", "_s")).drop("_p", "_s")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts(rng):
    return [f"u{rng.randrange(3000)}", rng.choice(["", "a", "ab", "abcd", "abcdabcd", "abcde", "é\U0001f642中x", "z" * 40]), "same", None]


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_numbering_whole_groups(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(counting, "sized_broadcast", lambda df: df)
    rng = random.Random(4)
    data = []
    for g, n, values, kinds in (("hot", 6000, 3, 1), ("ties", 500, 1, 4), ("few", 7, 2, 4), ("one", 1, 1, 4), (None, 300, 5, 2), ("long", 400, 1, 2)):
        data += [(g, rng.randrange(values), texts(rng)[rng.randrange(kinds)], i, "clash") for i in range(n)]
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    assert rows(counting.decile_by_counting(df.drop("decile"), "g", "v", "t", [F.col("c").asc()])) == rows(plain(df.drop("decile")))


def test_only_values_across_a_border_go_on(spark, monkeypatch):
    data = [("g", i // 100, f"user{i:05d}", 0, "x") for i in range(10_000)]  # a hundred values, ten to a decile
    kept = []
    real = counting.durable
    monkeypatch.setattr(counting, "durable", lambda df: kept.append(real(df)) or kept[-1])
    df = spark.createDataFrame(data, SCHEMA).drop("decile")
    out = counting.decile_by_counting(df, "g", "v", "t")
    assert [k.count() for k in kept] == [10_000, 0] and out.groupBy("decile").count().where("count <> 1000").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan.split("Union")[0]


def test_empty(spark):
    assert counting.decile_by_counting(spark.createDataFrame([], SCHEMA).drop("decile"), "g", "v", "t").count() == 0


def digest(x):
    return hashlib.md5(("" if x is None else str(x)).encode()).hexdigest()


def cut(df, borders):
    return counting.cut_by_counting(df, [F.col("k"), F.col("t")], lambda n: borders)


@pytest.mark.parametrize("borders", [[0, 1], [1], [250, 251, 900], [999, 1000], [1000, 5000], []])
def test_cut_equals_sorting_by_digests(spark, borders):
    data = [(i // 3, f"row {i}") for i in range(1000)]  # three rows of each key
    out = cut(spark.createDataFrame(data, "k long, t string").repartition(5), borders)
    order = sorted(data, key=lambda r: (digest(r[0]), digest(r[1])))
    want = [(*r, sum(i >= b for b in borders)) for i, r in enumerate(order)]
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_cut_through_equal_rows(spark):
    """A hot key whose rows are all equal holds every border."""
    hot = [(None, "same")] * 700
    first = [(i, "x") for i in range(3000) if digest(i) < digest(None)][:60]
    last = [(i, "x") for i in range(3000) if digest(i) > digest(None)][:240]
    out = cut(spark.createDataFrame(hot + first + last, "k long, t string").repartition(9), [100, 300, 759, 800])
    found = Counter((r.k is None, r.part) for r in out.collect())
    assert found == {(False, 0): 60, (True, 0): 40, (True, 1): 200, (True, 2): 459, (True, 3): 1, (False, 3): 40, (False, 4): 200}


def test_cut_on_one_digit_of_the_digest(spark, monkeypatch):
    """Short steps: borders go through many histograms."""
    monkeypatch.setattr(counting, "STEP", 1)
    data = [(i, "x") for i in range(300)]
    out = cut(spark.createDataFrame(data, "k long, t string"), [77, 78])
    order = sorted(range(300), key=digest)
    assert {r.k: r.part for r in out.collect()} == {k: (i >= 77) + (i >= 78) for i, k in enumerate(order)}


@pytest.mark.parametrize("n", [0, 1, 2, 5, 7, 60, 101])
def test_split_sizes_are_exact(spark, n):
    df = spark.createDataFrame([(i if i % 5 else None, "clash", i % 2) for i in range(n)], "key long, t string, split_of int")
    out = ml.split_exact(df, "key", 7)
    test = math.ceil(Fraction(n, 5))
    val = math.ceil(Fraction(15, 100) * (n - test))
    got = Counter(r.split for r in out.collect())
    assert [got["test"], got["val"], got["train"]] == [test, val, n - test - val]
    assert sorted(map(repr, out.drop("split").collect())) == sorted(map(repr, df.collect()))


def test_split_moves_no_rows(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    plan = ml.split_exact(df, "key", 7)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
