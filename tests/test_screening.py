"""The Bloom pre-screen: equal rows, few false positives, few rows in the join."""

import pytest
from pyspark.sql import functions as F

from platewise.operators import screening
from platewise.operators.relational import not_in


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, left, right, kind="long"):
    return (spark.createDataFrame([(k, f"r{i}", i) for i, k in enumerate(left)], f"k {kind}, _maybe_not string, _n int").repartition(5),
            spark.createDataFrame([(k, "clash") for k in right], f"j {kind}, k string").repartition(3))


CASES = {
    "some": ([1, 2, 2, 3, None, 9], [2, 2, 7]),
    "null on the right": ([1, 2, None], [2, None]),
    "empty right": ([1, None], []),
    "empty left": ([], [1]),
    "only nulls": ([None, None], [None]),
    "both empty": ([], []),
    "hot key": ([5] * 2000 + list(range(300)), [5, 6] * 500),
    "extremes": ([-(2 ** 63), 2 ** 63 - 1, 0, -1], [2 ** 63 - 1, -1]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("null_aware", [True, False])
def test_equals_not_in(spark, case, null_aware):
    df, other = frames(spark, *CASES[case])
    got = screening.not_in_screened(df, other, "k", "j", null_aware=null_aware)
    assert rows(got) == rows(not_in(df, other, "k", "j", null_aware=null_aware)) and got.columns == df.columns


def test_texts(spark):
    left, right = ["", "a", "é\U0001f642", "z" * 50_000, None, "b"], ["", "z" * 50_000, "c"]
    df, other = frames(spark, left, right, "string")
    assert sorted(r.k for r in screening.not_in_screened(df, other, "k", "j").collect()) == ["a", "b", "é\U0001f642"]


def test_two_types_are_refused(spark):
    df, other = frames(spark, [1], [1])
    with pytest.raises(TypeError):
        screening.not_in_screened(df, other.select(F.col("j").cast("int")), "k", "j")


def test_false_positives(spark):
    held, asked = spark.range(0, 40_000), spark.range(40_000, 140_000)
    bloom = screening.bloom_filter(held, "id")
    assert bloom[1] > 10
    assert screening.maybe_held(held, "id", bloom).where("NOT _maybe").count() == 0  # none is ever missed
    assert screening.maybe_held(asked, "id", bloom).where("_maybe").count() < 1_000  # 1 %


def test_a_full_filter_stays_exact(spark):
    df, other = spark.range(0, 60_000).toDF("k"), spark.range(50_000, 110_000).toDF("k")
    bloom = screening.bloom_filter(other, "k", max_bytes=screening.BLOCK_BYTES)
    assert bloom[1] == 1 and screening.maybe_held(df, "k", bloom).where("_maybe").count() > 50_000
    got = screening.not_in_screened(df, other, "k", max_bytes=screening.BLOCK_BYTES)
    assert got.agg(F.count("k"), F.min("k"), F.max("k")).first()[:] == (50_000, 0, 49_999)


def test_a_batch_joins_few_rows_of_a_large_table(spark, monkeypatch):
    kept = []
    real = screening.durable
    monkeypatch.setattr(screening, "durable", lambda df: kept.append(real(df)) or kept[-1])
    batch, table = spark.range(99_900, 100_100).toDF("k"), spark.range(0, 100_000).toDF("k")
    assert screening.not_in_screened(batch, table, "k").count() == 100
    near = next(t for t in kept if t.columns == ["_ni_key"])
    assert 100 <= near.count() < 2_000


def test_menus_of_a_batch(spark):
    from platewise.plans import tagging

    batch = spark.createDataFrame([(1, "Rice", "x"), (2, "Soup", "x"), (None, "Tea", "x"), (3, None, "x")], "menu_id long, menu_name string, _maybe string")
    tagged = spark.createDataFrame([(2, "Soup")], "menu_id long, menu_name string")
    assert rows(tagging.new_menus_of_batch(batch, tagged)) == [(1, "Rice"), (3, None)]
