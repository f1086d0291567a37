"""A key holding a third of the rows is split off and joined by broadcast."""

import pyspark.sql.functions as F

from platewise.operators.skew import hot_keys, split_hot_join


def test_hot_key_found_and_join_exact(spark):
    big = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"),
        F.col("id").alias("v"))
    small = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    hot = [r.k for r in hot_keys(big, "k", sample_fraction=0.05, hot_share=0.05).collect()]
    assert 7 in hot and len(hot) <= 3
    for how in ("inner", "left"):
        want = sorted(map(tuple, big.join(small, "k", how).select("k", "v", "w").collect()))
        got = sorted(map(tuple, split_hot_join(big, small, "k", how, sample_fraction=0.05,
                                               hot_share=0.05).select("k", "v", "w").collect()))
        assert got == want


def test_null_keys_stay_on_the_cold_side(spark):
    big = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    small = spark.createDataFrame([(1, "x")], "k int, w string")
    got = sorted(map(tuple, split_hot_join(big, small, "k", "left", sample_fraction=1.0, hot_share=0.1)
                     .select("k", "v", "w").collect()), key=str)
    assert got == sorted([(None, 1, None), (None, 2, None), (1, 3, "x")], key=str)
