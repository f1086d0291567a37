"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.operators.relational import sized_broadcast


def hot_keys(big: DataFrame, key: str, sample_fraction: float = 0.01, hot_share: float = 0.01,
             max_hot: int = 1000, seed: int = 17) -> DataFrame:
    """Keys holding at least ``hot_share`` of ``big``'s rows, estimated on a
    seeded sample; at most ``max_hot`` of them (so the result is a bounded
    table).  The estimate only shapes the plan, never the result rows.
    """
    s = big.select(key).sample(fraction=sample_fraction, seed=seed)
    total = s.select(F.count(F.lit(1))).scalar()
    counts = s.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (counts.where(F.col("_n") >= F.greatest(F.lit(1), total * F.lit(hot_share)))
            .orderBy(F.col("_n").desc()).limit(max_hot).select(key))


def split_hot_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                   **hot_kw) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys split off.

    Rows of ``big`` whose key is hot meet the matching rows of ``small`` by a
    broadcast join (those rows are few: ``max_hot`` keys, size-checked), so a
    key holding a third of ``big`` is spread over all of ``big``'s tasks
    instead of one reducer; all other keys take the ordinary shuffle join.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type for a hot-key split: {how!r}")
    from platewise.session import durable

    hot = F.broadcast(durable(hot_keys(big, key, **hot_kw)))
    big_hot = big.join(hot, key, "left_semi")
    big_cold = big.join(hot, key, "left_anti")
    small_hot = sized_broadcast(small.join(hot, key, "left_semi"))
    return big_hot.join(small_hot, key, how).unionByName(big_cold.join(small, key, how))
