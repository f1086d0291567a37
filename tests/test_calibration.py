"""Reliability bins, calibration error and calibration against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from platewise.plans import calibration as C

SCHEMA = "prob double, category_id int, label int, n string"


def overconfident(rng, n):
    """Rows whose class is right with probability 0.2 + 0.5 p."""
    out = []
    for _ in range(n):
        p = rng.random()
        out.append((p, 1, int(rng.random() < 0.2 + 0.5 * p), "clash"))
    return out


def plain_bins(rows, bins):
    found = {}
    for p, c, y, _ in rows:
        if None not in (p, c, y) and not math.isnan(p):
            b = found.setdefault(min(int(p * bins), bins - 1), [0, 0, 0.0])
            b[0], b[1], b[2] = b[0] + 1, b[1] + (c == y), b[2] + p
    return {b: (n, h, s / n) for b, (n, h, s) in found.items()}


def plain_pools(bins):
    """Pool adjacent violators: bin -> share."""
    stack = []
    for b in sorted(bins):
        stack.append([bins[b][1], bins[b][0], [b]])
        while len(stack) > 1 and stack[-2][0] * stack[-1][1] >= stack[-1][0] * stack[-2][1]:
            hits, n, own = stack.pop()
            stack[-1] = [stack[-1][0] + hits, stack[-1][1] + n, stack[-1][2] + own]
    return {b: h / n for h, n, own in stack for b in own}


@pytest.fixture(scope="module")
def rows():
    odd = [(None, 1, 1, "x"), (float("nan"), 1, 1, "x"), (0.5, None, 1, "x"), (0.5, 1, None, "x"), (0.0, 1, 1, None), (1.0, 1, 0, "")]
    return overconfident(random.Random(3), 4000) + odd


def test_bins_error_and_pools(spark, rows):
    want = plain_bins(rows, 25)
    bins = C.reliability(spark.createDataFrame(rows, SCHEMA), bins=25)
    got = {r.bin: (r.n, r.hits, r.prob) for r in bins.collect()}
    assert got.keys() == want.keys()
    assert all(got[b][:2] == want[b][:2] and got[b][2] == pytest.approx(want[b][2], abs=1e-8) for b in want)
    total = sum(n for n, _, _ in want.values())
    e = C.calibration_error(bins).first()
    assert e.n == total and e.error == pytest.approx(sum(abs(h - s * n) for n, h, s in want.values()) / total, abs=1e-8)
    pools = plain_pools(want)
    assert len(set(pools.values())) < len(pools)  # there were violators
    assert {r.bin: r.calibrated for r in C.calibrated_bins(bins).collect()} == pytest.approx(pools)


def test_calibrated_probabilities_hold_on_other_rows(spark, rows):
    other = spark.createDataFrame(overconfident(random.Random(4), 4000), SCHEMA)
    model = C.fit_calibration(C.reliability(spark.createDataFrame(rows, SCHEMA), bins=25))
    scored = C.calibrate(model, other)
    before = C.calibration_error(C.reliability(other)).first().error
    after = C.calibration_error(C.reliability(scored, prob_col="calibrated")).first().error
    assert before > 0.1 and after < before / 2
    inverted = scored.alias("a").join(scored.alias("b"), F.col("a.prob").between(0.3, 0.31) & F.col("b.prob").between(0.6, 0.61))
    assert inverted.where("a.calibrated > b.calibrated").count() == 0


def test_rows_without_probability_and_empty_frames(spark, rows):
    model = C.fit_calibration(C.reliability(spark.createDataFrame(rows, SCHEMA)))
    odd = C.calibrate(model, spark.createDataFrame([(None, 1, 1, "a"), (float("nan"), 1, 1, "b"), (2.0, 1, 1, "c")], SCHEMA))
    assert {r.n: r.calibrated is None for r in odd.collect()} == {"a": True, "b": True, "c": False}
    none = C.reliability(spark.createDataFrame([], SCHEMA))
    assert C.calibration_error(none).first()[:] == (0, None)
    with pytest.raises(ValueError):
        C.fit_calibration(none)
