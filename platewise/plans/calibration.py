"""How far a classifier's probabilities can be trusted: reliability bins, calibration error, calibration."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 100


def reliability(pred: DataFrame, label_col: str = "label", pred_col: str = "category_id", prob_col: str = "prob",
                bins: int = BINS) -> DataFrame:
    """Scored rows by their probability: ``bin`` (0 to ``bins - 1``, empty ones left out), ``n`` rows,
    ``hits`` (class right) and ``prob`` (mean, of nine places).

    Counts and sums only, so bins of two frames add up and what is shuffled is at most
    ``bins`` rows per task.  Rows without label, class or probability (NULL or NaN) are left out.
    """
    p = F.col(prob_col).cast("double")
    rows = pred.where(F.col(label_col).isNotNull() & F.col(pred_col).isNotNull() & p.isNotNull() & ~F.isnan(p))
    exact = p.cast("decimal(10,9)")  # sums don't hang on the order of rows
    found = rows.groupBy(F.least(F.floor(p * bins).cast("int"), F.lit(bins - 1)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(pred_col) == F.col(label_col)).cast("long")).alias("hits"),
        F.sum(exact).alias("_sum"))
    return found.select("bin", "n", "hits", (F.col("_sum").cast("double") / F.col("n")).alias("prob"))


def calibration_error(bins: DataFrame) -> DataFrame:
    """One row: ``n`` and ``error``, the mean distance between a bin's share of right classes and its
    mean probability, weighted by rows (NULL without rows)."""
    gap = F.abs(F.col("hits") / F.col("n") - F.col("prob")) * F.col("n")
    return bins.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), (F.sum(gap) / F.sum("n")).alias("error"))


def fit_calibration(bins: DataFrame) -> IsotonicRegressionModel:
    """The nondecreasing function of the probability that is nearest to the bins' shares of right
    classes, weighted by rows (pool adjacent violators).  It is fitted on bins, so its size
    doesn't grow with the scored rows.  Raises without bins."""
    shares = bins.select((F.col("hits") / F.col("n")).alias("share"), "prob", F.col("n").cast("double").alias("weight"))
    if shares.isEmpty():
        raise ValueError("no scored rows to calibrate on")
    return IsotonicRegression(featuresCol="prob", labelCol="share", weightCol="weight", predictionCol="calibrated").fit(shares)


def calibrate(model: IsotonicRegressionModel, pred: DataFrame, prob_col: str = "prob", out: str = "calibrated") -> DataFrame:
    """Scored rows with the calibrated probability ``out`` of their class: straight lines between the bins
    that were fitted, flat beyond them; NULL where the probability is NULL or NaN."""
    p = F.col(f"`{prob_col}`").cast("double")
    usable = p.isNotNull() & ~F.isnan(p)
    rows = pred.withColumn("_usable", usable).withColumn("_prob", F.when(usable, p).otherwise(F.lit(0.0)))
    scored = model.copy().setFeaturesCol("_prob").setPredictionCol("_calibrated").transform(rows)
    return scored.withColumn(out, F.when(F.col("_usable"), F.col("_calibrated"))).drop("_usable", "_prob", "_calibrated")


def calibrated_bins(bins: DataFrame) -> DataFrame:
    """``bins`` with ``calibrated``: the share of right classes in each bin's pool of adjacent bins."""
    pools = calibrate(fit_calibration(bins), bins, out="_pool")
    pool = Window.partitionBy("_pool")  # at most one row a bin
    return pools.withColumn("calibrated", F.sum("hits").over(pool) / F.sum("n").over(pool)).drop("_pool")
