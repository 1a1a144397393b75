"""Customer buckets, isotonic calibration and reliability."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.columns import hash_mod, ratio
from tidewell.functions.frames import global_rank

SEED, BUCKETS = 42, 100
FIT, EVAL = (0, 20), (20, 40)
BINS = 10


def customer_bucket(customer: Column | str = "customer_id", seed: int = SEED) -> Column:
    """Whole customers in one of 100 buckets, the same in Spark and SQL."""
    return hash_mod(BUCKETS, str(seed), F.col(customer) if isinstance(customer, str) else customer)


def in_fit(bucket: Column) -> Column:
    return (bucket >= FIT[0]) & (bucket < FIT[1])


def in_eval(bucket: Column) -> Column:
    return (bucket >= EVAL[0]) & (bucket < EVAL[1])


def fit_calibrator(scored: DataFrame, score: str = "raw_prob", label: str = "label") -> IsotonicRegressionModel:
    """Isotonic map from raw scores to frequencies.

    Rows are summed by score first, so the fit gets one weighted row a score.
    """
    sums = scored.groupBy(F.col(score).cast("double").alias("x")).agg(F.avg(F.col(label).cast("double")).alias("y"), F.count("*").cast("double").alias("w"))
    ready = VectorAssembler(inputCols=["x"], outputCol="features").transform(sums)
    return IsotonicRegression(featuresCol="features", labelCol="y", weightCol="w", isotonic=True).fit(ready)


def apply_calibrator(model: IsotonicRegressionModel, scored: DataFrame, score: str = "raw_prob", to: str = "p_purchase") -> DataFrame:
    """Calibrated probability; scores outside the fitted range get its ends."""
    ready = VectorAssembler(inputCols=["__x"], outputCol="__features").transform(scored.withColumn("__x", F.col(score).cast("double")))
    out = model.setFeaturesCol("__features").setPredictionCol("__p").transform(ready)
    return out.withColumn(to, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__p")))).drop("__x", "__features", "__p")


def brier(p: Column, y: Column) -> Column:
    return F.avg(F.pow(p - y.cast("double"), F.lit(2.0)))


def brier_table(scored: DataFrame, probability: str = "p_purchase", label: str = "label") -> DataFrame:
    """n, base rate, Brier score and skill against the constant base rate (null if that is 0 or 1)."""
    sums = scored.agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("base_rate"), brier(F.col(probability), F.col(label)).alias("brier"))
    return sums.withColumn("brier_skill", 1 - ratio(F.col("brier"), F.col("base_rate") * (1 - F.col("base_rate"))))


def quantile_bins(scored: DataFrame, probability: str = "p_purchase", bins: int = BINS) -> DataFrame:
    """Bins of nearly equal counts by (probability, customer, article): floor(i * bins / n)."""
    ranked = global_rank(scored, [probability, "customer_id", "article_id"], "__i", "__of")
    return ranked.withColumn("bin", F.floor(F.col("__i") * bins / F.col("__of")).cast("long")).drop("__i", "__of")


def reliability(binned: DataFrame, probability: str = "p_purchase", label: str = "label") -> DataFrame:
    """Rows, mean prediction and observed rate of each bin."""
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.avg(probability).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("observed_rate"))


def top_bin_again(binned: DataFrame, probability: str = "p_purchase", label: str = "label", bins: int = BINS) -> DataFrame:
    """The highest bin in bins of its own, with the lift of each over the base rate of all."""
    base = F.broadcast(binned.agg(F.avg(F.col(label).cast("double")).alias("base_rate")).withColumn("__one", F.lit(1)))
    again = reliability(quantile_bins(binned.where(F.col("bin") == bins - 1).drop("bin"), probability, bins), probability, label)
    return again.withColumn("__one", F.lit(1)).join(base, "__one").drop("__one").withColumn("lift", ratio(F.col("observed_rate"), F.col("base_rate")))
