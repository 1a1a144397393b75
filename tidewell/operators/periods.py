"""Label windows, history cut-offs, actual purchases and labels."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.columns import day
from tidewell.functions.frames import Start, top_k

WEEK = 7
TRAIN_WEEKS = 4
NEGATIVES, SEED = 10, 42


def train_starts(anchor: datetime.date) -> list[datetime.date]:
    """First days of the four training weeks before the validation week."""
    return [anchor - datetime.timedelta(days=WEEK * k) for k in range(TRAIN_WEEKS, 0, -1)]


def label_windows(spark: SparkSession, anchor: datetime.date) -> DataFrame:
    """Four training weeks and the validation week; both ends of a week are in it."""
    rows = [("train", s) for s in train_starts(anchor)] + [("validation", anchor)]
    return spark.createDataFrame([(k, s, s + datetime.timedelta(days=WEEK - 1)) for k, s in rows], "split string, window_start date, window_end date")


def transactions_before(tx: DataFrame, start: Start) -> DataFrame:
    """History: strictly before the window's first day."""
    return tx.where(F.col("t_dat") < day(start))


def actual_purchases(tx: DataFrame, starts: Sequence[Start], days: int = WEEK) -> DataFrame:
    """Distinct (window_start, customer_id, article_id) bought in the windows."""
    every = sorted({str(s) for s in starts})
    inside = lambda s: (F.col("t_dat") >= s) & (F.col("t_dat") < F.date_add(s, days))
    wide = tx.where((F.col("t_dat") >= day(every[0])) & (F.col("t_dat") < F.date_add(day(every[-1]), days)))
    return wide.withColumn("window_start", F.explode(F.filter(F.array(*[day(s) for s in every]), inside))).select("window_start", "customer_id", "article_id").distinct()


def training_labels(candidates: DataFrame, actual: DataFrame, negatives: int = NEGATIVES, seed: int = SEED) -> DataFrame:
    """Candidates of customers with a hit: every hit, and ``negatives`` others per hit.

    Which others is decided by a seeded hash of the pair, then the article; a
    purchase outside the pool is no positive. Candidates keep their columns.
    """
    keys = ["window_start", "customer_id"]
    marked = candidates.join(actual.withColumn("__hit", F.lit(1)), [*keys, "article_id"], "left").withColumn("label", F.coalesce("__hit", F.lit(0)).cast("byte")).drop("__hit")
    hits = marked.where("label = 1").groupBy(*keys).agg(F.count("*").alias("__positives"))
    scoped = marked.join(hits, keys)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), "customer_id", "article_id"))
    ranked = top_k(scoped, [*keys, "label"], [draw, F.col("article_id")], None, "__draw")
    return ranked.where((F.col("label") == 1) | (F.col("__draw") <= negatives * F.col("__positives"))).drop("__draw", "__positives")
