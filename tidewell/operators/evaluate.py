"""Retrieval and ranking evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import RECENCY_EDGES, RECENCY_NONE, RECENCY_REST, ratio, recency_bucket
from tidewell.functions.frames import Start, in_windows, per_window, top_k
from tidewell.operators.candidates import KEYS, STRATEGIES

K = 12


def recall_hits(candidates: DataFrame, actual: DataFrame) -> DataFrame:
    """hits and total of each window; both sides count distinct pairs."""
    pool = candidates.select(*KEYS, "article_id").distinct().withColumn("hit", F.lit(1))
    met = actual.select(*KEYS, "article_id").distinct().join(pool, [*KEYS, "article_id"], "left")
    return met.groupBy("window_start").agg(F.count("hit").alias("hits"), F.count("*").alias("total")).withColumn("recall", ratio(F.col("hits"), F.col("total")))


def over_limit(candidates: DataFrame, k: int) -> DataFrame:
    """Customers with more than k distinct candidates."""
    return candidates.select(*KEYS, "article_id").distinct().groupBy(*KEYS).agg(F.count("*").alias("n")).where(F.col("n") > k)


def recall_at_k(candidates: DataFrame, actual: DataFrame, k: int) -> DataFrame:
    """Recall; raises if a customer has more than k candidates instead of cutting them."""
    if over_limit(candidates, k).head(1):
        raise ValueError(f"a customer has more than {k} candidates")
    return recall_hits(candidates, actual)


def recency(tx: DataFrame, customers: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """Bucket of days since each customer's last purchase before the window."""
    last = in_windows(tx, starts, None).groupBy(*KEYS).agg(F.max("t_dat").alias("last"))
    everyone = per_window(customers.select("customer_id").distinct(), starts).join(last, KEYS, "left")
    return everyone.select(*KEYS, recency_bucket(F.datediff("window_start", "last")).alias("recency_bucket"))


def recall_report(pool: DataFrame, actual: DataFrame, buckets: DataFrame) -> DataFrame:
    """Recall of the pool, of each strategy, its marginal part, and by recency bucket, in long form.

    Columns window_start, scope, name, hits, total, recall. A strategy's
    marginal recall is that of pairs which it alone proposed. The true pairs are
    joined with the pool once; all figures are conditional counts over that.
    """
    true = actual.join(pool.select(*KEYS, "article_id", "strategies", "n_strategies"), [*KEYS, "article_id"], "left").join(buckets, KEYS, "left")
    hit = F.col("strategies").isNotNull()
    only: list[Column] = [F.struct(F.lit("pool").alias("scope"), F.lit("all").alias("name"), hit.alias("hit"), F.lit(True).alias("counted"))]
    for s in STRATEGIES:
        has = hit & F.array_contains("strategies", s)
        only.append(F.struct(F.lit("strategy").alias("scope"), F.lit(s).alias("name"), has.alias("hit"), F.lit(True).alias("counted")))
        only.append(F.struct(F.lit("marginal").alias("scope"), F.lit(s).alias("name"), (has & (F.col("n_strategies") == 1)).alias("hit"), F.lit(True).alias("counted")))
    for b in [*[label for _, label in RECENCY_EDGES], RECENCY_REST, RECENCY_NONE]:
        inside = F.coalesce(F.col("recency_bucket") == b, F.lit(False))
        only.append(F.struct(F.lit("recency").alias("scope"), F.lit(b).alias("name"), (hit & inside).alias("hit"), inside.alias("counted")))
    long = true.select("window_start", F.inline(F.array(*only)))
    counted = long.groupBy("window_start", "scope", "name").agg(F.count_if(F.coalesce("hit", F.lit(False))).alias("hits"), F.count_if("counted").alias("total"))
    return counted.withColumn("recall", ratio(F.col("hits"), F.col("total")))


def _bought(actual: DataFrame) -> DataFrame:
    return actual.select(*KEYS, "article_id").distinct().groupBy(*KEYS).agg(F.count("*").alias("m"))


def ap_per_customer(predictions: DataFrame, actual: DataFrame, k: int = K) -> DataFrame:
    """Average precision at k of every purchaser; predictions carry rank_position.

    Each hit adds hits so far over its rank position; the sum is divided by
    min(m, k). Purchasers without predictions have 0, others aren't rows.
    """
    true = actual.select(*KEYS, "article_id").distinct().withColumn("hit", F.lit(1))
    marked = predictions.join(true, [*KEYS, "article_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    so_far = F.sum("hit").over(Window.partitionBy(*KEYS).orderBy("rank_position", "article_id").rowsBetween(Window.unboundedPreceding, 0))
    gains = marked.withColumn("so_far", so_far).where("hit = 1").groupBy(*KEYS).agg(F.sum(F.col("so_far") / F.col("rank_position")).alias("gain"))
    out = _bought(actual).join(gains, KEYS, "left")
    return out.select(*KEYS, (F.coalesce("gain", F.lit(0.0)) / F.least("m", F.lit(k))).alias("ap"))


def check_ranks(predictions: DataFrame, k: int = K) -> DataFrame:
    """The predictions; raises if a rank position is over k."""
    if predictions.where(F.col("rank_position") > k).head(1):
        raise ValueError(f"a rank position is over {k}")
    return predictions


def mean_ap(ap: DataFrame) -> DataFrame:
    """Mean over purchasers, and their number, of each window."""
    return ap.groupBy("window_start").agg(F.avg("ap").alias("map"), F.count("*").alias("n_purchasers"))


def oracle_ap(pool: DataFrame, actual: DataFrame, k: int = K) -> DataFrame:
    """What a perfect order of the pool would reach."""
    true = actual.select(*KEYS, "article_id").distinct()
    found = true.join(pool.select(*KEYS, "article_id").distinct(), [*KEYS, "article_id"], "left_semi").groupBy(*KEYS).agg(F.count("*").alias("found"))
    out = _bought(actual).join(found, KEYS, "left")
    return out.select(*KEYS, (F.least(F.coalesce("found", F.lit(0)), F.lit(k)) / F.least("m", F.lit(k))).alias("ap"))


def pool_order(pool: DataFrame, k: int = K) -> DataFrame:
    """The pool by best rank, then article: the baseline order."""
    return top_k(pool, KEYS, [F.col("best_rank"), F.col("article_id")], k, "rank_position").select(*KEYS, "article_id", F.col("rank_position").cast("long").alias("rank_position"))


def popularity_order(top: DataFrame, actual: DataFrame, k: int = K) -> DataFrame:
    """The most sold articles for every purchaser."""
    lists = top.where(F.col("rank") <= k).groupBy("window_start").agg(F.collect_list(F.struct("article_id", F.col("rank").alias("rank_position"))).alias("list"))
    return actual.select(*KEYS).distinct().join(F.broadcast(lists), "window_start").select(*KEYS, F.inline("list"))


def score_order(scored: DataFrame, k: int = K, score: str = "ranker_score") -> DataFrame:
    """Best k by score as a 32-bit float, then article."""
    out = scored.withColumn(score, F.col(score).cast("float"))
    return top_k(out, KEYS, [F.desc(score), F.col("article_id")], k, "rank_position").withColumn("rank_position", F.col("rank_position").cast("long"))


def orderings(named: dict[str, DataFrame], buckets: DataFrame) -> DataFrame:
    """Mean AP of several orders, of all purchasers and by recency bucket: ordering, recency_bucket, map, n_purchasers."""
    out = None
    for name, ap in named.items():
        part = ap.withColumn("ordering", F.lit(name))
        out = part if out is None else out.unionByName(part)
    met = out.join(buckets, KEYS, "left").select("ordering", "ap", F.explode(F.array(F.lit("all"), F.col("recency_bucket"))).alias("recency_bucket"))
    return met.groupBy("ordering", "recency_bucket").agg(F.avg("ap").alias("map"), F.count("*").alias("n_purchasers"))
