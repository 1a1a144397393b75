"""Exploratory queries over the retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import RECENCY_EDGES, RECENCY_NONE, RECENCY_REST, day, ratio, recency_bucket
from tidewell.functions.frames import Start, global_rank

SHARES = (1, 5, 10)


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Smallest, 25, 50, 75, 90, 99 % points (linear), largest and mean number of rows per key."""
    counts = df.groupBy(key).agg(F.count("*").cast("double").alias("n"))
    q = F.percentile("n", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)]))
    got = counts.agg(q.alias("q"), F.avg("n").alias("mean"))
    return got.select(*[F.get("q", F.lit(k)).alias(n) for k, n in enumerate(("min", "p25", "median", "p75", "p90", "p99", "max"))], "mean")


def top_share(tx: DataFrame, shares: tuple[int, ...] = SHARES) -> DataFrame:
    """Share of the purchases of the most sold 1, 5 and 10 % of articles, one at least."""
    ranked = global_rank(tx.groupBy("article_id").agg(F.count("*").alias("n")).withColumn("__less", -F.col("n")), ["__less", "article_id"], "i")
    sums = F.broadcast(ranked.agg(F.count("*").alias("articles"), F.sum("n").alias("total")).withColumn("one", F.lit(1)))
    met = ranked.withColumn("one", F.lit(1)).join(sums, "one").withColumn("percent", F.explode(F.array(*[F.lit(s) for s in shares])))
    taken = F.greatest(F.lit(1), F.floor(F.col("articles") * F.col("percent") / 100 + 0.5))
    return met.groupBy("percent").agg(ratio(F.sum(F.when(F.col("i") < taken, F.col("n"))), F.first("total")).alias("share"))


def lorenz(tx: DataFrame) -> DataFrame:
    """Cumulative share of purchases by share of articles, most sold first."""
    counts = tx.groupBy("article_id").agg(F.count("*").alias("n")).withColumn("__less", -F.col("n"))
    ranked = global_rank(counts, ["__less", "article_id"], "i")
    sums = F.broadcast(counts.agg(F.count("*").alias("articles"), F.sum("n").alias("total")).withColumn("one", F.lit(1)))
    # articles with equal counts are one step; k different counts need k * (k + 1) / 2 purchases, so steps stay few
    steps = ranked.groupBy("n").agg(F.count("*").alias("k"), F.min("i").alias("i0"))
    before = steps.withColumn("above", F.coalesce(F.sum(F.col("n") * F.col("k")).over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = ranked.join(F.broadcast(before.select("n", "i0", "above")), "n").withColumn("one", F.lit(1)).join(sums, "one")
    return met.select("article_id", ratio(F.col("i") + 1, F.col("articles")).alias("article_share"), ratio(F.col("above") + (F.col("i") - F.col("i0") + 1) * F.col("n"), F.col("total")).alias("purchase_share"))


def weekly_volume(tx: DataFrame) -> DataFrame:
    return tx.groupBy(F.date_trunc("week", F.col("t_dat")).cast("date").alias("week")).agg(F.count("*").alias("n"))


def repurchase_rate(tx: DataFrame) -> DataFrame:
    """Share of purchases, by week and overall (null week), of an article the customer bought before."""
    order = Window.partitionBy("customer_id", "article_id").orderBy("t_dat")
    marked = tx.withColumn("again", (F.row_number().over(order) > 1).cast("int"))
    weeks = F.explode(F.array(F.date_trunc("week", F.col("t_dat")).cast("date"), F.lit(None).cast("date")))
    return marked.select(weeks.alias("week"), "again").groupBy("week").agg(F.count("*").alias("n"), F.sum("again").alias("again"), F.avg("again").alias("rate"))


def recency_counts(tx: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers by days from their last purchase to the last day of all, in the buckets' order."""
    end = F.broadcast(tx.agg(F.max("t_dat").alias("end")).withColumn("one", F.lit(1)))
    last = tx.groupBy("customer_id").agg(F.max("t_dat").alias("last"))
    met = customers.select("customer_id").distinct().join(last, "customer_id", "left").withColumn("one", F.lit(1)).join(end, "one")
    counted = met.groupBy(recency_bucket(F.datediff("end", "last")).alias("recency_bucket")).agg(F.count("*").alias("n"))
    place = F.array_position(F.array(*[F.lit(x) for x in [*[b for _, b in RECENCY_EDGES], RECENCY_REST, RECENCY_NONE]]), F.col("recency_bucket"))
    total = F.broadcast(counted.agg(F.sum("n").alias("total")).withColumn("one", F.lit(1)))
    return counted.withColumn("one", F.lit(1)).join(total, "one").select(place.alias("place"), "recency_bucket", "n", ratio(F.col("n"), F.col("total")).alias("share"))


def recency_cumulative(tx: DataFrame) -> DataFrame:
    """Customers who bought within 1, 4, 12 and 52 weeks of the last day, and before."""
    end = F.broadcast(tx.agg(F.max("t_dat").alias("end")).withColumn("one", F.lit(1)))
    last = tx.groupBy("customer_id").agg(F.max("t_dat").alias("last")).withColumn("one", F.lit(1)).join(end, "one")
    days = F.datediff("end", "last")
    return last.agg(*[F.count_if(days <= d).alias(f"within_{d // 7}w") for d, _ in RECENCY_EDGES], F.count_if(days > RECENCY_EDGES[-1][0]).alias("beyond"))


def lifecycle(tx: DataFrame) -> DataFrame:
    """Days from an article's first to its last sale: points and mean."""
    spans = tx.groupBy("article_id").agg(F.datediff(F.max("t_dat"), F.min("t_dat")).cast("double").alias("span"))
    got = spans.agg(F.percentile("span", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)])).alias("q"), F.avg("span").alias("mean"), F.count("*").alias("articles"))
    return got.select(*[F.get("q", F.lit(k)).alias(n) for k, n in enumerate(("min", "p25", "median", "p75", "p90", "max"))], "mean", "articles")


def new_in_window(tx: DataFrame, start: Start, days: int = 7, new_days: int = 28) -> DataFrame:
    """Articles sold in the window, and those of them first sold at most four weeks before it."""
    inside = tx.where((F.col("t_dat") >= day(start)) & (F.col("t_dat") < F.date_add(day(start), days))).select("article_id").distinct()
    first = tx.groupBy("article_id").agg(F.min("t_dat").alias("first"))
    met = first.join(inside, "article_id", "left_semi")
    return met.agg(F.count("*").alias("sold"), F.count_if(F.col("first") >= F.date_sub(day(start), new_days)).alias("new")).withColumn("share", ratio(F.col("new"), F.col("sold")))


def ages(customers: DataFrame) -> DataFrame:
    got = customers.agg(F.count("*").alias("n"), F.count("age").alias("known"), F.min("age").cast("long").alias("min"), F.percentile("age", 0.5).alias("median"), F.avg("age").alias("mean"), F.max("age").cast("long").alias("max"))
    return got.withColumn("null_rate", 1 - ratio(F.col("known"), F.col("n")))


def mix(tx: DataFrame, articles: DataFrame, by: str = "index_group_name") -> DataFrame:
    """Purchases of each group of articles and their share."""
    counted = tx.groupBy("article_id").agg(F.count("*").alias("k")).join(articles.select("article_id", by), "article_id", "left").groupBy(by).agg(F.sum("k").alias("n"))
    total = F.broadcast(counted.agg(F.sum("n").alias("total")).withColumn("one", F.lit(1)))
    return counted.withColumn("one", F.lit(1)).join(total, "one").select(by, "n", ratio(F.col("n"), F.col("total")).alias("share"))


def pool_sizes(pool: DataFrame) -> DataFrame:
    """Candidates a customer: number of customers, mean, deviation and points."""
    sizes = pool.groupBy("customer_id").agg(F.count("*").cast("double").alias("n"))
    got = sizes.agg(F.count("*").alias("customers"), F.avg("n").alias("mean"), F.stddev_samp("n").alias("std"), F.percentile("n", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("q"))
    return got.select("customers", "mean", "std", *[F.get("q", F.lit(k)).alias(n) for k, n in enumerate(("min", "p25", "median", "p75", "max"))])


def popularity_only(pool: DataFrame) -> DataFrame:
    """Customers whose candidates all come from popularity alone, of all customers."""
    own = F.arrays_overlap("strategies", F.array(F.lit("repurchase"), F.lit("colour_variant"), F.lit("als")))
    per = pool.groupBy("customer_id").agg(F.bool_or(own).alias("own"))
    return per.agg(F.count("*").alias("customers"), F.count_if(~F.col("own")).alias("popularity_only"))


def sensitivity_pivot(grid: DataFrame) -> DataFrame:
    """Coverage by margin, a column for each cost multiplier."""
    from tidewell.operators.offers import MULTIPLIERS

    named = grid.withColumn("name", F.concat(F.lit("m_"), F.round(F.col("multiplier") * 10000).cast("int").cast("string")))
    return named.groupBy("margin").pivot("name", [f"m_{m}" for m in MULTIPLIERS]).agg(F.first("coverage"))
