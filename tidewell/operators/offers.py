"""Offer decision: eligibility, expected value, at most one offer a customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.columns import day, ratio
from tidewell.functions.frames import Start, percentiles, top_k
from tidewell.operators.calibrate import in_fit
from tidewell.sources.shared import written

#: Margin, cost multiplier and days that rows look back.
MARGIN, COST_MULTIPLIER = 0.5, 0.001
SOLD_DAYS, BOUGHT_DAYS, PRICE_DAYS = 7, 14, 28
#: The sensitivity grid, as exact fractions of 10 and of 10,000.
MARGINS = (3, 4, 5, 6)
MULTIPLIERS = (5, 10, 20, 50, 100, 200)
QUANTILES = (0.5, 0.9, 0.99, 0.999, 0.9999)
#: Cost multipliers of the threshold report.
THRESHOLDS = (0.02, 0.01, 0.005, 0.001, 0.0005, 0.0001)


def _last(tx: DataFrame, date: Start, days: int) -> DataFrame:
    return tx.where((F.col("t_dat") >= F.date_sub(day(date), days)) & (F.col("t_dat") < day(date)))


def recently_sold(tx: DataFrame, date: Start) -> DataFrame:
    return _last(tx, date, SOLD_DAYS).select("article_id").distinct()


def recently_bought(tx: DataFrame, date: Start) -> DataFrame:
    return _last(tx, date, BOUGHT_DAYS).select("customer_id", "article_id").distinct()


def trailing_price(tx: DataFrame, date: Start) -> DataFrame:
    return _last(tx, date, PRICE_DAYS).groupBy("article_id").agg(F.avg("price").alias("price"))


def contact_cost(prices: DataFrame, multiplier: float = COST_MULTIPLIER) -> DataFrame:
    """One row: the median of the articles' mean prices, and the cost of a contact."""
    return prices.agg(F.percentile("price", 0.5).alias("median_price")).withColumn("contact_cost", F.col("median_price") * multiplier)


def with_eligibility(scored: DataFrame, sold: DataFrame, bought: DataFrame) -> DataFrame:
    """eligible: sold lately, and not bought lately by the customer."""
    out = scored.join(sold.withColumn("__sold", F.lit(True)), "article_id", "left").join(bought.withColumn("__bought", F.lit(True)), ["customer_id", "article_id"], "left")
    return out.withColumn("eligible", F.coalesce("__sold", F.lit(False)) & F.coalesce(~F.col("__bought"), F.lit(True))).drop("__sold", "__bought")


def expected_value(margin: float | Column = MARGIN, cost: str = "contact_cost") -> Column:
    rate = margin if isinstance(margin, Column) else F.lit(margin)
    return rate * F.col("price") * F.col("p_purchase") - F.col(cost)


def with_cost(scored: DataFrame, cost: DataFrame) -> DataFrame:
    """Every row beside the one row of ``cost``."""
    return scored.withColumn("__one", F.lit(1)).join(F.broadcast(cost.withColumn("__one", F.lit(1))), "__one").drop("__one")


def select_offers(valued: DataFrame) -> DataFrame:
    """The eligible row with the highest value over 0 of each customer; ties by score, then article."""
    good = valued.where(F.col("eligible") & (F.col("expected_value") > 0))
    return top_k(good, ["customer_id"], [F.desc("expected_value"), F.desc("ranker_score"), F.col("article_id")], 1, "__n").drop("__n")


def coverage(selected: DataFrame, customers: DataFrame) -> DataFrame:
    covered = selected.agg(F.countDistinct("customer_id").alias("covered")).withColumn("__one", F.lit(1))
    every = customers.agg(F.countDistinct("customer_id").alias("total")).withColumn("__one", F.lit(1))
    return covered.join(F.broadcast(every), "__one").drop("__one").withColumn("coverage", ratio(F.col("covered"), F.col("total")))


def concentration(selected: DataFrame, top: int = 10) -> DataFrame:
    """Distinct articles, selections, and the share of the ``top`` most selected (0 if none)."""
    counts = selected.groupBy("article_id").agg(F.count("*").alias("n"))
    best = counts.orderBy(F.desc("n"), "article_id").limit(top).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__top"), F.lit(1).alias("__one"))
    every = counts.agg(F.count("*").alias("distinct_articles"), F.coalesce(F.sum("n"), F.lit(0)).alias("selections")).withColumn("__one", F.lit(1))
    return every.join(F.broadcast(best), "__one").select("distinct_articles", "selections", F.coalesce(ratio(F.col("__top"), F.col("selections")), F.lit(0.0)).alias("top_share"))


def strategy_mix(selected: DataFrame, pool: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """Share of the offers that each strategy proposed."""
    ranks = pool.select("customer_id", "article_id", *[f"rank_{s}" for s in names])
    met = selected.select("customer_id", "article_id").join(ranks, ["customer_id", "article_id"], "left")
    return met.agg(*[F.coalesce(F.avg(F.col(f"rank_{s}").isNotNull().cast("int")), F.lit(0.0)).alias(s) for s in names])


def divergence(selected: DataFrame, top1: DataFrame) -> DataFrame:
    """Share of the offers that aren't the customer's first ranked article."""
    met = selected.select("customer_id", "article_id").join(top1.select("customer_id", F.col("article_id").alias("first")), "customer_id", "left")
    return met.agg(F.count("*").alias("offers"), F.count_if(F.col("article_id") != F.col("first")).alias("different")).withColumn("share", ratio(F.col("different"), F.col("offers")))


def price_summary(df: DataFrame, name: str) -> DataFrame:
    """10, 25, 50, 75 and 90 % points (linear) and the mean of the prices."""
    points = (10, 25, 50, 75, 90)
    rows = written(df.select(F.lit(name).alias("what"), "price"), "prices")
    at = percentiles(rows, "what", "price", [p / 100 for p in points])
    wide = at.agg(F.lit(1).alias("__one"), *[F.max(F.when(F.col("k") == k, F.col("value"))).alias(f"p{p}") for k, p in enumerate(points)])
    mean = rows.agg(F.avg("price").alias("mean"), F.lit(1).alias("__one"))
    return mean.join(F.broadcast(wide), "__one").select(F.lit(name).alias("what"), *[f"p{p}" for p in points], "mean")


def sensitivity(scored: DataFrame, cost: DataFrame, customers: DataFrame) -> DataFrame:
    """Coverage of every margin and cost multiplier.

    A customer is covered if their best eligible price times probability, times
    the margin, is over the cost, so one value a customer decides all cells.
    """
    best = scored.where("eligible").groupBy("customer_id").agg(F.max(F.col("price") * F.col("p_purchase")).alias("best"))
    cells = F.array(*[F.struct(F.lit(m / 10).alias("margin"), F.lit(c / 10000).alias("multiplier")) for m in MARGINS for c in MULTIPLIERS])
    grid = with_cost(best, cost.select("median_price")).select("best", "median_price", F.inline(cells))
    counted = grid.groupBy("margin", "multiplier").agg(F.count_if(F.col("margin") * F.col("best") - F.col("median_price") * F.col("multiplier") > 0).alias("covered"))
    return with_cost(counted, customers.agg(F.countDistinct("customer_id").alias("total"))).select("margin", "multiplier", "covered", ratio(F.col("covered"), F.col("total")).alias("coverage"))


def in_sample(selected: DataFrame) -> DataFrame:
    """Share of the covered customers whose bucket fitted the calibrator."""
    return selected.agg(F.count("*").alias("covered"), F.count_if(in_fit(F.col("bucket"))).alias("in_fit")).withColumn("share", ratio(F.col("in_fit"), F.col("covered")))


def divergence_parts(selected: DataFrame, top1: DataFrame, sold: DataFrame, bought: DataFrame) -> DataFrame:
    """Why offers differ from the first ranked article: bought lately, not sold lately, or worth less."""
    first = top1.select("customer_id", F.col("article_id").alias("first"), F.col("price").alias("first_price"))
    met = selected.select("customer_id", "article_id", "price").join(first, "customer_id").where("article_id != first")
    met = met.join(bought.select("customer_id", F.col("article_id").alias("first"), F.lit(True).alias("b")), ["customer_id", "first"], "left").join(sold.select(F.col("article_id").alias("first"), F.lit(True).alias("s")), "first", "left")
    b, s = F.coalesce("b", F.lit(False)), F.coalesce("s", F.lit(False))
    return met.agg(
        F.count("*").alias("different"), F.count_if(b).alias("bought_lately"), F.count_if(~b & ~s).alias("not_sold_lately"), F.count_if(~b & s).alias("worth_less"),
        F.percentile(F.when(~b & s, ratio(F.col("price"), F.col("first_price"))), 0.5).alias("median_price_ratio"),
    )


def threshold_report(scored: DataFrame, cost: DataFrame) -> DataFrame:
    """Quantiles of the probabilities and of each customer's highest, and the share of customers with a row worth each cost."""
    scored = written(scored, "scored")
    best = with_cost(scored, cost.select("median_price")).groupBy("customer_id").agg(
        F.max("p_purchase").alias("p"),
        *[F.bool_or(F.coalesce(0.5 * F.col("price") * F.col("p_purchase") > c * F.col("median_price"), F.lit(False))).alias(f"over_{k}") for k, c in enumerate(THRESHOLDS)],
    )
    both = scored.select(F.lit("row").alias("what"), F.col("p_purchase").alias("p")).unionByName(best.select(F.lit("customer").alias("what"), "p"))
    names = F.array(*[F.concat(F.lit(" q"), F.lit(q).cast("string")) for q in QUANTILES])
    points = percentiles(both, "what", "p", QUANTILES).select(F.concat("what", F.get(names, F.col("k"))).alias("name"), "value")
    highest = both.groupBy("what").agg(F.max("p").alias("value")).select(F.concat("what", F.lit(" max")).alias("name"), "value")
    shares = best.agg(*[F.avg(F.col(f"over_{k}").cast("int")).alias(f"s{k}") for k in range(len(THRESHOLDS))])
    share_rows = shares.select(F.inline(F.array(*[F.struct(F.lit(f"share over {c!r}").alias("name"), F.col(f"s{k}").alias("value")) for k, c in enumerate(THRESHOLDS)])))
    return points.unionByName(highest).unionByName(share_rows)


def offer_summary(selected: DataFrame, top: int = 10) -> DataFrame:
    """The most offered articles with their price."""
    return selected.groupBy("article_id").agg(F.count("*").alias("selections"), F.max("price").alias("price")).orderBy(F.desc("selections"), "article_id").limit(top)
