"""Candidate retrieval: five capped strategies and their pool.

Every function works on all window starts at once; rows carry ``window_start``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.columns import age_bucket
from tidewell.functions.frames import Start, in_windows, per_window, top_k

#: Names of the strategies, their caps, horizons in days, and allocations that are compared.
STRATEGIES = ("repurchase", "colour_variant", "recent_popularity", "segment_popularity", "als")
#: Most candidates of each strategy, in that order, and of the pool.
CAPS = dict(zip(STRATEGIES, (30, 30, 20, 20, 30), strict=True))
POOL_CAP = 100
YEAR, WEEK = 364, 7
KEYS = ["window_start", "customer_id"]
#: Allocations of caps that are compared, by name.
SWEEP = {"A": (30, 30, 20, 20, 30), "B": (40, 30, 10, 10, 40), "C": (40, 20, 10, 10, 50), "D": (50, 30, 10, 10, 30), "E": (30, 30, 20, 0, 40)}


def _ranked(df: DataFrame, order: list, cap: int | None) -> DataFrame:
    out = top_k(df, KEYS, order, cap, "rank")
    return out.select(*KEYS, "article_id", F.col("rank").cast("long").alias("rank"))


def _limited(tx: DataFrame, customers: DataFrame | None) -> DataFrame:
    return tx if customers is None else tx.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")


def repurchases(tx: DataFrame, starts: Sequence[Start], cap: int | None = CAPS["repurchase"], customers: DataFrame | None = None) -> DataFrame:
    """Articles a customer bought in the last 52 weeks, latest first."""
    last = in_windows(_limited(tx, customers), starts, YEAR).groupBy(*KEYS, "article_id").agg(F.max("t_dat").alias("t_dat"))
    return _ranked(last, [F.desc("t_dat"), F.col("article_id")], cap)


def colour_variants(tx: DataFrame, articles: DataFrame, starts: Sequence[Start], cap: int | None = CAPS["colour_variant"], customers: DataFrame | None = None) -> DataFrame:
    """Other articles of the products a customer bought, by the latest such purchase.

    An article's latest source is the product's latest bought article, or the
    next if that is the article itself. So two purchases of a product are
    enough, and rows are made for articles to propose, not for pairs of them.
    """
    last = in_windows(_limited(tx, customers), starts, YEAR).groupBy(*KEYS, "article_id").agg(F.max("t_dat").alias("t_dat"))
    product = articles.select("article_id", "product_code")
    bought = last.join(product, "article_id").where("product_code IS NOT NULL")
    two = top_k(bought, [*KEYS, "product_code"], [F.desc("t_dat"), F.col("article_id")], 2, "__k")
    sources = two.groupBy(*KEYS, "product_code").agg(
        F.max(F.when(F.col("__k") == 1, F.struct("t_dat", "article_id"))).alias("first"), F.max(F.when(F.col("__k") == 2, F.col("t_dat"))).alias("next")
    )
    met = sources.join(product, "product_code").withColumn("t_dat", F.when(F.col("article_id") == F.col("first.article_id"), F.col("next")).otherwise(F.col("first.t_dat")))
    return _ranked(met.where("t_dat IS NOT NULL"), [F.desc("t_dat"), F.col("article_id")], cap)


def recent_top(tx: DataFrame, starts: Sequence[Start], cap: int | None = CAPS["recent_popularity"]) -> DataFrame:
    """Articles with most rows in the last week: window_start, article_id, n, rank."""
    counts = in_windows(tx, starts, WEEK).groupBy("window_start", "article_id").agg(F.count("*").alias("n"))
    return top_k(counts, ["window_start"], [F.desc("n"), F.col("article_id")], cap, "rank").withColumn("rank", F.col("rank").cast("long"))


def recent_popularity(top: DataFrame, customers: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """The same most sold articles for every customer.

    The list has at most ``cap`` articles a window, so it is one row a window
    that is broadcast and unfolded beside each customer.
    """
    lists = top.groupBy("window_start").agg(F.collect_list(F.struct("article_id", "rank")).alias("list"))
    everyone = per_window(customers.select("customer_id").distinct(), starts)
    return everyone.join(F.broadcast(lists), "window_start").select(*KEYS, F.inline("list"))


def with_age_bucket(customers: DataFrame) -> DataFrame:
    return customers.withColumn("age_bucket", age_bucket(F.col("age")))


def segment_top(tx: DataFrame, customers: DataFrame, starts: Sequence[Start], cap: int | None = CAPS["segment_popularity"]) -> DataFrame:
    """Most sold articles of the last week by the buyers' age bucket."""
    bought = in_windows(tx, starts, WEEK).join(with_age_bucket(customers).select("customer_id", "age_bucket"), "customer_id")
    counts = bought.groupBy("window_start", "age_bucket", "article_id").agg(F.count("*").alias("n"))
    return top_k(counts, ["window_start", "age_bucket"], [F.desc("n"), F.col("article_id")], cap, "rank").withColumn("rank", F.col("rank").cast("long"))


def segment_popularity(top: DataFrame, customers: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """Each customer's bucket's articles; none for a bucket without sales."""
    lists = top.groupBy("window_start", "age_bucket").agg(F.collect_list(F.struct("article_id", "rank")).alias("list"))
    everyone = per_window(with_age_bucket(customers).select("customer_id", "age_bucket"), starts)
    return everyone.join(F.broadcast(lists), ["window_start", "age_bucket"]).select(*KEYS, F.inline("list"))


def strategies(tx: DataFrame, articles: DataFrame, customers: DataFrame, starts: Sequence[Start], caps: Mapping[str, int | None] = CAPS, als: DataFrame | None = None) -> dict[str, DataFrame]:
    """The frames of all strategies; ``als`` if its candidates are given."""
    out = {
        "repurchase": repurchases(tx, starts, caps["repurchase"]),
        "colour_variant": colour_variants(tx, articles, starts, caps["colour_variant"]),
        "recent_popularity": recent_popularity(recent_top(tx, starts, caps["recent_popularity"]), customers, starts),
        "segment_popularity": segment_popularity(segment_top(tx, customers, starts, caps["segment_popularity"]), customers, starts),
    }
    return out if als is None else {**out, "als": als.select(*KEYS, "article_id", F.col("rank").cast("long").alias("rank"))}


def union_of(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All candidates of all strategies with the strategy's name."""
    out = None
    for name, df in frames.items():
        part = df.select(*KEYS, "article_id", "rank", F.lit(name).alias("strategy"))
        out = part if out is None else out.unionByName(part)
    return out


def pooled(frames: Mapping[str, DataFrame] | DataFrame, cap: int | None = POOL_CAP) -> DataFrame:
    """One row per pair: strategies, their number, best rank and each strategy's rank; best ``cap`` a customer."""
    every = frames if isinstance(frames, DataFrame) else union_of(frames)
    # dealt by customer once; grouping by pair and ranking by customer both keep that partitioning
    return _merged(every.repartition(*KEYS), cap)


def _merged(dealt: DataFrame, cap: int | None) -> DataFrame:
    """The pool of candidates that are dealt by customer."""
    merged = dealt.groupBy(*KEYS, "article_id").agg(
        F.min("rank").alias("best_rank"),
        *[F.min(F.when(F.col("strategy") == s, F.col("rank"))).alias(f"rank_{s}") for s in STRATEGIES],
    )
    # a strategy proposed the pair if it has a rank; collecting names would leave hash aggregation
    names = F.array_compact(F.array(*[F.when(F.col(f"rank_{s}").isNotNull(), s) for s in sorted(STRATEGIES)]))
    merged = merged.withColumn("strategies", names).withColumn("n_strategies", F.size("strategies").cast("long"))
    out = merged if cap is None else top_k(merged, KEYS, [F.desc("n_strategies"), F.col("best_rank"), F.col("article_id")], cap, "pool_rank")
    return out.select(*KEYS, "article_id", "strategies", "n_strategies", "best_rank", *[f"rank_{s}" for s in STRATEGIES])


def pool(own: Mapping[str, DataFrame], recent: DataFrame, segments: DataFrame, customers: DataFrame, starts: Sequence[Start], cap: int = POOL_CAP) -> DataFrame:
    """The pool of the ``own`` strategies at their ``CAPS`` and of both popularity lists, as ``pooled`` has it.

    Only customers' own candidates and one row a customer are dealt; the lists
    are broadcast and unfolded after that. No customer has more candidates than
    the strategies' caps allow, so nothing is ranked if those fit in ``cap``.
    """
    entry = "array<struct<article_id:string,rank:bigint,strategy:string>>"
    listed = lambda top, keys, name: top.groupBy(*keys).agg(F.collect_list(F.struct("article_id", "rank", F.lit(name).alias("strategy"))).cast(entry).alias(name))
    mine = union_of(own).select(*KEYS, F.lit(None).cast("string").alias("age_bucket"), F.array(F.struct("article_id", "rank", "strategy")).cast(entry).alias("mine"))
    each = per_window(with_age_bucket(customers).select("customer_id", "age_bucket"), starts).select(*KEYS, "age_bucket", F.lit(None).cast(entry).alias("mine"))
    dealt = mine.unionByName(each).repartition(*(KEYS if len(set(map(str, starts))) > 1 else ["customer_id"]))
    met = dealt.join(F.broadcast(listed(recent, ["window_start"], "recent_popularity")), "window_start", "left")
    met = met.join(F.broadcast(listed(segments, ["window_start", "age_bucket"], "segment_popularity")), ["window_start", "age_bucket"], "left")
    none = F.array().cast(entry)
    popular = F.concat(F.coalesce("recent_popularity", none), F.coalesce("segment_popularity", none))
    every = met.select(*KEYS, F.inline(F.coalesce("mine", popular)))
    names = [*own, "recent_popularity", "segment_popularity"]
    return _merged(every, cap if sum(CAPS[s] for s in names) > cap else None)


def without_candidates(pool: DataFrame, customers: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """Customers and windows that have no candidate."""
    return per_window(customers.select("customer_id").distinct(), starts).join(pool.select(*KEYS).distinct(), KEYS, "left_anti")


def require_candidates(pool: DataFrame, customers: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """The pool; raises if a customer has no candidate."""
    missing = without_candidates(pool, customers, starts).head(1)
    if missing:
        raise ValueError(f"customer {missing[0]['customer_id']} has no candidate")
    return pool


def capped(uncapped: DataFrame, allocation: Sequence[int]) -> DataFrame:
    """Candidates of all strategies cut to an allocation of caps."""
    caps = F.create_map(*[x for s, c in zip(STRATEGIES, allocation, strict=True) for x in (F.lit(s), F.lit(c))])
    return uncapped.where(F.col("rank") <= caps[F.col("strategy")])


def cap_reach(frame: DataFrame, caps: int) -> DataFrame:
    """Of an uncapped strategy: customers, those at or over the cap, rows, share, mean."""
    sizes = frame.groupBy(*KEYS).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("*").alias("customers"), F.count_if(F.col("n") >= caps).alias("at_cap"), F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.avg((F.col("n") >= caps).cast("int")).alias("share_at_cap"), F.avg("n").alias("mean_rows"),
    )


def report(every: DataFrame, pool: DataFrame) -> DataFrame:
    """Rows of each strategy and of the pool, and customers with any."""
    count = lambda df, key: df.groupBy(*key).agg(F.count("*").alias("n_rows"), F.countDistinct("customer_id").alias("n_customers"))
    return count(every, ["strategy"]).unionByName(count(pool.withColumn("strategy", F.lit("pool")), ["strategy"]))
