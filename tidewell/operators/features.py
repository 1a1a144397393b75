"""Features of customers, articles and pairs from history before each window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import cosine, ratio
from tidewell.functions.frames import Start, in_windows, join_small, per_window, top_k
from tidewell.operators.candidates import KEYS, STRATEGIES, with_age_bucket
from tidewell.sources.shared import collect_garbage, written

TRAILING = (("1w", 7), ("4w", 28), ("12w", 84))
RECENT = 10
#: About how many bytes a row of the article block takes besides its vector.
ARTICLE_ROW = 300
#: About how many customers, once for each window, ``build`` takes at once; their pairs are shuffled with all that belongs to articles.
SLICE = 150_000
#: Attributes of an article by which a customer's purchases are summed.
TRAITS = ["product_code", "colour_group_name", "department_name"]

#: Names and order of the model's columns.
CUSTOMER_COUNTS = ["txn_count_total", "distinct_article_count_total", *[f"{c}_{w}" for w, _ in TRAILING for c in ("txn_count", "distinct_article_count")]]
CATEGORICAL = ["club_member_status", "fashion_news_frequency", "age_bucket", "product_type_name", "department_name", "index_group_name", "garment_group_name"]
PAIR = ["prior_purchase_count_this_article", "days_since_last_purchase_this_article", "prior_purchase_count_same_product_code", "prior_purchase_count_same_colour", "prior_purchase_count_same_department", "price_ratio_to_customer_mean", "text_cosine_similarity"]
PROVENANCE = ["n_strategies", "best_rank", *[f"rank_{s}" for s in STRATEGIES], *[f"from_{s}" for s in STRATEGIES]]
CUSTOMER = ["club_member_status", "fashion_news_frequency", "age_bucket", "txn_count_total", "distinct_article_count_total", "mean_purchase_price", "std_purchase_price", "share_sales_channel_1", "share_sales_channel_2", *CUSTOMER_COUNTS[2:], "days_since_last_purchase"]
ARTICLE = ["product_type_name", "department_name", "index_group_name", "garment_group_name", "article_mean_price", "distinct_buyers_total", "purchase_count_1w", "purchase_count_4w", "purchase_count_12w", "purchase_count_wow_trend", "days_since_first_sale", "days_since_last_sale"]
FEATURES = [*PAIR, *PROVENANCE, *CUSTOMER, *ARTICLE]


def _since(days: int) -> Column:
    return F.col("t_dat") >= F.date_sub("window_start", days)


def customer_features(tx: DataFrame, customers: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """One row per customer and window; counts of customers without history are 0, the rest null.

    Rows are summed before they are shuffled, so a customer with very many rows
    is no task of its own; distinct articles come from the customer's articles.
    """
    history = in_windows(tx, starts, None)
    rows = history.groupBy(*KEYS).agg(
        F.count("*").alias("txn_count_total"), F.avg("price").alias("mean_purchase_price"), F.stddev_samp("price").alias("std_purchase_price"),
        F.max("t_dat").alias("__last"),
        *[F.avg((F.col("sales_channel_id") == c).cast("int")).alias(f"share_sales_channel_{c}") for c in (1, 2)],
        *[F.count_if(_since(d)).alias(f"txn_count_{w}") for w, d in TRAILING],
    )
    pairs = history.groupBy(*KEYS, "article_id").agg(F.max("t_dat").alias("t_dat"))
    kinds = pairs.groupBy(*KEYS).agg(F.count("article_id").alias("distinct_article_count_total"), *[F.count_if(_since(d) & F.col("article_id").isNotNull()).alias(f"distinct_article_count_{w}") for w, d in TRAILING])
    everyone = per_window(with_age_bucket(customers).select("customer_id", "club_member_status", "fashion_news_frequency", "age_bucket"), starts)
    out = everyone.join(rows.join(kinds, KEYS), KEYS, "left").withColumn("days_since_last_purchase", F.datediff("window_start", "__last").cast("long"))
    return out.fillna(0, CUSTOMER_COUNTS).select(*KEYS, *CUSTOMER)


def article_features(tx: DataFrame, articles: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """One row per article and window; counts without sales are 0, price and ages null."""
    history = in_windows(tx, starts, None)
    last_week, week_before = _since(7), _since(14) & ~_since(7)
    sales = history.groupBy("window_start", "article_id").agg(
        F.avg("price").alias("article_mean_price"),
        *[F.count_if(_since(d)).alias(f"purchase_count_{w}") for w, d in TRAILING],
        (F.count_if(last_week) - F.count_if(week_before)).alias("purchase_count_wow_trend"),
        F.min("t_dat").alias("__first"), F.max("t_dat").alias("__last"),
    )
    buyers = history.groupBy("window_start", "article_id", "customer_id").agg(F.lit(1).alias("one")).groupBy("window_start", "article_id").agg(F.count("customer_id").alias("distinct_buyers_total"))
    every = per_window(articles.select("article_id", "product_type_name", "department_name", "index_group_name", "garment_group_name"), starts)
    out = every.join(sales, ["window_start", "article_id"], "left").join(buyers, ["window_start", "article_id"], "left")
    out = out.withColumn("days_since_first_sale", F.datediff("window_start", "__first").cast("long")).withColumn("days_since_last_sale", F.datediff("window_start", "__last").cast("long"))
    counts = ["distinct_buyers_total", "purchase_count_wow_trend", *[f"purchase_count_{w}" for w, _ in TRAILING]]
    return out.fillna(0, counts).select("window_start", "article_id", *ARTICLE)


def recent_text_mean(tx: DataFrame, vectors: DataFrame, starts: Sequence[Start], recent: int = RECENT, customers: DataFrame | None = None) -> DataFrame:
    """Mean vector of a customer's last ``recent`` rows that have one; repeats count.

    Rows are ranked before those without a vector go; customers with none are
    absent. Means are taken over each place of the vectors by one group.
    """
    tx = tx if customers is None else tx.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")
    last = top_k(in_windows(tx, starts, None).select(*KEYS, "article_id", "t_dat"), KEYS, [F.desc("t_dat"), F.col("article_id")], recent, "__n")
    size = dimensions(vectors)
    met = join_small(last, vectors, ["article_id"], 8 * size, "inner")
    return met.groupBy(*KEYS).agg(F.array(*[F.avg(F.get("vector", F.lit(k))) for k in range(size)]).cast("array<double>").alias("recent_vector"))


def dimensions(vectors: DataFrame) -> int:
    """Places of the vectors, which all have as many."""
    first = vectors.select(F.size("vector").alias("n")).where("n > 0").head(1)
    return first[0]["n"] if first else 0


def article_block(articles: DataFrame, articles_before: DataFrame, vectors: DataFrame, starts: Sequence[Start], also: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """What pairs need of an article, one row for each window and article, as a table; and about how many bytes a row takes."""
    traits = per_window(articles.select("article_id", *TRAITS), starts)
    before = articles_before.select("window_start", "article_id", *dict.fromkeys(["article_mean_price", *also]))
    key = ["window_start", "article_id"]
    block = written(traits.join(before, key, "full").join(per_window(vectors.select("article_id", "vector"), starts), key, "full"), "block")
    held = block.agg(F.count("*").alias("n"), F.count("vector").alias("vectors"), F.max(F.size("vector")).alias("size")).first()
    return block, ARTICLE_ROW + 8 * max(held["size"] or 0, 0) * held["vectors"] // max(held["n"], 1)


def pair_features(candidates: DataFrame, tx: DataFrame, articles: DataFrame, customers: DataFrame, articles_before: DataFrame, vectors: DataFrame, recent: DataFrame, starts: Sequence[Start], keep: Sequence[str] = (), also: Sequence[str] = (), block: tuple[DataFrame, int] | None = None) -> DataFrame:
    """The seven features of a pair, the ``keep`` columns of the candidates and the ``also`` columns of both blocks.

    ``customers`` and ``articles_before`` are the customer and article blocks;
    ``block`` is what ``article_block`` gave, if it was made before.
    History is summed by customer and article. Candidates and those sums meet
    all that belongs to articles in one join, and are dealt by customer together,
    once; popular articles' rows meet it by broadcast after that, if it is large.
    Sums by each attribute are windows inside that partitioning, and what belongs
    to customers is joined in it.
    """
    of_customer = list(dict.fromkeys(["mean_purchase_price", *(c for c in also if c in customers.columns)]))
    of_article = list(dict.fromkeys(["article_mean_price", *(c for c in also if c in articles_before.columns and c not in TRAITS)]))
    block, row_bytes = block or article_block(articles, articles_before, vectors, starts, of_article)
    asked = candidates.select(*KEYS, "article_id", *keep, F.lit(True).alias("__asked"))
    past = in_windows(tx, starts, None)
    history = past.groupBy(*KEYS, "article_id").agg(F.count("*").alias("__n"), F.max("t_dat").alias("__last")).withColumn("__asked", F.lit(False))
    counted = candidates.select("window_start", "article_id").unionByName(past.select("window_start", "article_id"))
    # a single window's start is in no join's key: dealt by both, rows would be shuffled again for each join
    by = KEYS if len(set(map(str, starts))) > 1 else ["customer_id"]
    deal = lambda df: df.withColumns({c: F.when(F.col("__asked"), F.col(c)) for c in [*of_article, "vector"]}).repartition(*by)
    rows = join_small(asked.unionByName(history, allowMissingColumns=True), block, ["window_start", "article_id"], row_bytes, counted=counted, deal=deal)
    # a hash goes first since sorts compare it as a number, ids as texts
    within = lambda c: Window.partitionBy(F.xxhash64("customer_id", c), *KEYS, c)
    own = within("article_id")
    rows = rows.withColumns({PAIR[0]: F.sum("__n").over(own), "__own": F.max("__last").over(own)})
    for trait, name in zip(TRAITS, PAIR[2:5], strict=True):
        rows = rows.withColumn(name, F.when(F.col(trait).isNotNull(), F.sum("__n").over(within(trait))))
    pairs = rows.where("__asked").withColumn(PAIR[1], F.datediff("window_start", "__own").cast("long"))
    pairs = pairs.select(*KEYS, "article_id", *keep, *of_article, *(c for c in also if c in TRAITS), "vector", *PAIR[:5])
    # joined by what they are dealt by, else written sides' window starts would have them shuffled again; one row a customer is hashed, so pairs aren't sorted
    for side, columns in ((customers, of_customer), (recent, ["recent_vector"])):
        pairs = pairs.join(side.select(*by, *columns).hint("shuffle_hash"), by, "left")
    pairs = pairs.withColumn(PAIR[5], ratio(F.col("article_mean_price"), F.col("mean_purchase_price"))).withColumn(PAIR[6], cosine(F.col("vector"), F.col("recent_vector")))
    return pairs.fillna(0, [PAIR[0], *PAIR[2:5]]).select(*KEYS, "article_id", *keep, *PAIR, *also)


def provenance_features(candidates: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Ranks as they are, and a flag for each strategy that proposed the pair."""
    flags = [F.array_contains("strategies", s).alias(f"from_{s}") for s in STRATEGIES]
    return candidates.select(*KEYS, "article_id", "n_strategies", "best_rank", *[f"rank_{s}" for s in STRATEGIES], *flags, *keep)


def assembled(pairs: DataFrame, provenance: DataFrame, customers: DataFrame, articles: DataFrame) -> DataFrame:
    """All features of each pair."""
    out = pairs.join(provenance, [*KEYS, "article_id"]).join(customers, KEYS, "left").join(articles, ["window_start", "article_id"], "left")
    return out.select(*KEYS, "article_id", *FEATURES)


def _blocks(candidates: DataFrame, tx: DataFrame, articles: DataFrame, customers: DataFrame, vectors: DataFrame, starts: Sequence[Start], what: DataFrame, keep: Sequence[str] = (), block: tuple[DataFrame, int] | None = None) -> DataFrame:
    """All features of the candidates in one pass over them: provenance and both blocks are kept, not joined."""
    who = customer_features(tx, customers, starts)
    recent = recent_text_mean(tx, vectors, starts)
    marked = provenance_features(candidates, keep)
    pairs = pair_features(marked, tx, articles, who, what, vectors, recent, starts, [*PROVENANCE, *keep], [*CUSTOMER, *ARTICLE], block)
    return pairs.select(*KEYS, "article_id", *FEATURES, *keep)


def categories(pairs: DataFrame, articles: DataFrame, customers: DataFrame) -> DataFrame:
    """The categorical features alone, as ``build`` has them: they are attributes, so no history is read."""
    who = with_age_bucket(customers).select("customer_id", *(c for c in CATEGORICAL if c in CUSTOMER))
    what = articles.select("article_id", *(c for c in CATEGORICAL if c in ARTICLE))
    return pairs.select(*KEYS, "article_id").join(who, "customer_id", "left").join(what, "article_id", "left").select(*KEYS, "article_id", *CATEGORICAL)


def build(candidates: DataFrame, tx: DataFrame, articles: DataFrame, customers: DataFrame, vectors: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """All features of the candidates of the given windows.

    More than ``SLICE`` customers are taken in slices by a hash of the id, each
    written before the next, so that no more than a slice's pairs are shuffled at
    a time. Articles' features are of all customers and made once. ``tx`` and the
    candidates are read for each slice and should be tables.
    """
    what = article_features(tx, articles, starts)
    slices = -(-customers.count() * len(starts) // SLICE)
    if slices <= 1:
        return _blocks(candidates, tx, articles, customers, vectors, starts, what)
    collect_garbage(tx.sparkSession)
    block = article_block(articles, what, vectors, starts, [c for c in ARTICLE if c not in TRAITS])
    out = None
    for k in range(slices):
        of = lambda df: df.where(F.pmod(F.xxhash64("customer_id"), F.lit(slices)) == k)  # noqa: B023, E731
        collect_garbage(tx.sparkSession)
        part = written(_blocks(of(candidates), of(tx), articles, of(customers), vectors, starts, what, block=block), "features")
        out = part if out is None else out.unionByName(part)
    return out


def training_matrix(labelled: DataFrame, tx: DataFrame, articles: DataFrame, customers: DataFrame, vectors: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """Features of the labelled pairs only, with their labels.

    Blocks are made for the customers of those pairs, and for the articles of
    the pairs and of what these customers have bought; no other row meets a pair.
    """
    some = customers.join(labelled.select("customer_id").distinct(), "customer_id", "left_semi")
    scoped = written(tx.join(some.select("customer_id"), "customer_id", "left_semi"), "scoped")
    met = written(labelled.select("article_id").unionByName(scoped.select("article_id")).distinct(), "met")
    of = lambda df: df.join(met, "article_id", "left_semi")
    return _blocks(labelled, scoped, of(articles), some, of(vectors), starts, article_features(of(tx), of(articles), starts), ["label"])
