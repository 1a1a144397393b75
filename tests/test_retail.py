"""Worked examples of the retail operators, with expected values found by hand."""

from __future__ import annotations

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions.columns import age_bucket, cosine
from tidewell.functions.frames import global_rank, percentiles
from tidewell.operators import calibrate, candidates, contracts, drift, evaluate, features, models, offers, periods, store, text

WS = datetime.date(2020, 9, 16)
D = lambda month, day: datetime.date(2020, month, day)
TX = "t_dat date, customer_id string, article_id string, price double, sales_channel_id int"


def tx_of(spark, rows):
    return spark.createDataFrame([(d, c, a, float(p), s) for d, c, a, p, s in rows], TX)


#: Purchases of a made-up bookshop: reader, book, day of September. Ida has bought nothing.
PURCHASES = [
    ("ben", "atlas", 2), ("ben", "atlas", 13), ("ben", "novel", 14),
    ("cleo", "novel", 10), ("cleo", "poems", 10), ("dan", "novel", 15), ("dan", "comic", 15),
    ("eve", "poems", 12), ("eve", "comic", 11), ("fay", "novel", 4), ("gus", "comic", 14), ("gus", "comic", 9),
]
#: The work of which a book is an edition.
EDITIONS = {"atlas": "maps", "atlas-2": "maps", "novel": "prose", "novel-2": "prose", "novel-3": "prose", "poems": "verse", "comic": "strips"}
AGES = {"ben": 31, "cleo": 33, "dan": 52, "eve": None, "fay": 33, "gus": 70, "ida": 28}


@pytest.fixture(scope="module")
def shop(spark):
    tx = tx_of(spark, [(D(9, day), reader, book, 4.5, 2) for reader, book, day in PURCHASES])
    return tx, spark.createDataFrame(list(EDITIONS.items()), "article_id string, product_code string"), spark.createDataFrame(list(AGES.items()), "customer_id string, age int")


def test_age_buckets_are_right_closed(spark):
    ages = [24, 25, 26, 35, 36, 45, 55, 65, 66, None]
    rows = spark.createDataFrame([(k, a) for k, a in enumerate(ages)], "k int, age int").select("k", age_bucket(F.col("age")).alias("b")).orderBy("k").collect()
    assert [r.b for r in rows] == ["<25", "<25", "25-34", "25-34", "35-44", "35-44", "45-54", "55-64", "65+", "unknown"]


def test_horizons_of_retrieval(spark):
    days = {"first": 364, "too-old": 365, "yesterday": 1, "today": 0, "tomorrow": -1}
    tx = tx_of(spark, [(WS - datetime.timedelta(days=n), "ben", book, 1, 1) for book, n in days.items()])
    assert [(r.article_id, r["rank"]) for r in candidates.repurchases(tx, [WS]).orderBy("rank").collect()] == [("yesterday", 1), ("first", 2)]


def test_strategies(shop):
    tx, articles, customers = shop
    by_reader = lambda df, who: [r.article_id for r in df.where(F.col("customer_id") == who).orderBy("rank").collect()]
    again = candidates.repurchases(tx, [WS])
    assert {w: by_reader(again, w) for w in AGES} == {"ben": ["novel", "atlas"], "cleo": ["novel", "poems"], "dan": ["comic", "novel"], "eve": ["poems", "comic"], "fay": ["novel"], "gus": ["comic"], "ida": []}
    variants = candidates.colour_variants(tx, articles, [WS])
    assert by_reader(variants, "ben") == ["novel-2", "novel-3", "atlas-2"] and by_reader(variants, "fay") == ["novel-2", "novel-3"] and by_reader(variants, "eve") == []
    both = candidates.colour_variants(tx.unionByName(tx_of(tx.sparkSession, [(D(9, 8), "ben", "novel-2", 1, 1)])), articles, [WS])
    assert by_reader(both, "ben") == ["novel-2", "novel-3", "atlas-2", "novel"]  # each edition by the latest purchase of another one
    top = candidates.recent_top(tx, [WS]).orderBy("rank").collect()
    assert [(r.article_id, r.n) for r in top] == [("comic", 4), ("novel", 3), ("poems", 2), ("atlas", 1)]
    assert candidates.recent_popularity(candidates.recent_top(tx, [WS], 3), customers, [WS]).count() == 3 * len(AGES)
    segment = candidates.segment_popularity(candidates.segment_top(tx, customers, [WS]), customers, [WS])
    assert by_reader(segment, "ida") == by_reader(segment, "cleo") == ["novel", "atlas", "poems"] and by_reader(segment, "gus") == ["comic"] and by_reader(segment, "eve") == ["comic", "poems"]


def test_pool_is_consistent_and_the_same_twice(shop):
    tx, articles, customers = shop
    build = lambda: candidates.pooled(candidates.strategies(tx, articles, customers, [WS]))
    first, second = build(), build()
    assert first.exceptAll(second).count() == 0 == second.exceptAll(first).count()
    rows = first.collect()
    for r in rows:
        ranks = {s: r[f"rank_{s}"] for s in candidates.STRATEGIES if r[f"rank_{s}"] is not None}
        assert (sorted(ranks), len(ranks), min(ranks.values())) == (r.strategies, r.n_strategies, r.best_rank)
    assert {r.customer_id for r in rows} == set(AGES)
    small = candidates.pooled(candidates.strategies(tx, articles, customers, [WS]), 2).groupBy("customer_id").count().collect()
    assert {r["count"] for r in small} == {2}
    with pytest.raises(ValueError, match="ida"):
        candidates.require_candidates(candidates.pooled({"repurchase": candidates.repurchases(tx, [WS])}), customers, [WS])


@pytest.mark.parametrize("cap", [3, 40])
def test_als_with_one_very_heavy_customer(spark, cap):
    from tidewell.operators import als

    rows = [(D(8, 1), f"c{k:02d}", f"a{(k * 7 + j) % 60:02d}", 1, 1) for k in range(40) for j in range(1 + k % 4)]
    rows += [(D(8, 2), "heavy", f"a{j:02d}", 1, 1) for j in range(55)]
    tx = tx_of(spark, rows)
    fitted = als.fit(tx, WS, 4, 2)
    asked, real = [], type(fitted.model).recommendForUserSubset
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(fitted.model), "recommendForUserSubset", lambda self, users, n: asked.append((users.count(), n)) or real(self, users, n))
        got = als.recommend(fitted, WS, cap).collect()
    assert sorted(asked) == sorted([(1, cap + 55), (10, cap + 1), (20, cap + 3), (10, cap + 4)])
    bought = {(c, a) for _, c, a, *_ in rows}
    known = len({a for _, a in bought})
    by = {}
    for r in got:
        by.setdefault(r.customer_id, []).append(r.article_id)
    assert not bought & {(r.customer_id, r.article_id) for r in got}
    assert {c: len(a) for c, a in by.items()} == {c: min(cap, known - sum(x == c for x, _ in bought)) for c in {c for c, _ in bought} if known > sum(x == c for x, _ in bought)}


def test_windows_together_are_windows_apart(shop):
    tx, articles, customers = shop
    starts = [D(9, 12), WS]
    both = candidates.pooled(candidates.strategies(tx, articles, customers, starts))
    for s in starts:
        alone = candidates.pooled(candidates.strategies(tx, articles, customers, [s]))
        assert both.where(F.col("window_start") == F.lit(s)).exceptAll(alone).count() == 0 == alone.exceptAll(both).count()


@pytest.mark.parametrize("cap", [100, 3])
def test_popularity_lists_are_unfolded_after_customers_are_dealt(shop, cap):
    tx, articles, customers = shop
    for starts in ([WS], [D(9, 12), WS]):
        whole = candidates.pooled(candidates.strategies(tx, articles, customers, starts), cap)
        own = {"repurchase": candidates.repurchases(tx, starts), "colour_variant": candidates.colour_variants(tx, articles, starts)}
        got = candidates.pool(own, candidates.recent_top(tx, starts), candidates.segment_top(tx, customers, starts), customers, starts, cap)
        assert got.columns == whole.columns and sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(k for k, x in enumerate(plan) if "REPARTITION_BY_COL" in x)
        assert any("Generate inline" in x for x in plan[:at]) and (cap == 3) == any("Window" in x for x in plan[:at])


def test_label_windows(spark):
    rows = periods.label_windows(spark, WS).collect()
    assert [(r.window_start, r.window_end) for r in rows] == [(D(8, 19), D(8, 25)), (D(8, 26), D(9, 1)), (D(9, 2), D(9, 8)), (D(9, 9), D(9, 15)), (WS, D(9, 22))]


def test_labels_stay_inside_the_window(spark):
    start = D(8, 26)
    offered = {"ben": ["atlas", "novel", "poems", "comic", "essay", "diary"], "cleo": ["atlas", "novel"], "dan": ["poems"]}
    pool = spark.createDataFrame([(start, who, book) for who, books in offered.items() for book in books], "window_start date, customer_id string, article_id string")
    days = {("ben", "novel"): D(8, 26), ("ben", "poems"): D(9, 1), ("ben", "comic"): D(8, 25), ("ben", "unseen"): D(8, 28), ("cleo", "atlas"): D(9, 2), ("dan", "poems"): D(8, 20)}
    tx = tx_of(spark, [(day, who, book, 1, 1) for (who, book), day in days.items()])
    got = periods.training_labels(pool, periods.actual_purchases(tx, [start]), negatives=1).collect()
    # the first and the last day count, the days beside them don't; two purchases get two others, and nobody else has any
    assert sorted(r.article_id for r in got if r.label) == ["novel", "poems"] and {r.customer_id for r in got} == {"ben"} and len(got) == 4


SHOES = "article_id string, product_code string, colour_group_name string, department_name string, product_type_name string, index_group_name string, garment_group_name string"


@pytest.fixture(scope="module")
def detail(spark):
    """Two walkers with purchases, one without, and one purchase on the window's first day."""
    bought = [("mia", "boot", 30, 2, D(9, 1)), ("mia", "clog", 60, 1, D(8, 10)), ("mia", "boot", 36, 2, D(9, 11)), ("mia", "sock", 500, 1, WS), ("noa", "boot", 24, 1, D(6, 10)), ("noa", "clog", 40, 2, D(9, 14))]
    tx = tx_of(spark, [(day, who, shoe, price, channel) for who, shoe, price, channel, day in bought])
    articles = spark.createDataFrame([("boot", "leather", "brown", "winter", "high", "g1", "h1"), ("clog", "wood", "brown", "summer", "low", "g1", "h1"), ("sock", "wool", "grey", "winter", "soft", "g2", "h2"), ("lace", None, None, None, "soft", "g2", "h2")], SHOES)
    customers = spark.createDataFrame([("mia", 44, "gold", None), ("noa", None, None, "weekly"), ("otto", 66, "gold", None)], "customer_id string, age int, club_member_status string, fashion_news_frequency string")
    vectors = spark.createDataFrame([("boot", [3.0, 0.0, 4.0]), ("clog", [0.0, 2.0, 0.0])], "article_id string, vector array<double>")
    return tx, articles, customers, vectors


def test_customer_features(detail):
    tx, _, customers, _ = detail
    got = {r.customer_id: r for r in features.customer_features(tx, customers, [WS]).collect()}
    mia, noa, otto = (got[k] for k in ("mia", "noa", "otto"))
    assert (mia.txn_count_total, mia.distinct_article_count_total, mia.mean_purchase_price, mia.days_since_last_purchase) == (3, 2, 42.0, 5)
    assert (mia.txn_count_1w, mia.txn_count_4w, mia.txn_count_12w, mia.distinct_article_count_4w, mia.distinct_article_count_12w) == (1, 2, 3, 1, 2)
    assert (mia.share_sales_channel_2, mia.std_purchase_price) == (pytest.approx(2 / 3), pytest.approx(((12**2 + 18**2 + 6**2) / 2) ** 0.5))
    assert (noa.txn_count_total, noa.txn_count_12w, noa.age_bucket, noa.fashion_news_frequency) == (2, 1, "unknown", "weekly")
    assert (otto.txn_count_total, otto.txn_count_1w, otto.days_since_last_purchase, otto.mean_purchase_price, otto.age_bucket) == (0, 0, None, None, "65+")


def test_article_features(detail, spark):
    tx, articles, *_ = detail
    got = {r.article_id: r for r in features.article_features(tx, articles, [WS]).collect()}
    boot, sock = got["boot"], got["sock"]
    assert (boot.distinct_buyers_total, boot.article_mean_price, boot.purchase_count_4w, boot.days_since_first_sale, boot.days_since_last_sale) == (2, 30.0, 2, 98, 5)
    assert (sock.distinct_buyers_total, sock.article_mean_price, sock.purchase_count_12w, sock.days_since_last_sale) == (0, None, 0, None)
    weeks = tx_of(spark, [(WS - datetime.timedelta(days=n), "mia", "boot", 1, 1) for n in (1, 3, 7, 8, 14, 15)])
    assert features.article_features(weeks, articles, [WS]).where("article_id = 'boot'").first().purchase_count_wow_trend == 3 - 2


@pytest.mark.parametrize("most", [1 << 27, 0])
def test_pair_features(detail, spark, monkeypatch, most):
    from tidewell.functions import frames

    monkeypatch.setattr(frames.join_small, "__defaults__", ("left", most))  # broadcast, or salted
    tx, articles, customers, vectors = detail
    who, what = features.customer_features(tx, customers, [WS]), features.article_features(tx, articles, [WS])
    asked = [("mia", "boot"), ("mia", "sock"), ("mia", "lace"), ("otto", "clog")]
    pairs = spark.createDataFrame([(WS, *p) for p in asked], "window_start date, customer_id string, article_id string")
    found = features.pair_features(pairs, tx, articles, who, what, vectors, features.recent_text_mean(tx, vectors, [WS]), [WS])
    got = {(r.customer_id, r.article_id): tuple(r[c] for c in features.PAIR) for r in found.collect()}
    mean = [2.0, 2 / 3, 8 / 3]  # of two boots and a clog
    near = (3 * mean[0] + 4 * mean[2]) / (5 * sum(x * x for x in mean) ** 0.5)
    assert got["mia", "boot"] == (2, 5, 2, 3, 2, pytest.approx(30 / 42), pytest.approx(near))
    assert got["mia", "sock"] == (0, None, 0, 0, 2, None, 0.0) and got["mia", "lace"] == (0, None, 0, 0, 0, None, 0.0)
    assert got["otto", "clog"] == (0, None, 0, 0, 0, None, 0.0)


def test_the_training_matrix_makes_blocks_of_what_its_pairs_meet(detail, spark, monkeypatch):
    tx, articles, customers, vectors = detail
    asked, real = [], features.article_features
    monkeypatch.setattr(features, "article_features", lambda tx, articles, starts: asked.append(sorted(r.article_id for r in articles.collect())) or real(tx, articles, starts))
    ranks = ", ".join(f"rank_{s} long" for s in candidates.STRATEGIES)
    labelled = spark.createDataFrame([(WS, "noa", "boot", ["als"], 1, 1, None, None, None, None, 1, 1)], f"window_start date, customer_id string, article_id string, strategies array<string>, n_strategies long, best_rank long, {ranks}, label int")
    got = features.training_matrix(labelled, tx, articles, customers, vectors, [WS]).collect()
    whole = features.build(labelled, tx, articles, customers, vectors, [WS]).collect()
    assert asked == [["boot", "clog"], ["boot", "clog", "lace", "sock"]]  # noa has bought a boot and a clog
    assert len(got) == 1 and [got[0][c] for c in features.FEATURES] == [whole[0][c] for c in features.FEATURES]


def test_features_in_slices_of_customers_are_the_same(detail, spark, monkeypatch):
    tx, articles, customers, vectors = detail
    ranks = ", ".join(f"rank_{s} long" for s in candidates.STRATEGIES)
    starts = [WS, WS - datetime.timedelta(days=7)]
    rows = [(ws, who, what, ["als"], 1, 1, None, None, None, None, 1) for ws in starts for who in ("noa", "mia", "otto", "new", None) for what in ("boot", "lace", "new", "clog")]
    pairs = spark.createDataFrame(rows, f"window_start date, customer_id string, article_id string, strategies array<string>, n_strategies long, best_rank long, {ranks}")
    whole = features.build(pairs, tx, articles, customers, vectors, starts)
    asked, real = [], features._blocks
    monkeypatch.setattr(features, "SLICE", 2)
    monkeypatch.setattr(features, "_blocks", lambda few, *a, **k: asked.append(few.count()) or real(few, *a, **k))
    got = features.build(pairs, tx, articles, customers, vectors, starts)
    assert sum(asked) == 40 > max(asked) and len(asked) == 3
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.columns == whole.columns


def test_pairs_of_one_window_are_dealt_to_customers_once(detail, spark):
    tx, articles, customers, vectors = detail
    ranks = ", ".join(f"rank_{s} long" for s in candidates.STRATEGIES)
    pairs = spark.createDataFrame([(WS, "mia", "boot", ["als"], 1, 1, None, None, None, None, 1)], f"window_start date, customer_id string, article_id string, strategies array<string>, n_strategies long, best_rank long, {ranks}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = features.build(pairs, tx, articles, customers, vectors, [WS])._jdf.queryExecution().executedPlan()
        dealt = plan.toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(k for k, x in enumerate(dealt) if "REPARTITION_BY_COL" in x)
    assert not [x for x in dealt[:at] if "Exchange" in x]  # none above it, around the joins with what belongs to customers


def test_popular_articles_meet_pairs_after_they_are_dealt_once(detail, spark, monkeypatch):
    """With articles that aren't broadcast: the same features, no shuffle around the dealing, and popular ones' rows are narrow in it."""
    from tidewell.functions import frames

    tx, articles, customers, vectors = detail
    ranks = ", ".join(f"rank_{s} long" for s in candidates.STRATEGIES)
    rows = [(WS, who, what, ["als"], 1, 1, None, None, None, None, 1) for who in ("noa", "mia", "otto", "new", None) for what in ("boot", "lace", "new", "clog")]
    pairs = spark.createDataFrame(rows, f"window_start date, customer_id string, article_id string, strategies array<string>, n_strategies long, best_rank long, {ranks}")
    whole = sorted(map(str, features.build(pairs, tx, articles, customers, vectors, [WS]).collect()))
    monkeypatch.setattr(frames.join_small, "__defaults__", ("left", 0))
    monkeypatch.setattr(frames, "HEAVY", 4)  # boots and clogs have over a fourth of the rows, laces and new ones don't
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = features.build(pairs, tx, articles, customers, vectors, [WS])
        dealt = got._jdf.queryExecution().executedPlan().toString().splitlines()
        assert sorted(map(str, got.collect())) == whole
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = next(k for k, x in enumerate(dealt) if "REPARTITION_BY_COL" in x)
    assert not [x for x in dealt[:at] if "Exchange" in x] and any("BroadcastHashJoin" in x for x in dealt[:at])


def test_categories_are_those_of_the_matrix(detail, spark):
    tx, articles, customers, vectors = detail
    ranks = ", ".join(f"rank_{s} long" for s in candidates.STRATEGIES)
    rows = [(WS, who, what, ["als"], 1, 1, None, None, None, None, 1) for who, what in (("noa", "boot"), ("mia", "lace"), ("otto", "new"), ("new", "sock"))]
    pairs = spark.createDataFrame(rows, f"window_start date, customer_id string, article_id string, strategies array<string>, n_strategies long, best_rank long, {ranks}")
    whole = features.build(pairs, tx, articles, customers, vectors, [WS])
    got = features.categories(pairs, articles, customers)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(got.columns).collect())) and got.count() == 4


@pytest.mark.parametrize("name", ["m_category_mapping", "m_encoded"])
def test_category_queries_sum_no_history(spark, sf_dir, monkeypatch, name):
    from tidewell.plans.queries import QUERIES

    monkeypatch.setattr(features, "customer_features", None)  # summing would fail
    assert QUERIES[name](spark, sf_dir).columns


@pytest.mark.parametrize("rows", [5, 20])
def test_large_sides_are_shuffled_with_heavy_keys_dealt(spark, rows):
    from tidewell.functions.frames import SALTS, heavy_keys, join_small

    many = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    side = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only what is asked for is broadcast
    got = join_small(many, side, ["k"], 1 << 20)  # a row is said to have 1 MB
    assert ("SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()) == (rows * (1 << 20) > 16 << 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got.count() == 9000 and got.where("v = 0").count() == 3000 and got.where("v IS NOT NULL").count() == 3000
    assert [r.k for r in heavy_keys(many, ["k"]).collect()] == [0] and SALTS > 1


def test_recent_text_ranks_before_it_drops(spark):
    tx = tx_of(spark, [(WS - datetime.timedelta(days=n), "mia", shoe, 1, 1) for n, shoe in ((1, "unknown"), (2, "clog"), (4, "boot"), (4, "clog"))])
    vectors = spark.createDataFrame([("boot", [8.0, 1.0]), ("clog", [2.0, 5.0])], "article_id string, vector array<double>")
    mean = lambda n: features.recent_text_mean(tx, vectors, [WS], n).first().recent_vector
    assert (mean(2), mean(3), mean(4)) == ([2.0, 5.0], [5.0, 3.0], [4.0, pytest.approx(11 / 3)])
    assert features.recent_text_mean(tx, vectors, [WS], 1).count() == 0


def test_provenance_does_not_read_the_label(spark):
    schema = "window_start date, customer_id string, article_id string, strategies array<string>, n_strategies long, best_rank long, " + ", ".join(f"rank_{s} long" for s in candidates.STRATEGIES) + ", label int"
    rows = [(WS, "c1", "a1", ["repurchase", "als"], 2, 1, 1, None, None, None, 4, y) for y in (0, 1)]
    a, b = (features.provenance_features(spark.createDataFrame([r], schema)).first() for r in rows)
    assert a == b and a.from_repurchase and a.from_als and not a.from_colour_variant and (a.rank_repurchase, a.rank_als) == (1, 4)
    assert len(features.FEATURES) == 47


def test_cosine_of_missing_and_zero_vectors(spark):
    rows = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, None], [1.0, 5.0])], "a array<double>, b array<double>")
    assert [r[0] for r in rows.select(cosine(F.col("a"), F.col("b"))).collect()] == pytest.approx([0.5**0.5, 0, 0, 1 / 26**0.5])


def keyed(spark, rows, more="rank_position long"):
    return spark.createDataFrame([(WS, *r) for r in rows], f"window_start date, customer_id string, article_id string{', ' + more if more else ''}")


def test_average_precision(spark):
    ranked = keyed(spark, [("ann", "x", 1), ("ann", "p", 2), ("ann", "q", 4), ("bob", "p", 1), ("eli", "z", 1)])
    actual = keyed(spark, [("ann", "p"), ("ann", "q"), ("ann", "r"), ("ann", "s"), ("bob", "p"), ("cat", "q")], "")
    got = {r.customer_id: r.ap for r in evaluate.ap_per_customer(ranked, actual).collect()}
    assert got == {"ann": pytest.approx((1 / 2 + 2 / 4) / 4), "bob": 1.0, "cat": 0.0}  # eli bought nothing
    mean = evaluate.mean_ap(evaluate.ap_per_customer(ranked, actual)).first()
    assert (mean["map"], mean["n_purchasers"]) == (pytest.approx(1.25 / 3), 3)
    many = keyed(spark, [("ann", f"m{k:02d}") for k in range(20)], "")
    full = keyed(spark, [("ann", f"m{k:02d}", k + 1) for k in range(12)])
    assert evaluate.mean_ap(evaluate.ap_per_customer(full, many)).first()["map"] == 1.0  # twelve of twenty is all there can be
    with pytest.raises(ValueError, match="12"):
        evaluate.check_ranks(keyed(spark, [("ann", "x", 20)]))


def test_oracle(spark):
    actual = keyed(spark, [("ann", "p"), ("ann", "q"), ("ann", "r"), ("ann", "s"), ("bob", "p"), ("cat", "q")], "")
    pool = keyed(spark, [("ann", "s"), ("ann", "x"), ("bob", "p"), ("bob", "q")], "")
    assert evaluate.mean_ap(evaluate.oracle_ap(pool, actual)).first()["map"] == pytest.approx((1 / 4 + 1 + 0) / 3)


def test_recall_counts_distinct_pairs_and_refuses_more_than_k(spark):
    pool = keyed(spark, [("ann", "p"), ("ann", "p"), ("ann", "q"), ("bob", "r")], "")
    actual = keyed(spark, [("ann", "q"), ("ann", "t"), ("bob", "r"), ("bob", "p"), ("cat", "p")], "")
    got = evaluate.recall_hits(pool, actual).first()
    assert (got.hits, got.total) == (2, 5)
    with pytest.raises(ValueError, match="more than 1"):
        evaluate.recall_at_k(pool, pool, 1)


def test_recall_report_sums(shop):
    tx, articles, customers = shop
    later = tx.unionByName(tx_of(tx.sparkSession, [(D(9, 18), "ben", "novel-3", 1, 1), (D(9, 20), "ida", "essay", 1, 1), (D(9, 22), "gus", "comic", 1, 1), (D(9, 23), "gus", "poems", 1, 1)]))
    pool = candidates.pooled(candidates.strategies(tx, articles, customers, [WS]))
    rows = evaluate.recall_report(pool, periods.actual_purchases(later, [WS]), evaluate.recency(tx, customers, [WS])).collect()
    whole = next(r for r in rows if r.scope == "pool")
    assert (whole.hits, whole.total) == (2, 3)
    by_recency = [r for r in rows if r.scope == "recency"]
    assert (sum(r.hits for r in by_recency), sum(r.total for r in by_recency)) == (2, 3)
    alone = {r.name: r.hits for r in rows if r.scope == "strategy"}
    assert alone["colour_variant"] == 1 and alone["repurchase"] == 1 and all(r.hits <= alone[r.name] for r in rows if r.scope == "marginal")


def test_percentiles_are_linear(spark):
    import numpy as np

    random.seed(13)
    values = {"many": [random.gauss(0, 5) for _ in range(4001)], "ties": [random.randrange(4) for _ in range(999)], "two": [1.0, 4.0], "one": [7.0], "none": [None, None]}
    rows = spark.createDataFrame([(g, None if v is None else float(v)) for g, vs in values.items() for v in [*vs, None]], "g string, v double").repartition(5)
    points = (0.0, 0.01, 0.25, 0.5, 0.999, 1.0)
    got = {(r.g, r.k): r.value for r in percentiles(rows, "g", "v", points).collect()}
    assert got == {(g, k): pytest.approx(np.quantile(vs, p)) for g, vs in values.items() if g != "none" for k, p in enumerate(points)}


def test_global_rank_is_a_total_order(spark):
    random.seed(1)
    rows = [(random.randrange(5), str(k)) for k in range(3000)]
    df = spark.createDataFrame(rows, "v int, k string").repartition(7)
    got = {(r.v, r.k): r.position for r in global_rank(df, ["v", "k"]).collect()}
    assert got == {r: i for i, r in enumerate(sorted(rows))}


def test_bins_do_not_depend_on_row_order(spark):
    random.seed(2)
    rows = [(round(random.randrange(40) / 40, 3), f"c{k:05d}", "a", k % 2) for k in range(1003)]
    make = lambda rs: calibrate.quantile_bins(spark.createDataFrame(rs, "p_purchase double, customer_id string, article_id string, label int"))
    first = {r.customer_id: r.bin for r in make(rows).collect()}
    assert first == {r.customer_id: r.bin for r in make(rows[::-1]).collect()}
    sizes = [list(first.values()).count(b) for b in range(10)]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1
    assert [i * 4 // 10 for i in range(10)] == [0, 0, 0, 1, 1, 2, 2, 2, 3, 3]


def test_calibration(spark):
    random.seed(3)
    rows = [(x := random.random(), int(random.random() < x)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "raw_prob double, label int")
    model = calibrate.fit_calibrator(df)
    out = calibrate.apply_calibrator(model, spark.createDataFrame([(-1 + k * 0.1,) for k in range(31)], "raw_prob double")).orderBy("raw_prob").collect()
    values = [r.p_purchase for r in out]
    assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1
    table = calibrate.brier_table(spark.createDataFrame([(1.0, 1), (0.0, 0)], "p_purchase double, label int")).first()
    assert (table.brier, table.brier_skill) == (0.0, 1.0)
    flat = calibrate.brier_table(spark.createDataFrame([(0.5, 1), (0.5, 0)], "p_purchase double, label int")).first()
    assert flat.brier_skill == 0.0
    assert calibrate.brier_table(spark.createDataFrame([(0.5, 1)], "p_purchase double, label int")).first().brier_skill is None


def test_customer_buckets_are_disjoint(spark):
    rows = spark.createDataFrame([(f"c{k}",) for k in range(5000)], "customer_id string").select(calibrate.customer_bucket().alias("b")).collect()
    fit, held = ([r.b for r in rows if low <= r.b < high] for low, high in (calibrate.FIT, calibrate.EVAL))
    assert not set(fit) & set(held) and all(750 < len(x) < 1250 for x in (fit, held))


SCORED = "customer_id string, article_id string, ranker_score double, price double, p_purchase double, eligible boolean"


def test_offers(spark):
    scored = spark.createDataFrame([("c1", a, 1.0, 10.0, p, True) for a, p in (("a1", 0.05), ("a2", 0.09), ("a3", 0.001))] + [("c2", "a1", 1.0, 10.0, 0.001, True), ("c3", "a1", 1.0, None, 0.9, True), ("c4", "a1", 1.0, 10.0, 0.9, False)], SCORED)
    valued = scored.withColumn("contact_cost", F.lit(0.2)).withColumn("expected_value", offers.expected_value())
    assert valued.first().expected_value == pytest.approx(0.5 * 10 * 0.05 - 0.2)
    assert [(r.customer_id, r.article_id) for r in offers.select_offers(valued).collect()] == [("c1", "a2")]
    even = valued.where("article_id != 'a3' AND customer_id = 'c1'").withColumn("expected_value", F.lit(1.0))
    assert offers.select_offers(even).first().article_id == "a1"
    assert offers.select_offers(even.withColumn("ranker_score", F.when(F.col("article_id") == "a2", 2.0).otherwise(1.0))).first().article_id == "a2"
    assert offers.select_offers(even.withColumn("expected_value", F.lit(0.0))).count() == 0


def test_eligibility(spark):
    rows = spark.createDataFrame([("c1", a) for a in ("a1", "a2", "a3")], "customer_id string, article_id string")
    got = offers.with_eligibility(rows, spark.createDataFrame([("a1",), ("a2",)], "article_id string"), spark.createDataFrame([("c1", "a2")], "customer_id string, article_id string"))
    assert {r.article_id: r.eligible for r in got.collect()} == {"a1": True, "a2": False, "a3": False}


def test_equal_ratios_cover_alike(spark):
    random.seed(4)
    scored = spark.createDataFrame([(f"c{k}", f"a{j}", 1.0, random.uniform(1, 100), random.random() / 50, True) for k in range(40) for j in range(12)], SCORED)
    customers = scored.select("customer_id")
    cost = spark.createDataFrame([(200.0,)], "median_price double")
    grid = {(r.margin, r.multiplier): r.covered for r in offers.sensitivity(scored, cost, customers).collect()}
    assert len(grid) == 24 and grid[0.5, 0.001] == grid[0.5, 0.001] and grid[0.6, 0.0005] >= grid[0.3, 0.0005] >= grid[0.3, 0.02]
    assert offers.concentration(scored.limit(0)).first().top_share == 0.0
    assert offers.coverage(scored.limit(0), customers).first().coverage == 0.0


def test_store_and_lookup(spark):
    rows = [("c1", k, f"a{k:02d}", 1.0, 0.1, True, "[]", 1.0, k == 6, 0.5 if k == 6 else None) for k in range(1, 13)] + [("c2", k, f"a{k:02d}", 1.0, 0.1, False, "[]", 1.0, False, None) for k in range(1, 13)]
    df = spark.createDataFrame(rows, "customer_id string, rank int, article_id string, ranker_score double, p_purchase double, eligible boolean, strategies string, price double, selected boolean, expected_value double")
    store.save(df, "served_top12", 4)
    served = spark.table("served_top12")
    got = store.recommend(served, "c1", 3)
    assert [x["rank"] for x in got["items"]] == [1, 2, 3] and got["offer"]["rank"] == 6
    assert store.recommend(served, "c2")["offer"] is None and store.recommend(served, "cX") is None
    for k in (0, 13):
        with pytest.raises(ValueError, match="k must"):
            store.recommend(served, "c1", k)
    assert store.not_exact(served).count() == 0 and store.not_exact(served.where("rank > 1")).count() == 2
    assert store.difference(served, served).count() == 0 and store.difference(served, served.where("rank > 1")).count() == 2
    assert sorted(store.random_customers(served, 2, 1)) == ["c1", "c2"]
    with pytest.raises(RuntimeError):
        store.random_customers(served, 3, 1)
    some = spark.createDataFrame([("c1",)], "customer_id string")
    sample = served.where("customer_id = 'c1'")
    assert store.require_same_answers(sample, served, some).count() == 12
    for bad, message in ((sample.where("rank < 12"), "differently"), (served, "has 12 rows|differently"), (sample.limit(0), "None rows"), (sample.unionByName(sample), "24 rows")):
        with pytest.raises(RuntimeError, match=message):
            store.require_same_answers(bad, served, some)


def test_samples_of_buckets(spark):
    df = spark.createDataFrame([("a" if k < 50 else "b", f"c{k}") for k in range(55)], "recency_bucket string, customer_id string")
    pick = lambda d, seed=42: {(r.recency_bucket, r.customer_id) for r in store.sampled(d, 10, seed).collect()}
    got = pick(df)
    assert len(got) == 15 and got == pick(df.orderBy(F.desc("customer_id"))) and got != pick(df, 7)


def test_categories(spark):
    df = spark.createDataFrame([("b", None), ("a", "x"), (None, "x")], "u string, v string")
    mapping = models.category_mapping(df, ["u", "v"])
    assert {(r.column_name, r.category): r.code for r in mapping.collect()} == {("u", "__NULL__"): 0, ("u", "a"): 1, ("u", "b"): 2, ("v", "__NULL__"): 0, ("v", "x"): 1}
    new = spark.createDataFrame([("zzz", None), ("b", "x")], "u string, v string")
    assert sorted(map(tuple, models.apply_mapping(new, mapping, ["u", "v"]).collect())) == [(-1, 0), (2, 1)]


def test_training_is_the_same_twice_and_counts_trees(spark):
    random.seed(5)
    rows = [(D(8, 5 + 7 * (k % 3)), f"c{k}", "a", float(k % 7), random.choice("xy"), int(k % 7 > 3)) for k in range(210)]
    cols = "window_start date, customer_id string, article_id string, best_rank double, age_bucket string, label int"
    df = spark.createDataFrame(rows, cols).withColumns({c: F.lit(None).cast("string") for c in features.CATEGORICAL if c != "age_bucket"})
    names = ["best_rank", "age_bucket"]
    one, two = (models.train(df, 4, features=names) for _ in range(2))
    assert one.losses == pytest.approx(two.losses) and one.model.getNumTrees == one.losses.index(min(one.losses)) + 1
    a, b = ({r.customer_id: r.raw_prob for r in models.scored(t, df, features=names).collect()} for t in (one, two))
    assert a == pytest.approx(b, abs=1e-6) and len(a) == 210  # sums depend on the order of tasks
    histogram = models.score_distributions(models.scored(one, df, features=names), "raw_prob")
    assert histogram.agg(F.sum("n")).first()[0] == 210


def test_the_ranker_orders_within_customers(spark):
    random.seed(17)
    cols = "window_start date, customer_id string, article_id string, best_rank double, n_strategies double, label int"
    rows = []
    for k in range(60):
        level = random.uniform(-50, 50)  # tells customers apart, not their candidates
        draws = [random.random() for _ in range(6)]
        rows += [(D(8, 5 + 7 * (k % 3)), f"c{k}", f"a{j}", level + x, x, int(x == max(draws))) for j, x in enumerate(draws)]
    df = spark.createDataFrame(rows, cols).withColumns({c: F.lit(None).cast("string") for c in features.CATEGORICAL})
    names = ["best_rank", "n_strategies"]
    got = models.train_ranker(df, 5, features=names)
    assert got.losses == sorted(got.losses, reverse=True) and got.model.getNumTrees == 5 and got.losses[0] < math.log(6)
    table = models.scored(got, df, "ranker_score", names)
    chances = [r.label for r in models.score_order(table).where("rank_position = 1").collect()]
    assert sum(chances) > 0.5 * len(chances)
    some = table.where("article_id < 'a3'").withColumn("ranker_score", F.lit(9.0).cast("float"))
    mixed = models.scored_missing(got, df, some, "ranker_score", names).collect()
    assert len(mixed) == 360 and sum(r.ranker_score == 9.0 for r in mixed) == 180


def test_the_probe_ends_when_the_loss_stays(spark):
    df = spark.createDataFrame([(D(8, 5 + 7 * (k % 2)), f"c{k // 4}", f"a{k}", float(random.random()), int(k % 4 == 0)) for k in range(80)], "window_start date, customer_id string, article_id string, best_rank double, label int")
    ready = models._vector(df, ["best_rank"]).select(*candidates.KEYS, F.col("label").cast("double").alias("label"), "features")
    trees, losses = models._boosted(ready.where("window_start = '2020-08-05'"), 30, 1, ready.where("window_start = '2020-08-12'"), patience=1)
    assert len(trees) == len(losses) < 30 and losses.index(min(losses)) == len(losses) - 3 or len(losses) <= 2


def test_the_ranker_keeps_no_plan_in_another(spark, monkeypatch):
    df = spark.createDataFrame([(D(8, 5), f"c{k // 4}", f"a{k}", float(k % 5), int(k % 4 == 0)) for k in range(40)], "window_start date, customer_id string, article_id string, best_rank double, label int")
    ready = models._vector(df, ["best_rank"]).select(*candidates.KEYS, F.col("label").cast("double").alias("label"), "features")
    held, real = [], models.DecisionTreeRegressor.fit
    monkeypatch.setattr(models.DecisionTreeRegressor, "fit", lambda self, rows: held.append(rows._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation")) or real(self, rows))
    trees, _ = models._boosted(ready, 6, 1)
    assert len(trees) == 6 and max(held) <= held[1]  # the second is the first with scores of a tree


def test_als_asks_for_some_customers_at_a_time(spark, monkeypatch):
    from tidewell.operators import als

    tx = tx_of(spark, [(D(8, 1), f"c{k:02d}", f"a{(k * 7 + j) % 30:02d}", 1, 1) for k in range(20) for j in range(1 + k % 4)])
    fitted = als.fit(tx, WS, 4, 2)
    assert fitted.bought.inputFiles()  # a table, so nothing counts the purchases again
    whole = als.recommend(fitted, WS, 5).collect()
    asked, real = [], type(fitted.model).recommendForUserSubset
    monkeypatch.setattr(als, "ASKED", 4)
    monkeypatch.setattr(type(fitted.model), "recommendForUserSubset", lambda self, users, n: asked.append(users.count()) or real(self, users, n))
    assert sorted(als.recommend(fitted, WS, 5).collect()) == sorted(whole) and sum(asked) == 20 and len(asked) > 4


def test_text_vectors(spark):
    df = spark.createDataFrame([("a1", "red blue shirt"), ("a2", "red green trousers"), ("a3", None), ("a4", ""), ("a5", "blue hat and scarf")], "article_id string, detail_desc string")
    got = {r.article_id: r for r in text.article_vectors(df, 2).collect()}
    assert got["a3"].detail_desc_missing and got["a4"].vector == [0.0, 0.0] and not got["a1"].detail_desc_missing
    assert abs(sum(got[a].vector[0] for a in ("a1", "a2", "a5"))) < 1e-9


def test_drift_thresholds(spark):
    table = lambda n, p=0.0: spark.createDataFrame([(f"f{k}", 0.3 if k < n else 0.0) for k in range(47)] + [(drift.PROBABILITY, p)], "column_name string, psi double")
    assert [drift.verdict(table(n)).first().passed for n in (5, 11, 12)] == [True, True, False]
    assert not drift.verdict(table(0, 0.25)).first().passed
    assert drift.verdict(spark.createDataFrame([("f", float("nan"))], "column_name string, psi double")).first().drifted == 1
    with pytest.raises(ValueError, match="50000"):
        drift.decide(table(0), 49_999, 100_000)


def test_psi_sees_a_shift(spark):
    random.seed(6)
    make = lambda mean, share: spark.createDataFrame([(random.gauss(mean, 1), "a" if random.random() < share else "b") for _ in range(2000)], "x double, c string")
    same, moved = drift.psi(make(0, 0.7), make(0, 0.7), ["x"], ["c"]), drift.psi(make(0, 0.7), make(100, 0.2), ["x"], ["c"])
    assert all(r.psi < 0.05 for r in same.collect()) and all(r.psi > 0.25 for r in moved.collect())


def test_contracts(spark):
    good = spark.createDataFrame([("2020-09-01", "c" * 64, "0" * 10, "0.5", "1")], "t_dat string, customer_id string, article_id string, price string, sales_channel_id string")
    assert contracts.validated(good, contracts.TRANSACTIONS).dtypes == [("t_dat", "date"), ("customer_id", "string"), ("article_id", "string"), ("price", "double"), ("sales_channel_id", "int")]
    for column, bad in (("article_id", "108775015"), ("price", "-1"), ("price", "x"), ("sales_channel_id", "3"), ("customer_id", None)):
        with pytest.raises(ValueError, match=column):
            contracts.validated(good.withColumn(column, F.lit(bad).cast("string")), contracts.TRANSACTIONS)
    with pytest.raises(ValueError, match="extra"):
        contracts.validated(good.withColumn("extra", F.lit(1)), contracts.TRANSACTIONS)
    with pytest.raises(ValueError, match="missing"):
        contracts.validated(good.drop("price"), contracts.TRANSACTIONS)
    twice = spark.createDataFrame([("c" * 64, "a")] * 2, "customer_id string, prediction string")
    with pytest.raises(ValueError, match="unique"):
        contracts.validated(twice, contracts.SAMPLE_SUBMISSION)


def test_one_task_grows_the_trees_that_spark_grows(spark):
    """Values that fit the bins and values that don't, weights, zeros, and a constant feature."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import DecisionTreeRegressor

    from tidewell.operators import trees

    random.seed(11)
    draws = [(random.choice([0.0, random.gauss(0, 1)]), float(random.randrange(6)), 7.0, random.random()) for _ in range(900)]
    rows = [(k, Vectors.dense(d), float(random.random() < 1 / (1 + math.exp(-d[0] * d[1]))), d[3] + 1e-3, d[0] ** 2 + d[1] + d[3]) for k, d in enumerate(draws)]
    df = spark.createDataFrame(rows, ["id", "features", "label", "curve", "step"])
    df = df.repartition(1).persist()
    jobs, tracker = [], spark.sparkContext.statusTracker()
    for one, own, out, more in ((trees.OneTaskTree, DecisionTreeRegressor, F.col("prediction"), {"labelCol": "step", "weightCol": "curve"}), (trees.OneTaskBooster, GBTClassifier, models.vector_to_array("probability")[1], {"maxIter": 12, "stepSize": 0.05})):
        spark.sparkContext.setJobGroup(one.__name__, one.__name__)
        fitted = one(maxDepth=5, maxBins=64, seed=1, **more).fit(df)
        jobs.append(len(tracker.getJobIdsForGroup(one.__name__)))
        spark.sparkContext.setJobGroup("other", "other")
        a, b = ([r[0] for r in m.transform(df).orderBy("id").select(out.cast("double")).collect()] for m in (fitted, own(maxDepth=5, maxBins=64, seed=1, **more).fit(df)))
        assert a == pytest.approx(b, abs=1e-9) and len(set(a)) > 10
    assert max(jobs) <= 3  # Spark has seven a tree


def test_the_classifier_of_few_rows_takes_few_jobs(spark):
    rows = [(D(8, 5 + 7 * (k % 3)), f"c{k}", "a", float(k % 7), int(k % 7 > 3)) for k in range(210)]
    df = spark.createDataFrame(rows, "window_start date, customer_id string, article_id string, best_rank double, label int").withColumns({c: F.lit(None).cast("string") for c in features.CATEGORICAL})
    spark.sparkContext.setJobGroup("few", "few")
    got = models.train(df, 20, features=["best_rank"])
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few"))
    spark.sparkContext.setJobGroup("other", "other")
    assert len(got.losses) == 20 and jobs < 40  # Spark has over five a tree


def test_als_has_few_blocks_and_its_rounds_are_cleaned(spark, monkeypatch):
    import time

    from pyspark.ml.recommendation import ALS

    from tidewell.operators import als
    from tidewell.sources import shared

    tx = tx_of(spark, [(D(8, 1), f"c{k:02d}", f"a{(k * 7 + j) % 30:02d}", 1, 1) for k in range(20) for j in range(1 + k % 4)])
    asked, collected, real = [], [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, df: asked.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or time.sleep(1) or real(self, df))
    monkeypatch.setattr(als, "COLLECT", 0.1)
    monkeypatch.setattr(shared, "collect_garbage", lambda s: collected.append(1))
    fitted = als.fit(tx, WS, 4, 2)
    n = fitted.bought.count()
    monkeypatch.setattr(als, "COUNTS", n // 7)
    als.fit(tx, WS, 4, 2)
    assert asked == [(4, 4), (-(-n // (n // 7)),) * 2] and len(collected) > 4 and fitted.model.getBlockSize() > 4096
