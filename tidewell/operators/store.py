"""The served table: twelve articles a customer with their offer, lookups and samples."""

from __future__ import annotations

import os
import random
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.frames import top_k

PER_BUCKET = 300
SEED = 42


def served(top12: DataFrame, pool: DataFrame, prices: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows to serve: rank, scores, eligibility, strategies as JSON, price, whether it is the offer.

    ``top12`` has customer_id, article_id, rank_position, ranker_score,
    p_purchase and eligible; ``selected`` the offers with their expected value.
    """
    key = ["customer_id", "article_id"]
    out = top12.join(pool.select(*key, F.to_json("strategies").alias("strategies")), key, "left").join(prices, "article_id", "left")
    out = out.join(selected.select(*key, "expected_value"), key, "left")
    return out.select("customer_id", F.col("rank_position").alias("rank"), "article_id", "ranker_score", "p_purchase", "eligible", "strategies", "price", F.col("expected_value").isNotNull().alias("selected"), "expected_value")


def unmatched_provenance(top12: DataFrame, pool: DataFrame) -> DataFrame:
    """Rows whose pair isn't in the pool; there must be none."""
    return top12.select("customer_id", "article_id").join(pool.select("customer_id", "article_id"), ["customer_id", "article_id"], "left_anti")


def save(store: DataFrame, table: str, buckets: int = 64) -> None:
    """Write the store bucketed and sorted by customer, so that a lookup reads one bucket."""
    store.write.mode("overwrite").bucketBy(buckets, "customer_id").sortBy("customer_id", "rank").saveAsTable(table)


def recommend(store: DataFrame, customer: str, k: int = 12) -> dict | None:
    """The first k rows of a customer, and the offer wherever it ranks; None if unknown."""
    if not 1 <= k <= 12:
        raise ValueError("k must be from 1 to 12")
    rows = sorted((r.asDict() for r in store.where(F.col("customer_id") == customer).collect()), key=lambda r: r["rank"])
    if not rows:
        return None
    return {"customer_id": customer, "items": rows[:k], "offer": next((r for r in rows if r["selected"]), None)}


def recommendations(store: DataFrame, k: int = 12) -> DataFrame:
    """What ``recommend`` answers, for all customers at once: items as one string, and the offer."""
    return store.groupBy("customer_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("rank") <= k, F.struct("rank", "article_id")))), lambda x: x["article_id"]), ",").alias("items"),
        F.max(F.when(F.col("selected"), F.col("article_id"))).alias("offer"),
    )


def sampled(buckets: DataFrame, per_bucket: int = PER_BUCKET, seed: int = SEED) -> DataFrame:
    """Of each bucket the customers with the smallest SHA-256 of "seed:id"; the choice is a sampling operator."""
    key = F.sha2(F.concat_ws(":", F.lit(str(seed)), "customer_id"), 256)
    return top_k(buckets.withColumn("key", key), ["recency_bucket"], [F.col("key"), F.col("customer_id")], per_bucket, "n").select("recency_bucket", "customer_id", "key")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that are in only one of two frames, with repetitions."""
    columns = a.columns
    return a.exceptAll(b.select(*columns)).withColumn("side", F.lit("left")).unionByName(b.select(*columns).exceptAll(a).withColumn("side", F.lit("right")))


def require_same_answers(sample: DataFrame, whole: DataFrame, customers: DataFrame, k: int = 12) -> DataFrame:
    """A sample store, after checks: every chosen customer, ``k`` rows each at most, and the answers of the whole store."""
    sizes = customers.select("customer_id").distinct().join(sample.groupBy("customer_id").agg(F.count("*").alias("n")), "customer_id", "full")
    wrong = sizes.where(F.col("n").isNull() | (F.col("n") > k)).head(1)
    if wrong:
        raise RuntimeError(f"customer {wrong[0]['customer_id']} has {wrong[0]['n']} rows in the sample, not 1 to {k}")
    some = whole.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")
    other = difference(recommendations(sample, k), recommendations(some, k)).head(1)
    if other:
        raise RuntimeError(f"the sample and the whole store answer differently for customer {other[0]['customer_id']}")
    return sample


def random_customers(store: DataFrame, n: int, seed: int) -> list[str]:
    """n different customers: the first id at or after a random point, around the end if need be."""
    ids = store.select("customer_id").distinct()
    low, high = ids.agg(F.min("customer_id"), F.max("customer_id")).first()
    if low is None:
        raise RuntimeError("the store is empty")
    rng, found = random.Random(seed), []
    same = len(os.path.commonprefix([low, high]))  # points lie where ids do
    alphabet = "0123456789abcdef" if re.search("[a-f]", high) else "0123456789"
    for _ in range(5):  # one scan answers many points
        points = [high[:same] + "".join(rng.choice(alphabet) for _ in high[same:]) for _ in range(10 * n)]
        rows = ids.agg(*[F.min(F.when(F.col("customer_id") >= p, F.col("customer_id"))) for p in points]).first()
        for row in rows:
            if (row or low) not in found and len(found) < n:
                found.append(row or low)
        if len(found) == n:
            return found
    raise RuntimeError("too few customers")


def not_exact(top12: DataFrame, k: int = 12) -> DataFrame:
    """Customers without exactly k rows."""
    return top12.groupBy("customer_id").agg(F.count("*").alias("n")).where(F.col("n") != k)


def checksum(df: DataFrame) -> DataFrame:
    """Number of rows and a sum of row hashes that doesn't depend on order."""
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"))
