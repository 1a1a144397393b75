"""Drift of columns by the population stability index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.columns import hash_mod
from tidewell.functions.frames import percentiles
from tidewell.sources.shared import written

DRIFTED, FAILING_SHARE = 0.25, 0.25
LEAST_ROWS, SAMPLE = 50_000, 100_000
PAIR_MODULUS, CUSTOMER_MODULUS = 1000, 4
SEED = 20200916
BINS, FLOOR = 10, 1e-4
PROBABILITY = "calibrated_probability"


def pair_hash(modulus: int = PAIR_MODULUS, seed: int = SEED) -> Column:
    return hash_mod(modulus, str(seed), F.col("customer_id"), F.col("article_id"))


def sampled(df: DataFrame, n: int = SAMPLE, seed: int = SEED, order: Sequence[str] = ("customer_id", "article_id")) -> DataFrame:
    """n rows by seeded hash; a sampling operator, the same wherever it runs."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), *order))
    return df.orderBy(key, *order).limit(n)


def unmatched(df: DataFrame, modulus: int = PAIR_MODULUS, n: int = SAMPLE) -> DataFrame:
    """A hash sample of current pairs, not matched to how training rows are drawn."""
    return sampled(df.where(pair_hash(modulus) == 0), n)


def customers_in(df: DataFrame, modulus: int = CUSTOMER_MODULUS, seed: int = SEED) -> DataFrame:
    """Rows of the customers of a hash class, whose candidates are then drawn like training rows."""
    return df.where(hash_mod(modulus, str(seed), F.col("customer_id")) == 0)


def _long(df: DataFrame, columns: Sequence[str], numeric: bool) -> DataFrame:
    kind = "double" if numeric else "string"
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value")) for c in columns])))


def psi(reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """column_name and psi of each column.

    Numbers fall into bins at the reference's deciles (equal deciles are one
    bin, null is a bin), categories into themselves; shares are floored. Each
    side is evaluated once, into a table, and so are the edges.
    """
    parts, columns = [], [*numeric, *categorical]
    reference, current = written(reference.select(*columns), "reference"), written(current.select(*columns), "current")
    if numeric:
        points = percentiles(_long(reference, numeric, True), "column_name", "value", [k / BINS for k in range(1, BINS)])
        edges = written(points.groupBy("column_name").agg(F.array_sort(F.collect_set("value")).alias("edges")), "edges")  # both sides read them
        binned = lambda df: _long(df, numeric, True).join(F.broadcast(edges), "column_name", "left").select("column_name", F.when(F.col("value").isNull(), "null").otherwise(F.size(F.filter(F.coalesce("edges", F.array().cast("array<double>")), lambda e: e < F.col("value"))).cast("string")).alias("bin"))
        parts.append((binned(reference), binned(current)))
    if categorical:
        named = lambda df: _long(df, categorical, False).select("column_name", F.coalesce("value", F.lit("null")).alias("bin"))
        parts.append((named(reference), named(current)))
    out = None
    for ref, cur in parts:
        both = ref.withColumn("r", F.lit(1)).withColumn("c", F.lit(0)).unionByName(cur.withColumn("r", F.lit(0)).withColumn("c", F.lit(1)))
        counts = both.groupBy("column_name", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
        sums = counts.groupBy("column_name").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
        share = lambda x, n: F.greatest(F.when(F.col(n) > 0, F.col(x) / F.col(n)).otherwise(0.0), F.lit(FLOOR))
        met = counts.join(F.broadcast(sums), "column_name").select("column_name", share("r", "nr").alias("p"), share("c", "nc").alias("q"))
        got = met.groupBy("column_name").agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"))
        out = got if out is None else out.unionByName(got)
    return out


def decide(table: DataFrame, n_reference: int, n_current: int, least: int = LEAST_ROWS) -> DataFrame:
    """Columns, drifted ones, their share, whether the probability drifted, and the verdict.

    Raises if a side has too few rows. NaN counts as drifted; the verdict fails
    if over a quarter of the features drifted, or the probability did.
    """
    if min(n_reference, n_current) < least:
        raise ValueError(f"each side needs {least} rows")
    return verdict(table)


def verdict(table: DataFrame) -> DataFrame:
    """The verdict on a table of column_name and psi."""
    drifted = F.isnan("psi") | (F.col("psi") >= DRIFTED)
    feature = F.col("column_name") != PROBABILITY
    got = table.agg(F.count_if(feature).alias("features"), F.count_if(feature & drifted).alias("drifted"), F.coalesce(F.bool_or(~feature & drifted), F.lit(False)).alias("probability_drifted"))
    share = F.when(F.col("features") > 0, F.col("drifted") / F.col("features")).otherwise(0.0)
    return got.withColumn("share", share).withColumn("passed", ~((share > FAILING_SHARE) | F.col("probability_drifted")))
