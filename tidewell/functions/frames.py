"""Frame helpers: time windows, top k of a group, ranks over a whole table."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import day
from tidewell.sources.shared import forget, written

Start = datetime.date | str


def in_windows(tx: DataFrame, starts: Sequence[Start], days: int | None, date: str = "t_dat") -> DataFrame:
    """Rows of the ``days`` before each start (all history if None), once per start as ``window_start``.

    The start day itself is outside. All starts are evaluated in one scan; the
    filter on the widest range comes first so that it reaches the scan.
    """
    every = sorted({str(s) for s in starts})
    near = F.col(date) < day(every[-1])
    if days is not None:
        near = near & (F.col(date) >= F.date_sub(day(every[0]), days))
    if len(every) == 1:
        return tx.where(near).withColumn("window_start", day(every[0]))
    holds = lambda s: (F.col(date) < s) & ((F.col(date) >= F.date_sub(s, days)) if days is not None else F.lit(True))
    return tx.where(near).withColumn("window_start", F.explode(F.filter(F.array(*[day(s) for s in every]), holds)))


def per_window(df: DataFrame, starts: Sequence[Start]) -> DataFrame:
    """Every row once per start, as ``window_start``."""
    every = sorted({str(s) for s in starts})
    if len(every) == 1:
        return df.withColumn("window_start", day(every[0]))
    return df.withColumn("window_start", F.explode(F.array(*[day(s) for s in every])))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int | None, rank: str) -> DataFrame:
    """The first k rows of each group and their 1-based rank; ``order`` must be total.

    Planned as a group limit before and after the shuffle.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered if k is None else numbered.where(F.col(rank) <= k)


def _running(df: DataFrame, order: Sequence[str], weight: Column, to: str, total: str | None = None) -> DataFrame:
    """``to``: sum of ``weight`` over the rows before each one in the total order of ``order``; ``total``: over all.

    The input is written before it is sampled for ranges, and range-partitioned
    and written again, so that each is evaluated once and partition sums and
    positions see the same partitions; offsets are one row per partition.
    """
    source = written(df.withColumn("__w", weight.cast("long")), "unranked")
    dealt = written(source.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranked")
    forget(source)
    sizes = dealt.groupBy("__part").agg(F.sum("__w").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__total"))
    so_far = F.sum("__w").over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = dealt.withColumn("__k", F.coalesce(so_far, F.lit(0))).join(F.broadcast(offsets), "__part").withColumn(to, F.col("__before") + F.col("__k"))
    return (out.withColumn(total, F.col("__total")) if total else out).drop("__part", "__before", "__k", "__w", "__total")


def global_rank(df: DataFrame, order: Sequence[str], rank: str = "position", total: str | None = None) -> DataFrame:
    """0-based position in the total order of ``order``, and the number of rows as ``total``, without a single-task window."""
    return _running(df, order, F.lit(1), rank, total)


def percentiles(df: DataFrame, group: str, value: str, points: Sequence[float]) -> DataFrame:
    """Exact linear percentiles: (group, k, value) for each group and the k-th of ``points``; nulls don't count.

    Values are counted, put in one total order over all groups and found by
    position, so no task holds a column's values. Groups must be few.
    """
    counts = df.select(F.col(group).alias(group), F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL").groupBy(group, "__v").agg(F.count("*").alias("__c"))
    placed = _running(counts, [group, "__v"], F.col("__c"), "__at")
    sizes = placed.groupBy(group).agg(F.sum("__c").alias("__n"), F.min("__at").alias("__first"))
    wanted = sizes.select(F.col(group).alias("__g"), F.posexplode(F.array(*[F.col("__first") + F.lit(float(p)) * (F.col("__n") - 1) for p in points])).alias("k", "__want"))
    here = lambda place: (F.col("__at") <= place) & (place < F.col("__at") + F.col("__c"))
    low, high = F.floor("__want"), F.ceil("__want")
    met = placed.join(F.broadcast(wanted), F.col(group).eqNullSafe(F.col("__g")) & (here(low) | here(high)))
    ends = met.groupBy(group, "k", "__want").agg(F.max(F.when(here(low), F.col("__v"))).alias("__low"), F.max(F.when(here(high), F.col("__v"))).alias("__high"))
    share = F.col("__want") - F.floor("__want")
    return ends.select(group, "k", (F.col("__low") * (1 - share) + F.col("__high") * share).alias("value"))


#: Bytes of a frame up to which it is broadcast, which the driver holds several times over; copies of a heavy key's row
#: that a join deals rows to, and the share of all rows, one in so many, over which a key is heavy.
BROADCAST_BYTES, SALTS, HEAVY = 16 << 20, 16, 2000


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one in ``HEAVY`` of the rows have; so they are fewer than that."""
    counts = written(df.groupBy(*keys).agg(F.count("*").alias("__n")), "counts")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    return counts.where(F.col("__n") * HEAVY > total).select(*keys)


def join_small(df: DataFrame, side: DataFrame, keys: Sequence[str], row_bytes: int, how: str = "left", most: int = BROADCAST_BYTES, *, counted: DataFrame | None = None, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` joined with a frame that has one row per key; broadcast after a check of its size, else by shuffle.

    ``row_bytes`` is about what a row of ``side`` takes. In a shuffle the rows of
    a heavy key, as a popular article, are dealt to ``SALTS`` tasks; heavy keys
    are counted in ``counted``, or else in ``df``, which is written for that.
    ``deal`` is what is done with the rows next, a shuffle for instance: in a left
    join heavy keys' rows are not shuffled for ``side`` then, but meet its rows of
    those keys, which are few, by broadcast after it, and are narrow before.
    """
    if side.count() * max(row_bytes, 64) <= most:
        out = df.join(F.broadcast(side), list(keys), how)
        return deal(out) if deal else out
    if counted is None:
        counted = df = written(df, "dealt")
    if deal and how == "left":
        few = written(heavy_keys(counted.select(*keys), keys).join(side, list(keys), "left"), "heavy")
        known = F.broadcast(few.select(*keys))
        light = df.join(known, list(keys), "left_anti").join(side, list(keys), "left")
        rows = deal(light.unionByName(df.join(known, list(keys), "left_semi"), allowMissingColumns=True))
        own = [c for c in side.columns if c not in keys]
        met = rows.join(F.broadcast(few.select(*keys, *[F.col(c).alias(f"__of_{c}") for c in own])), list(keys), "left")
        return met.withColumns({c: F.coalesce(F.col(c), F.col(f"__of_{c}")) for c in own}).drop(*[f"__of_{c}" for c in own])
    heavy = F.broadcast(heavy_keys(counted.select(*keys), keys).withColumn("__heavy", F.lit(True)))
    copies = side.join(heavy, list(keys), "left").withColumn("__salt", F.explode(F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("__heavy")
    salt = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")]), F.lit(SALTS)).cast("int")
    dealt = df.join(heavy, list(keys), "left").withColumn("__salt", F.when(F.col("__heavy"), salt).otherwise(0)).drop("__heavy")
    out = dealt.join(copies, [*keys, "__salt"], how).drop("__salt")
    return deal(out) if deal else out


def one_row(df: DataFrame) -> DataFrame:
    """Marks a global aggregate as one row that may be broadcast."""
    return F.broadcast(df)
