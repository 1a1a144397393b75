"""Temporal URL filtering: captures against lists as they stood at fetch time.

Dated list entries (a host pattern, an action, the day it was listed) become
validity intervals: an entry holds until the pattern's next entry. A capture is
evaluated against the intervals of its host and of every parent domain that hold
on its fetch day; the longest pattern decides.

The as-of join is an equi-join on (pattern, period, salt): an interval appears in
each period it overlaps, and in each of a few salts, so the captures of a host
with a third of all rows are dealt to many tasks. All of it is DataFrame
functions. Verdicts of hosts and days with very many rows, of which there are
few, are broadcast; the others join by host and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import written

#: Days of a period of the join, and salts by which captures of a host are dealt.
PERIOD, SALTS = 32, 8
#: A host and day with over this part of all rows is decided by a broadcast.
HOT = 2000
#: Of entries of one pattern on one day, the action that is listed last here decides.
ACTIONS = ("allow", "review", "block")


def normal_host(host: Column) -> Column:
    """Lower case, no space around it, no final dots; null where nothing is left."""
    plain = F.regexp_replace(F.lower(F.trim(host)), r"\.+\z", "")
    return F.when(plain != "", plain)


def host_of(url: Column) -> Column:
    """Normal form of a URL's host, without user and port; null where there is none.

    The authority ends at the first slash, backslash, question mark or hash; what
    stands before its last @ is the user. An IPv6 address keeps its brackets.
    """
    authority = F.regexp_extract(F.lower(F.trim(url)), r"\A[a-z][a-z0-9+.-]*:[/\\\\]{2}([^/\\\\?#]*)", 1)
    place = F.substring_index(authority, "@", -1)
    address = F.regexp_extract(place, r"\A(\[[^\]]*\])", 1)
    return normal_host(F.when(address != "", address).otherwise(F.substring_index(place, ":", 1)))


def patterns_of(host: Column) -> Column:
    """The host and its parent domains; an IP address has none."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    return F.when(host.rlike(r"\A(?:\[.*|[0-9.]+)\z"), F.array(host)).otherwise(suffixes)


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, action, valid_from, valid_to (exclusive, null: still valid).

    ``entries`` has pattern, action and listed_on. Entries with a null in any of
    them, or a pattern without a host, are no entries; an unknown action ranks
    before all others. Patterns have the hosts' normal form.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action")), F.lit(0))
    entries = entries.select(normal_host(F.col("pattern")).alias("pattern"), "action", "listed_on")
    daily = entries.where("pattern IS NOT NULL AND action IS NOT NULL AND listed_on IS NOT NULL").groupBy("pattern", F.col("listed_on").cast("date").alias("valid_from")).agg(F.max_by("action", F.struct(rank, "action")).alias("action"))
    after = F.lead("valid_from").over(Window.partitionBy("pattern").orderBy("valid_from"))
    return daily.withColumn("valid_to", after)


def _day(date: Column) -> Column:
    return F.datediff(date, F.lit("1970-01-01").cast("date"))


def evaluate(captures: DataFrame, entries: DataFrame, period: int = PERIOD, salts: int = SALTS) -> DataFrame:
    """Captures (page_id, url, fetched_on) with host, matched pattern, its listing day and action.

    One row per input row. A capture without host or fetch day, or that no entry
    holds for, has null pattern and day and the action ``none``. Repeated rows
    are evaluated each; an empty list matches nothing; further columns are
    ignored.
    """
    held = intervals(entries)
    rows = captures.select("page_id", "url", F.col("fetched_on").cast("date").alias("fetched_on"))
    # what is asked depends on host and day alone, so captures are counted before the join
    rows = rows.withColumn("host", host_of(F.col("url")))
    asked = rows.where("host IS NOT NULL AND fetched_on IS NOT NULL").groupBy("host", "fetched_on").agg(F.count("*").alias("n"))
    left = asked.select("host", "fetched_on", "n", F.explode(patterns_of(F.col("host"))).alias("pattern"), F.floor(_day(F.col("fetched_on")) / period).alias("period"), F.pmod(F.xxhash64("host", "fetched_on"), F.lit(salts)).alias("salt"))
    # an interval that still holds reaches to the last day asked for
    first_day, last_day, n_rows = asked.agg(F.min("fetched_on"), F.max("fetched_on"), F.sum("n")).first()
    low, high = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    right = held.where((F.col("valid_from") <= high) & (F.col("valid_to").isNull() | (F.col("valid_to") > low)))
    first = F.floor(_day(F.greatest(F.col("valid_from"), low)) / period)
    last = F.floor(_day(F.least(F.date_sub("valid_to", 1), high)) / period)
    right = right.select("pattern", "action", "valid_from", "valid_to", F.explode(F.sequence(first, last)).alias("period"))
    right = right.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    met = left.join(right, ["pattern", "period", "salt"]).where((F.col("valid_from") <= F.col("fetched_on")) & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))))
    verdict = written(met.groupBy("host", "fetched_on").agg(F.max_by(F.struct("pattern", "valid_from", "action"), F.length("pattern")).alias("b"), F.max("n").alias("n")), "verdicts")
    # a host and day with more than a HOT-th of all rows: fewer than HOT of them, so they are broadcast and their rows stay where they are
    hot = F.col("n") > (n_rows or 0) / HOT
    common = F.broadcast(verdict.where(hot).select("host", "fetched_on", F.col("b").alias("common")))
    others = verdict.where(~hot).select("host", "fetched_on", F.lit(-1).cast("long").alias("deal"), "b")
    met = rows.join(common, ["host", "fetched_on"], "left")
    # rows that are decided go anywhere, all others to their host and day
    met = met.withColumn("deal", F.when(F.col("common").isNotNull(), F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20))).otherwise(F.lit(-1).cast("long")))
    out = met.join(others, ["host", "fetched_on", "deal"], "left").withColumn("b", F.coalesce("common", "b"))
    return out.select("page_id", "url", "host", "fetched_on", F.col("b.pattern").alias("pattern"), F.col("b.valid_from").alias("listed_on"), F.coalesce("b.action", F.lit("none")).alias("action"))


def keep_allowed(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures whose action at fetch time is not ``block``."""
    return evaluate(captures, entries).where("action != 'block'")
