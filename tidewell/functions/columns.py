"""Column functions with the semantics the operators need."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper ages of the buckets, which belong to the bucket below (25 is in "<25").
AGE_EDGES = (25, 35, 45, 55, 65)
AGE_LABELS = ("<25", "25-34", "35-44", "45-54", "55-64", "65+")
UNKNOWN_AGE = "unknown"

#: Most days since the last purchase of each recency bucket.
RECENCY_EDGES = ((7, "<=1 week"), (28, "<=4 weeks"), (84, "<=12 weeks"), (364, "<=52 weeks"))
RECENCY_REST, RECENCY_NONE = ">52 weeks", "never"


def day(date: datetime.date | str) -> Column:
    return F.lit(str(date)).cast("date")


def age_bucket(age: Column) -> Column:
    """Right-closed age buckets; a null age is ``unknown``."""
    out = F.when(age.isNull(), UNKNOWN_AGE)
    for edge, label in zip(AGE_EDGES, AGE_LABELS, strict=False):
        out = out.when(age <= edge, label)
    return out.otherwise(AGE_LABELS[-1])


def recency_bucket(days: Column) -> Column:
    """Bucket of days since the last purchase; null days are ``never``."""
    out = F.when(days.isNull(), RECENCY_NONE)
    for edge, label in RECENCY_EDGES:
        out = out.when(days <= edge, label)
    return out.otherwise(RECENCY_REST)


def hash_mod(modulus: int, *parts: Column | str) -> Column:
    """First 32 bits of the MD5 of the parts joined by colons, modulo ``modulus``."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(modulus)).cast("int")


def ratio(above: Column, below: Column) -> Column:
    """Quotient as a double, null where the divisor is 0 or null."""
    return F.when(below != 0, above.cast("double") / below.cast("double"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; null elements are 0, and so is the result if a norm is 0 or a side is missing."""
    zero = F.lit(0.0)
    value = lambda x: F.coalesce(x.cast("double"), zero)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: value(x) * value(y)), zero, lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, zero, lambda s, x: s + value(x) * value(x)))
    both = norm(a) * norm(b)
    return F.coalesce(F.when(both != 0, dot / both), zero)
