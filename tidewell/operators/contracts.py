"""Table contracts, checked in one pass each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    """What a column must be: type, width, range, values, uniqueness, nulls."""

    kind: str
    nullable: bool = False
    width: int | None = None
    least: float | None = None
    values: tuple = ()
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    """Columns of a table; no others are allowed."""

    columns: dict[str, Column] = field(default_factory=dict)


#: The contracts of the four tables.
TRANSACTIONS = Contract({"t_dat": Column("date"), "customer_id": Column("string", width=64), "article_id": Column("string", width=10), "price": Column("double", least=0), "sales_channel_id": Column("int", values=(1, 2))})
CUSTOMERS = Contract({"customer_id": Column("string", width=64, unique=True), "FN": Column("double", nullable=True), "Active": Column("double", nullable=True), "club_member_status": Column("string", nullable=True), "fashion_news_frequency": Column("string", nullable=True), "age": Column("int", nullable=True), "postal_code": Column("string", width=64)})
SAMPLE_SUBMISSION = Contract({"customer_id": Column("string", width=64, unique=True), "prediction": Column("string")})
#: Of the articles, the columns with rules; descriptive text columns are added as plain strings.
ARTICLE_CODES = {"article_id": Column("string", width=10, unique=True), "product_code": Column("string", width=7), "colour_group_code": Column("string", width=2), "detail_desc": Column("string", nullable=True)}


def articles_contract(descriptive: Sequence[str]) -> Contract:
    return Contract({**ARTICLE_CODES, **{c: Column("string") for c in descriptive if c not in ARTICLE_CODES}})


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    return [c for c in contract.columns if c not in df.columns]


def extra_columns(df: DataFrame, contract: Contract) -> list[str]:
    return [c for c in df.columns if c not in contract.columns]


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """column_name, rule and n_bad of every rule: all in one aggregate.

    A value that can't be cast to the column's type breaks the rule ``type``.
    Duplicates are counted over rows beyond the first, by one more group.
    """
    if missing := missing_columns(df, contract):
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    checks = []
    for name, c in contract.columns.items():
        raw, value = F.col(f"`{name}`"), F.try_cast(F.col(f"`{name}`"), c.kind) if hasattr(F, "try_cast") else F.col(f"`{name}`").try_cast(c.kind)
        checks.append((name, "type", raw.isNotNull() & value.isNull()))
        if not c.nullable:
            checks.append((name, "not null", raw.isNull()))
        if c.width is not None:
            checks.append((name, "width", F.length(value) != c.width))
        if c.least is not None:
            checks.append((name, "range", value < c.least))
        if c.values:
            checks.append((name, "values", ~value.isin(*c.values)))
    got = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"c{k}") for k, (_, _, bad) in enumerate(checks)])
    out = got.select(F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(r).alias("rule"), F.col(f"c{k}").alias("n_bad")) for k, (n, r, _) in enumerate(checks)])))
    for name, c in contract.columns.items():
        if c.unique:
            dup = df.groupBy(F.col(f"`{name}`").alias("v")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad"))
            out = out.unionByName(dup.select(F.lit(name).alias("column_name"), F.lit("unique").alias("rule"), "n_bad"))
    if extra := extra_columns(df, contract):
        out = out.unionByName(df.sparkSession.createDataFrame([(c, "allowed", 1) for c in extra], "column_name string, rule string, n_bad long"))
    return out


def validated(df: DataFrame, contract: Contract) -> DataFrame:
    """The frame cast to its contract; raises with all broken rules."""
    broken = violations(df, contract).where("n_bad > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r['column_name']}: {r['rule']} ({r['n_bad']})" for r in sorted(broken)))
    return df.select(*[F.col(f"`{n}`").cast(c.kind).alias(n) for n, c in contract.columns.items()])


def schema_of(contract: Contract) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{n}` {c.kind}" for n, c in contract.columns.items()))
