"""The retail tables: explicit schemas, readers, and the adapter for the test tables."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: First day of the validation week of the test tables.
ANCHOR = datetime.date(2001, 7, 26)

TRANSACTIONS = T.StructType([T.StructField("t_dat", T.DateType()), T.StructField("customer_id", T.StringType()), T.StructField("article_id", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("sales_channel_id", T.IntegerType())])
CUSTOMERS = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("FN", T.DoubleType()), T.StructField("Active", T.DoubleType()), T.StructField("club_member_status", T.StringType()), T.StructField("fashion_news_frequency", T.StringType()), T.StructField("age", T.IntegerType()), T.StructField("postal_code", T.StringType())])


@dataclass(frozen=True)
class Retail:
    """Transactions, articles, customers and article text vectors."""

    tx: DataFrame
    articles: DataFrame
    customers: DataFrame
    vectors: DataFrame


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with header, read with a declared schema so that codes keep their zeros."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def _id(column: str, width: int = 10):
    return F.lpad(F.col(column).cast("string"), width, "0")


def from_star(spark: SparkSession, sf_dir: str) -> Retail:
    """The retail tables made from the whole star schema of the test tables.

    Lines of orders are transactions, parts are articles, five neighbouring
    parts are one product; vectors are the embeddings with the part's number, if
    there is one.
    """
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    orders = read("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("t_dat"))
    lines = read("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus")
    tx = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "t_dat", _id("o_custkey").alias("customer_id"), _id("l_partkey").alias("article_id"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("sales_channel_id"),
    )
    documents = read("documents").select(F.col("doc_id").alias("p_partkey"), F.col("text").alias("detail_desc"))
    parts = read("part").join(documents, "p_partkey", "left")
    articles = parts.select(
        _id("p_partkey").alias("article_id"),
        F.lpad(F.floor(F.col("p_partkey") / 5).cast("string"), 7, "0").alias("product_code"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("colour_group_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("garment_group_name"),
        F.col("p_brand").alias("department_name"),
        F.col("p_type").alias("product_type_name"),
        F.concat(F.lit("group "), F.floor(F.col("p_size") / 10).cast("string")).alias("index_group_name"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("detail_desc")).alias("detail_desc"),
    )
    customers = read("customer").select(
        _id("c_custkey").alias("customer_id"),
        F.when(F.col("c_nationkey") % 2 == 0, 1.0).alias("FN"),
        F.when(F.col("c_nationkey") % 4 == 0, 1.0).alias("Active"),
        F.col("c_mktsegment").alias("club_member_status"),
        F.when(F.col("c_nationkey") % 3 == 0, "NONE").when(F.col("c_nationkey") % 3 == 1, "Regularly").alias("fashion_news_frequency"),
        F.when(F.col("c_custkey") % 17 != 0, (18 + F.col("c_custkey") % 60).cast("int")).alias("age"),
        F.lpad(F.col("c_nationkey").cast("string"), 64, "0").alias("postal_code"),
    )
    vectors = read("embeddings").select(_id("vec_id").alias("article_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    return Retail(tx, articles, customers, vectors)
