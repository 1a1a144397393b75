"""Text vectors of articles: TF-IDF reduced by PCA; no text is the zero vector.

The encoder is an argument, so that a sentence model can take TF-IDF's place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import IDF, PCA, HashingTF, StandardScaler, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW, DIMENSIONS = 384, 32


def missing(text: str = "detail_desc"):
    return F.col(text).isNull() | (F.col(text) == "")


def tfidf(df: DataFrame, text: str, to: str, size: int = RAW) -> DataFrame:
    """Hashed term frequencies by inverse document frequency."""
    words = Tokenizer(inputCol=text, outputCol="__words").transform(df)
    counts = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=size).transform(words)
    return IDF(inputCol="__tf", outputCol=to).fit(counts).transform(counts).drop("__words", "__tf")


def article_vectors(articles: DataFrame, dimensions: int = DIMENSIONS, encoder: Callable[[DataFrame, str, str], DataFrame] = tfidf) -> DataFrame:
    """article_id, detail_desc_missing, vector: fitted on texts that exist; missing texts are never encoded.

    Spark's PCA doesn't subtract the mean when it transforms, so vectors are
    centred first.
    """
    base = articles.select("article_id", "detail_desc")
    known = encoder(base.where(~missing()), "detail_desc", "__raw")
    centred = StandardScaler(inputCol="__raw", outputCol="__centred", withMean=True, withStd=False).fit(known).transform(known)
    reduced = PCA(k=dimensions, inputCol="__centred", outputCol="__pca").fit(centred).transform(centred)
    got = reduced.select("article_id", F.lit(False).alias("detail_desc_missing"), vector_to_array("__pca").alias("vector"))
    zeros = F.array_repeat(F.lit(0.0), dimensions)
    return got.unionByName(base.where(missing()).select("article_id", F.lit(True).alias("detail_desc_missing"), zeros.alias("vector")))
