"""Training-data pipeline: five corpus operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``. Operators are imported by the stages that
call them.

In every stage a null text counts as empty, an empty table gives none, and
columns beyond those of ``documents`` stay, whatever their names (packing keeps
doc_id alone); rows with a null doc_id are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content lines.

    Without labels of both classes the prior weights decide. Empty texts go;
    of repeated rows all stay or none.
    """
    from tidewell.llm import quality_crf

    return quality_crf.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates, by doc_id, those without one last, then by text.

    Of repeated rows one stays, and of all texts without words one.
    """
    from tidewell.llm import simhash

    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a twentieth of benchmark passages; with an empty benchmark, all.

    Of repeated rows all stay or none.
    """
    from tidewell.llm import decontamination

    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; repeated rows alike, null texts null."""
    from tidewell.llm import pii

    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids as sequences of binary lengths; an empty text has the end id, a repeated row is packed again."""
    import public_tokenizers

    from tidewell.llm import packing

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.digest(pieces)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("packing", packed),
]

#: Viterbi labelling, SimHash components and tokenizers are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, "stage")
    return docs
