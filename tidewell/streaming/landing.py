"""Transactions that arrive as files: each micro-batch is validated and appended.

The retail semantics are batch; this only feeds the batch operators. A batch is
written under its number, so that a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.contracts import Contract, schema_of, validated


def land(spark: SparkSession, source: str, target: str, checkpoint: str, contract: Contract) -> StreamingQuery:
    """Start a query that lands all files now in ``source`` and then ends."""

    def put(batch: DataFrame, number: int) -> None:
        validated(batch, contract).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema_of(contract)).parquet(source)
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
