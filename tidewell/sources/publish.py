"""Publishing: all tables of a set or none, manifests, counts that must match."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.contracts import Contract, schema_of, validated


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def recover(spark: SparkSession, target: str) -> None:
    """Put back what was published before, if a publishing ended between its two renames."""
    final, fs = _fs(spark, target.rstrip("/"))
    before, _ = _fs(spark, f"{target.rstrip('/')}.before")
    if fs.exists(before):
        if fs.exists(final):
            fs.delete(before, True)
        else:
            fs.rename(before, final)


def open_published(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A published table; the one published before while or after a publishing is cut off."""
    for folder in (target.rstrip("/"), f"{target.rstrip('/')}.before"):
        place, fs = _fs(spark, f"{folder}/{name}")
        if fs.exists(place):
            return spark.read.parquet(f"{folder}/{name}")
    raise FileNotFoundError(f"{name} isn't published in {target}")


def publish_csv(spark: SparkSession, sources: dict[str, tuple[str, Contract]], target: str) -> None:
    """Read each CSV with its contract's columns as text, validate, and publish all tables at once.

    Nothing is published if any table breaks its contract: tables are written
    beside the target. When all are there, the tables published before are
    renamed, the new ones take their place, and only then the old ones go, so
    that at any time one of the two is whole.
    """
    target = target.rstrip("/")
    staging = f"{target}.staging"
    place, fs = _fs(spark, staging)
    recover(spark, target)
    fs.delete(place, True)
    try:
        for name, (path, contract) in sources.items():
            header = spark.read.option("header", True).csv(path)
            validated(header, contract).write.parquet(f"{staging}/{name}")
        final, _ = _fs(spark, target)
        before, _ = _fs(spark, f"{target}.before")
        if fs.exists(final) and not fs.rename(final, before):
            raise OSError(f"{target} can't be renamed")
        if not fs.rename(place, final):
            recover(spark, target)
            raise OSError(f"{staging} can't be renamed")
        fs.delete(before, True)
    finally:
        fs.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One UTF-8 file, replaced if it is there."""
    place, fs = _fs(spark, path)
    out = fs.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_manifest(spark: SparkSession, path: str, content: dict) -> None:
    """One JSON document beside a table."""
    write_text(spark, path, json.dumps(content, sort_keys=True))


def read_manifest(spark: SparkSession, path: str) -> dict:
    place, fs = _fs(spark, path)
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def pin(spark: SparkSession, path: str, model_id: str) -> None:
    """Name the one model that may serve."""
    write_manifest(spark, path, {"model_id": model_id})


def require_pinned(manifest: dict, pinned: str | None) -> None:
    """Raises unless the manifest is that of the pinned model; without a pin any model will do."""
    if pinned is not None and manifest.get("model_id") != pinned:
        raise RuntimeError(f"the model {manifest.get('model_id')} isn't the pinned one, {pinned}")


def assert_rows_match(df: DataFrame, manifest: dict, key: str = "rows") -> None:
    n = df.count()
    if n != manifest[key]:
        raise RuntimeError(f"the table has {n} rows, its manifest says {manifest[key]}")


def assert_exact(top12: DataFrame, n_customers: int, k: int = 12) -> None:
    """Exactly k rows for each of n customers."""
    got = top12.groupBy("customer_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("c"), F.min("n").alias("least"), F.max("n").alias("most")).first()
    if n_customers and (got["c"], got["least"], got["most"]) != (n_customers, k, k):
        raise RuntimeError(f"expected {k} rows for {n_customers} customers, found {got['least']} to {got['most']} for {got['c']}")


__all__ = ["assert_exact", "assert_rows_match", "open_published", "pin", "publish_csv", "read_manifest", "recover", "require_pinned", "schema_of", "write_manifest", "write_text"]
