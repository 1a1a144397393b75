"""Spark session defaults, and shipping this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
_shipped: set[str] = set()


def session(name: str = "tidewell", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; further settings as keywords with ``__`` for dots."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for each application.

    Nothing is sent where PYTHONPATH, which workers inherit, has it already.
    """
    app = spark.sparkContext.applicationId
    on_path = (os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)
    if app in _shipped or str(ROOT.parent) in on_path:
        return
    target = Path(tempfile.mkdtemp(prefix="tidewell-")) / "tidewell.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(ROOT.rglob("*.py")):
            z.write(path, path.relative_to(ROOT.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
