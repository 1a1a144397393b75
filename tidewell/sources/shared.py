"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

_created: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master may lack it, and gets a temporary folder."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="tidewell-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path in the shared folder, removed when Python ends."""
    path = f"{shared_dir(spark)}/tidewell-{name}-{uuid.uuid4().hex[:12]}"
    if not _created:
        atexit.register(_sweep)
    _created[path] = spark
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path with Hadoop's file system API."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _created.pop(path, None)


def _sweep() -> None:
    for path, spark in list(_created.items()):
        try:
            remove(spark, path)
        except Exception:  # the session has ended; the folder's owner cleans up
            _created.pop(path, None)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again, which cuts lineage for good."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidewell_path = path
    return out


def forget(df: DataFrame) -> None:
    """Remove the table behind a frame that ``written`` returned."""
    remove(df.sparkSession, df._tidewell_path)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver collect its garbage, after which Spark's cleaner drops what no frame holds any more.

    Shuffles, broadcasts and plans of many short jobs would else stay until the
    driver's heap is full.
    """
    gc.collect()  # frames of Python that hold each other hold the driver's too
    spark._jvm.System.gc()


@contextmanager
def collecting(spark: SparkSession, seconds: float) -> Iterator[None]:
    """Collect the driver's garbage again and again beside one long call, whose finished rounds' shuffles would else stay to its end."""
    over = threading.Event()

    def run() -> None:
        while not over.wait(seconds):
            collect_garbage(spark)

    beside = InheritableThread(target=run, daemon=True)
    beside.start()
    try:
        yield
    finally:
        over.set()
        beside.join()
