"""Helpers shared by the corpus operators: shared-folder tables and Arrow passes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewell.session import ship
from tidewell.sources.shared import forget, new_path, remove, shared_dir, written

__all__ = ["Shared", "arrow_filter", "arrow_map", "forget", "named", "new_path", "pack_rows", "prepare", "remove", "shared_dir", "text_bytes", "written"]

#: An output batch is handed on once it holds this many rows, or values of about this many bytes.
FLUSH_ROWS, FLUSH_BYTES = 20_000, 8_000_000
#: Texts move to Python in batches of about so many bytes, where the session has the default of 64 MB.
BATCH = "16m"
_DEFAULT_BATCH = "67108864b"


def prepare(spark: SparkSession) -> None:
    """What each Arrow pass needs: this package on the workers, and batches that leave room for long texts."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == _DEFAULT_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


class Shared:
    """A broadcast of bounded size with an id, so that a worker builds what it derives once."""

    def __init__(self, spark: SparkSession, value):
        self.cast, self.id = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    def built(self, build: Callable, keep: int = 2):
        """``build(value)``, kept in this worker; the oldest of more than ``keep`` goes."""
        if self.id not in _built:
            while len(_built) >= keep:
                del _built[next(iter(_built))]
            _built[self.id] = build(self.cast.value)
        return _built[self.id]


_built: dict[str, object] = {}


def arrow_filter(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``df`` that ``keep`` marks, all columns as they are, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch), pa.bool_()))

    prepare(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def named(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column by name."""
    return batch.column(batch.schema.get_field_index(name))


def _weight(value: object) -> int:
    """About how many bytes a value of a row takes."""
    if isinstance(value, bytes | str):
        return len(value)
    if isinstance(value, list):
        return 8 * len(value) + (sum(map(len, value)) if value and isinstance(value[0], bytes | str) else 0)
    return 8


def arrow_map(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[tuple]], schema: str | object) -> DataFrame:
    """Map each Arrow batch to tuples and return them as a frame of ``schema``.

    ``rows`` yields tuples in the order of the schema's columns. Output batches
    are handed on by rows and bytes, so a worker holds one input batch, one
    output batch and one row at a time, whatever the partition's size.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in rows(batch):
                held.append(row)
                size += sum(map(_weight, row))
                if len(held) >= FLUSH_ROWS or size >= FLUSH_BYTES:
                    yield pack_rows(held, arrow)
                    held, size = [], 0
        if held:
            yield pack_rows(held, arrow)

    prepare(df.sparkSession)
    return df.mapInArrow(run, kind)


def pack_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as one batch."""
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, empty for null, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.view(kind):
        yield value.as_py() or b""
