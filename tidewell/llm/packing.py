"""Power-of-two packing: documents become sequences of binary lengths.

A document of n ids is cut into n // 2048 full pieces and, for the rest, one
piece per set bit of its length, largest first. Each piece is a sequence of its
own, so no sequence crosses documents and none needs padding. Sequences of
equal length form a bucket; a batch is taken from one bucket.

One pass, no shuffle: ids are numbered by task and bucket, so a sequence's id
comes from bucket, input partition and running number. The input must be a
table scan, whose partitions and row order are the same on every attempt.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import arrow_map

MAX_LENGTH = 2048
END_ID = 1
#: Texts over this many characters go to the tokenizers library, whose regular expressions have no stack limit.
LONG_TEXT = 1_000_000
#: Bits of a sequence id: bucket | partition | running number.
PARTITION_BITS, RUNNING_BITS = 24, 34

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
])


def binary_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of n ids: full ones, then the set bits of the rest."""
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


@lru_cache(maxsize=4)
def _encoder(json_path: str, ranks_path: str | None):
    """A function from text to the ids that the tokenizer file gives."""
    @lru_cache(maxsize=1)
    def exact():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(json_path)

    def by_file(text: str) -> list[int]:
        return exact().encode(text, add_special_tokens=False).ids

    if ranks_path is None:
        return by_file
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(json_path, encoding="utf-8") as f:
        described = json.load(f)
    marks = [t["content"] for t in described["added_tokens"]]
    if len(described["model"]["vocab"]) - len(ranks) not in (0, len(marks)):
        raise ValueError("the ranks are not those of the tokenizer file")
    del described
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_ranks(text: str) -> list[int]:
        if len(text) > LONG_TEXT or any(m in text for m in marks):
            return by_file(text)
        return fast.encode_ordinary(text)

    return by_ranks


def pack(documents: DataFrame, tokenizer: str, ranks: str | None = None, longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document: ids (little-endian uint32), place and sequence.

    ``tokenizer`` is the path of a tokenizers file; ``ranks``, when given, is the
    same vocabulary as merge ranks, which encodes several times faster to the
    same ids. A null or empty text has the end id alone. A repeated row is packed
    again, under the same doc_id. An empty table gives no rows; further columns
    are ignored. Long texts cost memory in proportion to one text.
    """
    top = longest.bit_length() - 1

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        encode = _encoder(tokenizer, ranks)
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        if part >> PARTITION_BITS:
            raise ValueError("more partitions than a sequence id can number")
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = [*encode(text.as_py() or ""), end_id]
            data = _little_endian(ids)
            start = 0
            for length in binary_lengths(len(ids), longest):
                bucket = length.bit_length() - 1
                running[bucket] += 1
                if running[bucket] >> RUNNING_BITS:
                    raise ValueError("more sequences in a task than a sequence id can number")
                number = ((bucket << PARTITION_BITS | part) << RUNNING_BITS) | (running[bucket] - 1)
                yield doc_id, start, length, data[4 * start : 4 * (start + length)], len(ids), number, 0
                start += length

    running = [0] * (top + 1)
    return arrow_map(documents.select("doc_id", "text"), rows, PIECES)


def _little_endian(ids: list[int]) -> bytes:
    import numpy as np

    return np.asarray(ids, dtype="<u4").tobytes()


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences to one folder per length, so that a batch reads equal lengths."""
    pieces.write.partitionBy("length").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def ids_crc32(ids: list[int]) -> int:
    """What ``digest`` gives for a list of ids."""
    return zlib.crc32(_little_endian(ids))
