"""Benchmark decontamination with an Aho-Corasick automaton.

A document word is hit if it lies in a window of an item: 13 consecutive words,
or all words of a shorter item. The windows of all items are the patterns of one
automaton, whose letters are words: each different word of the benchmark has a
number, which stands for it as one character. Each text is normalised (A-Z
lowered, every other ASCII character that is no letter or digit is a space),
turned into such letters, words that no item has being letter 0, and scanned
once; matches are mapped to word numbers and byte offsets of the original.

An automaton has ``WINDOWS`` windows at most, about a kilobyte each; a larger
benchmark needs several. A worker keeps up to ``KEPT`` of them; if there are
more, it gathers ``GROUP_BYTES`` of texts before it goes from one to the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import FLUSH_ROWS, Shared, named, pack_rows, prepare, text_bytes

WINDOW = 13
#: Windows of one automaton, automata that a worker keeps, and bytes of texts scanned at once by more automata than that.
WINDOWS, KEPT, GROUP_BYTES = 100_000, 2, 32_000_000
#: Bytes of a benchmark's texts beyond which it is refused, since the driver and each worker hold them.
BENCHMARK_BYTES = 256_000_000
#: A-Z to a-z, other ASCII outside 0-9a-z to a space; bytes of non-ASCII characters stay.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The first letter after those that are no characters of text.
AFTER_SURROGATES = 0xE000

HITS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


#: Names and words of some items.
Block = list[tuple[str | None, bytes]]


def blocks(benchmark: DataFrame, size: int = WINDOW, windows: int = WINDOWS) -> Iterator[Block]:
    """The items with words, read row by row, in blocks of ``windows`` windows and one item more at most."""
    items: Block = []
    used = 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator(prefetchPartitions=False):
        words = words_of(row[1])
        if not words:
            continue
        # a long item is cut into parts that overlap by a window less a word
        for at in range(0, max(1, len(words) - size + 1), windows):
            part = words[at : at + windows + size - 1]
            items.append((row[0], b" ".join(part)))
            used += max(1, len(part) - size + 1)
            if used >= windows:
                yield items
                items, used = [], 0
    if items:
        yield items


class Windows:
    """The automaton over the windows of a block."""

    def __init__(self, block: Block, size: int = WINDOW):
        self.letters: dict[bytes, str] = {}
        self.auto = ahocorasick.Automaton()
        self.found: list[tuple[int, set[str]]] = []  # length of a window, and the items that have it
        for name, text in block:
            words = text.split()
            spelt = "".join([self._letter(w) for w in words])
            length = min(size, len(words))
            for at in range(len(words) - length + 1):
                window = spelt[at : at + length]
                k = self.auto.get(window, None)
                if k is None:
                    k = len(self.found)
                    self.auto.add_word(window, k)
                    self.found.append((length, set()))
                if name is not None:
                    self.found[k][1].add(name)
        self.auto.make_automaton()

    def _letter(self, word: bytes) -> str:
        letter = self.letters.get(word)
        if letter is None:
            number = len(self.letters) + 1
            letter = self.letters[word] = chr(number if number < 0xD800 else number - 0xD800 + AFTER_SURROGATES)
        return letter

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Runs of hit words [first, after) and the items whose windows occur."""
        runs, seen = [], set()
        for end, k in self.auto.iter("".join(map(self.letters.get, words, repeat("\0")))):
            length = self.found[k][0]
            seen.add(k)
            if runs and runs[-1][1] >= end - length + 1 >= runs[-1][0]:
                runs[-1][1] = max(runs[-1][1], end + 1)
            else:
                runs.append([end - length + 1, end + 1])
        return runs, set().union(*(self.found[k][1] for k in seen))


def byte_spans(raw: bytes, runs: list[list[int]]) -> list[list[int]]:
    """Byte offsets [start, end) in the original text of runs of words."""
    if not runs:
        return []
    kept = np.frombuffer(raw.translate(NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], kept.astype(np.int8), [0]])))
    return [[int(edges[2 * a]), int(edges[2 * b - 1])] for a, b in runs]


def union(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _scanner(documents: DataFrame, benchmark: DataFrame, size: int, windows: int):
    """A function from raw texts to (n_words, runs of hit words, item ids) of each, and the bytes of texts it wants at once."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {total} bytes of text, over {BENCHMARK_BYTES}: scan parts of it one after the other")
    casts = [Shared(documents.sparkSession, b) for b in blocks(benchmark, size, windows)]

    def scan_all(texts: list[bytes]) -> list[tuple[int, list[list[int]], list[str]]]:
        sizes = [0] * len(texts)
        found: list[tuple[list[list[int]], set[str]]] = [([], set()) for _ in texts]
        for cast in casts or [None]:
            automaton = cast.built(lambda block: Windows(block, size), KEPT) if cast else None
            for i, raw in enumerate(texts):  # words are held for one text at a time
                words = raw.translate(NORMAL).split()
                sizes[i] = len(words)
                runs, names = automaton.scan(words) if automaton else ((), ())
                found[i][0].extend(runs)
                found[i][1].update(names)
        return [(n, union(runs), sorted(items)) for n, (runs, items) in zip(sizes, found, strict=True)]  # ids sorted as text

    return scan_all, 0 if len(casts) <= KEPT else GROUP_BYTES


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches of ``size`` bytes or a little more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def find_contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, windows: int = WINDOWS) -> DataFrame:
    """Per document: n_words, n_hit, items found and byte spans of the hit passages.

    A null text has no words. A benchmark item without words matches nothing;
    one without an id marks words but is not listed. Repeated documents give
    repeated rows; an empty table gives none, and an empty benchmark no hits.
    Further columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    scan_all, size_of_group = _scanner(documents, benchmark, size, windows)
    schema = to_arrow_schema(HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, size_of_group):
            ids = [x for b in group for x in b.column(0).to_pylist()]
            texts = [x for b in group for x in text_bytes(b.column(1))]
            rows = [(i, n, sum(b - a for a, b in runs), items, byte_spans(raw, runs)) for i, raw, (n, runs, items) in zip(ids, texts, scan_all(texts), strict=True)]
            for k in range(0, len(rows), FLUSH_ROWS):
                yield pack_rows(rows[k : k + FLUSH_ROWS], schema)

    prepare(documents.sparkSession)
    return documents.select("doc_id", "text").mapInArrow(run, HITS)


def is_contaminated(n_hit: int, n_words: int) -> bool:
    """At least a twentieth of the words are hit, and one at least."""
    return n_hit > 0 and 20 * n_hit >= n_words


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_contamination``."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW, windows: int = WINDOWS) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever their names.

    A null or empty text stays, repeated rows stay or go together, an empty
    table stays empty, and with an empty benchmark all stay.
    """
    scan_all, size_of_group = _scanner(documents, benchmark, size, windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, size_of_group):
            found = scan_all([x for b in group for x in text_bytes(named(b, "text"))])
            keep = iter([not is_contaminated(sum(b - a for a, b in runs), n) for n, runs, _ in found])
            for batch in group:
                yield batch.filter(pa.array([next(keep) for _ in range(batch.num_rows)], pa.bool_()))

    prepare(documents.sparkSession)
    return documents.mapInArrow(run, documents.schema)


def brute_force(text: str | None, items: list[tuple[str | None, str | None]], size: int = WINDOW) -> tuple[int, int, list[str], str]:
    """The same by comparing every window of the text, for tests."""
    words = (text or "").encode().translate(NORMAL).split()
    hit, names = set(), set()
    for name, item in items:
        wanted = (item or "").encode().translate(NORMAL).split()
        k = min(size, len(wanted))
        patterns = {tuple(wanted[i : i + k]) for i in range(len(wanted) - k + 1)} if k else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i : i + k]) in patterns:
                hit |= set(range(i, i + k))
                names.add(name)
    listed = sorted(n for n in names if n is not None)
    return len(words), len(hit), listed, hashlib.sha256(",".join(listed).encode()).hexdigest()
