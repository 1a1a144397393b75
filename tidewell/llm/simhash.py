"""SimHash near-duplicates with BK-trees.

Fingerprints are 64-bit SimHashes of 3-word shingles. Two fingerprints within
two bits agree on at least two of their four 16-bit blocks, so the distinct
fingerprints are dealt into shards by the six pairs of blocks. A shard with more
than ``SHARD`` members is dealt again by pairs of 8-bit blocks of the other 32
bits, which leaves at most 65,536 distinct fingerprints in any shard. Each shard
is indexed by a BK-tree whose children are keyed by their Hamming distance to
the parent, and a search follows only edges within the radius.

The trees travel with the shard's key instead of as broadcasts, since trees over
all fingerprints have no size bound. Found fingerprints leave the tree, so a
dense group costs one search per member and yields a star of links, not pairs.
Components come from alternating large-star and small-star rounds, each written
to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_map, forget, prepare, text_bytes, written

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Members of a shard beyond which it is dealt again by more bits.
SHARD = 4096
#: Documents to remove up to which their ids and text hashes are broadcast; more are joined by them.
BROADCAST = 1_000_000
#: Hashes whose bits are counted at once.
CHUNK = 1 << 15


def fingerprint(raw: bytes) -> int:
    """SimHash of a text's UTF-8 bytes; 0 without words.

    A bit is 1 if it is set in over half of the shingles' hashes, repeats
    included. A text of one or two words has one shingle, the whole sequence.
    """
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - SHINGLE + 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.dtype("<u8"), n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at : at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    """The 64-bit pattern as a signed long."""
    return value - (1 << 64) if value >> 63 else value


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp, the fingerprint as a signed long. A null text has no words."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, raw, text_hash in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            yield doc_id, text_hash, signed(fingerprint(raw))

    return arrow_map(documents.select("doc_id", "text", _text_hash().alias("text_hash")), rows, "doc_id long, text_hash long, fp long")


class BKTree:
    """Burkhard-Keller tree over 64-bit integers under Hamming distance."""

    def __init__(self) -> None:
        self.value: list[int] = []
        self.parent: list[int] = []
        self.children: list[dict[int, int]] = []
        self.alive: list[int] = []  # nodes of the subtree that are still in the tree
        self.gone: list[bool] = []

    def add(self, value: int) -> bool:
        """Insert a value; False if it is there already."""
        at = 0
        while self.value:
            d = (self.value[at] ^ value).bit_count()
            if not d:
                return False
            if d not in self.children[at]:
                break
            at = self.children[at][d]
        node = len(self.value)
        self.value.append(value)
        self.parent.append(at if node else -1)
        self.children.append({})
        self.alive.append(0)
        self.gone.append(False)
        if node:
            self.children[at][d] = node
        while node >= 0:
            self.alive[node] += 1
            node = self.parent[node]
        return True

    def take(self, value: int, radius: int = RADIUS) -> list[int]:
        """Remove and return the values within the radius."""
        found, stack = [], [0] if self.value and self.alive[0] else []
        while stack:
            node = stack.pop()
            d = (self.value[node] ^ value).bit_count()
            if d <= radius and not self.gone[node]:
                self.gone[node] = True
                found.append(node)
            stack += [c for k, c in self.children[node].items() if d - radius <= k <= d + radius and self.alive[c]]
        for node in found:
            while node >= 0:
                self.alive[node] -= 1
                node = self.parent[node]
        return [self.value[k] for k in found]


def shard_links(values: list[int], radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Links (member, first member) of each group of a shard, as signed longs."""
    tree = BKTree()
    for v in values:
        tree.add(v % (1 << 64))
    for v in list(tree.value):
        group = tree.take(v, 0)
        for member in group:  # grows while it is read
            group += tree.take(member, radius)
        for member in group[1:]:
            yield signed(member), signed(group[0])


def _block(k: int, bits: int) -> Column:
    return F.shiftrightunsigned("fp", k * bits).bitwiseAND((1 << bits) - 1)


def _keys() -> Column:
    """The six shard keys of a fingerprint: the pair of blocks and their 32 bits."""
    return F.array(*[F.lit(n << 52).cast("long") + F.shiftleft(_block(a, 16), 36) + F.shiftleft(_block(b, 16), 20) for n, (a, b) in enumerate(combinations(range(4), 2))])


def _finer_keys() -> Column:
    """For a key's large shard: six keys each, by pairs of 8-bit blocks of the rest."""
    by_pair = None
    for n, pair in enumerate(combinations(range(4), 2)):
        rest = [2 * k + h for k in range(4) if k not in pair for h in (0, 1)]
        finer = F.array(*[F.col("key") + F.lit((m + 1) << 16) + F.shiftleft(_block(a, 8), 8) + _block(b, 8) for m, (a, b) in enumerate(combinations(rest, 2))])
        here = F.shiftrightunsigned("key", 52) == n
        by_pair = F.when(here, finer) if by_pair is None else by_pair.when(here, finer)
    return by_pair


def links(nodes: DataFrame, shard: int = SHARD) -> DataFrame:
    """Links (a, b) that connect every two of the distinct ``fp`` within the radius.

    The closure of the links is that of all pairs; dense groups give stars.
    """
    keys = nodes.select("fp", F.explode(_keys()).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = keys.join(shared, "key").select("fp", F.explode(F.when(F.col("n") <= shard, F.array("key")).otherwise(_finer_keys())).alias("key"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, a, b = [], None, [], []

        def close() -> None:
            if len(held) > 1:
                for x, y in shard_links(held):
                    a.append(x)
                    b.append(y)

        for batch in batches:
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i < j and keys[i] != key:
                    close()
                    held, key = [], keys[i]
                held += values[i:j].tolist()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        close()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    sorted_keys = dealt.select("key", "fp").repartition("key").sortWithinPartitions("key")
    prepare(nodes.sparkSession)
    return sorted_keys.mapInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has a link: (node, root).

    Large-star and small-star rounds until nothing changes; the number of rounds
    grows with the logarithm of the longest chain. Every round is a table in the
    shared folder, so a lost executor repeats one round at most.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        then = written(small, "links")
        forget(now)
        now = then
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError("components did not settle")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id linked by near fingerprints.

    One row per input row. Texts without words share fingerprint 0 and are linked
    like any others; null texts count as empty. A null doc_id is no candidate for
    component_id but keeps its row. An empty table gives no rows; further columns
    are ignored.
    """
    return _grouped(documents).select("doc_id", "fp", "component_id")


#: Order of a component's rows: by doc_id, those without one last, then by text.
FIRST = ("no_id", "doc_id", "text_hash")


def _grouped(documents: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp, component_id, the component's first row by FIRST and its number of rows."""
    prints = written(fingerprints(documents), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min(order).alias("best"), F.count("*").alias("n"))
    roots = components(links(nodes))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", "best", "n", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.min("best").alias("best"), F.sum("n").alias("n"))
    labels = rooted.select("fp", "root").join(named, "root").select("fp", "component_id", "best", "n")
    return prints.join(labels, "fp").select("doc_id", "text_hash", "fp", "component_id", "best", "n")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``near_duplicates``."""
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each component: that of the smallest doc_id, rows without one last, then of the least text hash.

    Rows are told apart by doc_id and text, so a doc_id in several components
    loses only the rows that are not first in theirs. Of repeated rows of one
    doc_id and text the least by the values of all columns stays.
    """
    several = _grouped(documents).where("n > 1").withColumn("stays", F.col("best")["doc_id"].eqNullSafe(F.col("doc_id")) & (F.col("best")["text_hash"] == F.col("text_hash")))
    keys = several.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(F.first("stays").alias("__stays"), F.count("*").alias("__n"))
    keys = written(keys.where("NOT __stays OR __n > 1"), "removed")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(F.struct(*columns).alias("__row"), F.col("doc_id").alias("__id"), _text_hash().alias("__text"))  # names of further columns can't clash

    def matched(part: DataFrame, how: str) -> DataFrame:
        part = part.select("__doc", "__hash")
        at = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__hash"))
        return rows.join(F.broadcast(part) if few else part, at, how)

    few = keys.count() <= BROADCAST
    kept = matched(keys, "left_anti").select("__row")
    repeated = keys.where("__stays")
    if not repeated.isEmpty():
        least = matched(repeated, "left_semi").groupBy("__id", "__text").agg(F.min("__row").alias("__row"))
        kept = kept.unionByName(least.select("__row"))
    return kept.select("__row.*")
