"""Hidden Markov language model over word classes, trained by Baum-Welch.

A token's class is a hash of its last three bytes, the end of a text a class of
its own, so the model has a fixed size: latent states emit classes, and a class
emits its words by add-one counts over all training tokens:

    p(text) = sum over state paths of prod p(state) p(class | state) * prod p(word | class)

Passes over the corpus:
1. words are counted in each batch, then summed by word (the counts stay a table);
2. each text becomes its sequence of classes, the summed log-counts of words
   among the ``HEAD`` most frequent ones (a broadcast of ``HEAD_BYTES`` at most), and the rest
   of its words, which are joined with the table of counts by word;
3. expected counts of each Baum-Welch round are summed over partitions by state
   and class; the driver gets one matrix of fixed size;
4. the scaled forward recursion gives the likelihood of every text.

A text is cut into segments whose transfer matrices are computed side by side
and multiplied in order; this is the forward recursion in another order of
multiplication, exact for any length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import Shared, arrow_map, prepare, text_bytes, written

STATES = 6
CLASSES = 1024  # of words; class 0 is the end of a text
ROUNDS = 4
#: Most frequent words whose counts are broadcast, their bytes in all and those of each; other words are joined.
HEAD, HEAD_BYTES, WORD_BYTES = 100_000, 4_000_000, 64
#: Classes of the following token by which classes are grouped before the first round.
CONTEXT = 32
SEGMENT = 128
BLOCK = 4096  # segments that are worked on at once
SCALED = 16  # steps between scalings of the recursions
HELD_OUT, FOLDS = 2, 7


def tokens(raw: bytes) -> list[bytes]:
    """Lower-cased words, then the end, which is the empty word."""
    return [*raw.lower().split(), b""]


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES + 1 if word else 0


def is_held_out(doc_id: int | None) -> bool:
    """Decided by CRC-32 of the id as text; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


# --- the model on one machine -------------------------------------------------


class Model:
    """Start, transition and class probabilities; words come from counts outside."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit  # (K,), (K, K), (K, classes)

    def scaled(self) -> tuple[np.ndarray, np.ndarray]:
        """Class by state, each class divided by its largest value, and that value's log10."""
        top = self.emit.max(0)
        return np.ascontiguousarray((self.emit / top).T), np.log10(top)


class Segments:
    """Sequences of classes cut into segments, longest segments first."""

    def __init__(self, sequences: list[np.ndarray]):
        n = np.array([len(s) for s in sequences])
        self.pieces = -(-n // SEGMENT)
        self.doc = np.repeat(np.arange(len(n)), self.pieces)
        first = np.concatenate([[0], np.cumsum(self.pieces)[:-1]]) if len(n) else np.zeros(0, int)
        self.at = np.arange(len(self.doc)) - np.repeat(first, self.pieces)  # place in its text
        self.size = np.minimum(SEGMENT, n[self.doc] - self.at * SEGMENT)
        self.classes = np.zeros((len(self.doc), SEGMENT), np.int16)
        flat = np.concatenate(sequences) if len(n) else np.zeros(0, np.int16)
        self.classes[np.arange(SEGMENT)[None] < self.size[:, None]] = flat
        self.first = first

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """Numbers of segments by falling size, their classes, and how many reach each place."""
        order = np.argsort(-self.size, kind="stable")
        for k in range(0, len(order), BLOCK):
            some = order[k : k + BLOCK]
            size = self.size[some]
            yield some, self.classes[some], np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist()


def transfers(model: Model, seg: Segments) -> tuple[np.ndarray, np.ndarray]:
    """Transfer matrix of each segment, scaled to a largest value of 1, and its log10 scale."""
    emit, top = model.scaled()
    k = len(model.start)
    out, scale = np.empty((len(seg.doc), k, k)), np.zeros(len(seg.doc))
    eye = np.eye(k)
    for some, classes, reach in seg.blocks():
        m = np.where((seg.at[some] == 0)[:, None, None], eye, model.step) * emit[classes[:, 0]][:, None, :]
        logs = np.zeros(len(some))
        for t in range(1, len(reach)):
            n = reach[t]
            if not n:
                break
            m[:n] = (m[:n].reshape(-1, k) @ model.step).reshape(n, k, k) * emit[classes[:n, t]][:, None, :]
            if t % SCALED == 0:
                big = m[:n].max((1, 2), keepdims=True)
                m[:n] /= big
                logs[:n] += np.log10(big[:, 0, 0])
        big = m.max((1, 2), keepdims=True)
        out[some] = m / big
        inside = np.arange(SEGMENT)[None] < seg.size[some][:, None]
        scale[some] = logs + np.log10(big[:, 0, 0]) + (top[classes] * inside).sum(1)
    return out, scale


def entries(model: Model, seg: Segments, matrices: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State distribution before each segment, and log10 likelihood of each text."""
    k = len(model.start)
    into, total = np.empty((len(seg.doc), k)), np.zeros(len(seg.pieces))
    v = np.tile(model.start, (len(seg.pieces), 1))
    for j in range(int(seg.pieces.max(initial=0))):
        docs = np.flatnonzero(seg.pieces > j)
        at = seg.first[docs] + j
        into[at] = v[docs]
        w = np.einsum("ni,nij->nj", v[docs], matrices[at])
        z = w.sum(1)
        v[docs] = w / z[:, None]
        total[docs] += np.log10(z) + scale[at]
    return into, total


def log_likelihood(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each class sequence."""
    seg = Segments(sequences)
    return entries(model, seg, *transfers(model, seg))[1]


def expected_counts(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of starts, transitions and emitted classes."""
    seg = Segments(sequences)
    matrices, scale = transfers(model, seg)
    into, _ = entries(model, seg, matrices, scale)
    k, n_classes = model.emit.shape
    after = np.ones((len(seg.doc), k))  # weight of what follows each segment
    for j in range(int(seg.pieces.max(initial=0)) - 2, -1, -1):
        at = seg.first[np.flatnonzero(seg.pieces > j + 1)] + j
        w = np.einsum("nij,nj->ni", matrices[at + 1], after[at + 1])
        after[at] = w / w.sum(1, keepdims=True)
    emit, _ = model.scaled()
    start, step, seen = np.zeros(k), np.zeros((k, k)), np.zeros((k, n_classes))
    one = np.ones((k, 1))
    for some, classes, reach in seg.blocks():
        head = (seg.at[some] == 0)[:, None]
        # forward: each step's vectors may have any scale, so they are scaled now and then
        alpha = np.zeros((len(reach), len(some), k))
        alpha[0] = np.where(head, into[some], into[some] @ model.step) * emit[classes[:, 0]]
        for t in range(1, len(reach)):
            n = reach[t]
            np.multiply(alpha[t - 1, :n] @ model.step, emit[classes[:n, t]], out=alpha[t, :n])
            if t % SCALED == 0:
                alpha[t, :n] /= alpha[t, :n] @ one
        # backward: a step's state probabilities replace its forward vectors
        beta = after[some].copy()
        for t in range(len(reach) - 1, -1, -1):
            n = reach[t]
            tail = emit[classes[:n, t]] * beta[:n]
            before = alpha[t - 1, :n] if t else into[some]
            reached = before @ model.step
            if not t:
                reached = np.where(head, before, reached)
            joint = reached * tail
            weight = 1 / (joint @ one)
            if t:
                step += (before * weight).T @ tail
            else:
                inner = ~head[:, 0]
                step += (before * weight)[inner].T @ tail[inner]
            np.multiply(joint, weight, out=alpha[t, :n])
            beta[:n] = tail @ model.step.T
            if t % SCALED == 0:
                beta[:n] /= beta[:n] @ one
        start += alpha[0][head[:, 0]].sum(0)
        inside = np.arange(len(reach))[:, None] < seg.size[some][None]
        places = classes.T[: len(reach)][inside]
        weights = alpha[inside]
        for state in range(k):
            seen[state] += np.bincount(places, weights[:, state], n_classes)
    return start, step * model.step, seen


def maximised(start: np.ndarray, step: np.ndarray, seen: np.ndarray) -> Model:
    """The model of expected counts, with a little of each outcome added."""
    share = lambda x, more: (x + more) / (x + more).sum(-1, keepdims=True)
    return Model(share(start, 0.1), share(step, 0.1), share(seen, 0.01))


def first_model(totals: np.ndarray, follow: np.ndarray, states: int = STATES) -> Model:
    """States from groups of classes that are followed by the same classes.

    ``totals``: tokens of each class. ``follow``: class by context class, counts.
    Centres are the heaviest class and then those farthest from all before; a
    few rounds of k-means follow. Nothing is drawn at random.
    """
    n = len(totals)
    profile = np.sqrt((follow + 0.1) / (follow + 0.1).sum(1, keepdims=True))
    weight = np.sqrt(totals.astype(float))
    centres = profile[[int(weight.argmax())]]
    while len(centres) < states:
        far = ((profile[:, None] - centres[None]) ** 2).sum(-1).min(1) * weight
        centres = np.vstack([centres, profile[int(far.argmax())]])
    for _ in range(15):
        group = ((profile[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        for s in range(states):
            w = weight * (group == s)
            if w.sum():
                centres[s] = (profile * w[:, None]).sum(0) / w.sum()
    favour = np.full((states, n), 0.3 / max(1, states - 1))
    favour[group, np.arange(n)] = 0.7
    favour[:, 0] = 1 / states  # the end follows any state
    emit = favour * (totals + 1.0)
    step = np.full((states, states), 0.3 / max(1, states - 1))
    np.fill_diagonal(step, 0.7)
    return Model(np.full(states, 1 / states), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


# --- the model on Spark ------------------------------------------------------


def word_counts(documents: DataFrame) -> DataFrame:
    """word (bytes), cls, c over the training documents; the end is the empty word."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        counts: Counter = Counter()
        for doc_id, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            if not is_held_out(doc_id):
                counts.update(tokens(raw))
        for word, c in counts.items():
            yield word, word_class(word), c

    counted = arrow_map(documents.select("doc_id", "text"), rows, "word binary, cls int, c long")
    return counted.groupBy("word", "cls").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int, most_bytes: int = HEAD_BYTES) -> DataFrame:
    """Words of ``WORD_BYTES`` at most, at least as frequent as a threshold that keeps both bounds.

    The threshold comes from a histogram of counts in steps of a sixteenth of a
    doubling, so no task sends more than its share of those words to the driver.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 16).cast("int")
    short = counts.where(F.octet_length("word") <= WORD_BYTES)
    steps = short.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.sum(F.octet_length("word")).alias("bytes")).collect()  # 16 rows a doubling at most
    least, taken, size = None, 0, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        taken, size = taken + r["n"], size + r["bytes"]
        if taken > most or size > most_bytes:
            break
        least = r["step"]
    return short.where(F.lit(False) if least is None else step >= least)


def encode(documents: DataFrame, head: Shared) -> DataFrame:
    """Each text's classes, its part of the sum of log10(c + 1), and the words still to look up."""

    def build(value: tuple[list[bytes], np.ndarray]) -> tuple:
        words, counts = value
        classes = np.array([*map(word_class, words), 0], np.int16)
        return {w: k for k, w in enumerate(words)}, classes, np.append(np.log10(counts + 1.0), 0.0)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        index, head_class, head_log = head.built(build)
        part = TaskContext.get().partitionId()
        for doc_id, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            words = tokens(raw)
            at = np.fromiter(map(index.get, words, repeat(-1)), np.int32, len(words))
            classes = head_class[at]
            rare = np.flatnonzero(at < 0)
            others = [words[k] for k in rare.tolist()]
            classes[rare] = [word_class(w) for w in others]
            numbered[0] += 1
            rest = Counter(others)
            yield (part << 36) + numbered[0], doc_id, is_held_out(doc_id), len(words), len(words) - len(rare), float(head_log[at].sum()), classes.astype("<i2").tobytes(), list(rest), list(rest.values())

    numbered = [0]
    return arrow_map(documents.select("doc_id", "text"), rows, "row long, doc_id long, held_out boolean, n_tokens long, known long, log_sum double, classes binary, rest array<binary>, times array<long>")


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<i2") for x in text_bytes_of(column)]


def text_bytes_of(column: pa.Array) -> Iterator[bytes]:
    for x in column:
        yield x.as_py()


def _chunks(sequences: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Lists of about a million tokens, or one text."""
    held, n = [], 0
    for s in sequences:
        held.append(s)
        n += len(s)
        if n >= 1_000_000:
            yield held
            held, n = [], 0
    if held:
        yield held


def _summed(encoded: DataFrame, add, size: int) -> np.ndarray:
    """The sum over training texts of a vector of fixed size that ``add`` makes from class sequences.

    Partial vectors are summed by place on the executors; the driver gets one.
    """
    prepare(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for some in _chunks(_sequences(batch.column(0))):
                total += add(some)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], names=["at", "x"])

    parts = encoded.where("NOT held_out").select("classes").mapInArrow(run, "at int, x double")
    out = np.zeros(size)
    for r in parts.groupBy("at").agg(F.sum("x").alias("x")).toPandas().itertuples():
        out[r.at] = r.x
    return out


def baum_welch(encoded: DataFrame, totals: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Train on all training texts; every round is one pass over their classes."""
    n = len(totals)
    near = np.argsort(-totals, kind="stable")[:CONTEXT]
    place = np.full(n, -1)
    place[near] = np.arange(len(near))

    def follow(sequences: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(n * CONTEXT)
        for s in sequences:
            to = place[s[1:]]
            out += 0 if not (to >= 0).any() else np.bincount(s[:-1][to >= 0].astype(np.int64) * CONTEXT + to[to >= 0], minlength=n * CONTEXT)
        return out

    model = first_model(totals, _summed(encoded, follow, n * CONTEXT).reshape(n, CONTEXT), states)
    for _ in range(rounds):
        counts = _summed(encoded, lambda s, m=model: np.concatenate([x.ravel() for x in expected_counts(m, s)]), states + states * states + states * n)
        model = maximised(counts[:states], counts[states : states + states * states].reshape(states, states), counts[states + states * states :].reshape(states, n))
    return model


@dataclass(frozen=True)
class Learned:
    """What the training documents gave: the model, counts of words (a table) and of classes, and all texts as classes."""

    model: Model
    counts: DataFrame
    totals: np.ndarray  # tokens of each class
    kinds: np.ndarray  # different words of each class
    encoded: DataFrame

    def word_logs(self) -> np.ndarray:
        """log10 of what a word's count and one is divided by, for each class."""
        return np.log10(self.totals + self.kinds + 1)


def learn(documents: DataFrame, states: int = STATES, rounds: int = ROUNDS, head_words: int = HEAD, head_bytes: int = HEAD_BYTES) -> Learned:
    """Count words, encode all texts and train the model on the training documents."""
    counts = written(word_counts(documents), "counts")
    by_class = counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # one row per class
    totals, kinds = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in by_class:
        totals[r["cls"]], kinds[r["cls"]] = r["n"], r["v"]
    top = frequent(counts, head_words, head_bytes).select("word", "c").toPandas()
    head = Shared(documents.sparkSession, (list(map(bytes, top["word"])), top["c"].to_numpy(np.int64)))
    encoded = written(encode(documents, head), "encoded")
    return Learned(baum_welch(encoded, totals, states, rounds), counts, totals, kinds, encoded)


def score(documents: DataFrame, states: int = STATES, rounds: int = ROUNDS, head_words: int = HEAD, head_bytes: int = HEAD_BYTES) -> DataFrame:
    """Unigram base and HMM score (log10) of every text, one row per input row.

    Null texts are empty and have the end alone. Without training documents every
    word is unknown and the classes are equally probable. An empty table gives no
    rows; repeated rows are counted and scored each; further columns are ignored.
    """
    learned = learn(documents, states, rounds, head_words, head_bytes)
    counts, encoded, model, in_class = learned.counts, learned.encoded, learned.model, learned.word_logs()
    n, v = int(learned.totals.sum()), int(learned.kinds.sum())

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        sequences = _sequences(batch.column(1))
        done = 0
        for some in _chunks(sequences):
            for s, x in zip(some, log_likelihood(model, some).tolist(), strict=True):
                yield batch.column(0)[done].as_py(), x - float(in_class[s].sum())
                done += 1

    classes = arrow_map(encoded.select("row", "classes"), rows, "row long, by_class double")
    rare = encoded.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    found = rare.join(counts.select("word", "c"), "word")
    looked = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("more_log"), F.sum("times").alias("more_known"))
    plain = encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "log_sum")
    both = plain.join(classes, "row").join(looked, "row", "left")
    logs = F.col("log_sum") + F.coalesce("more_log", F.lit(0.0))
    return both.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (logs + F.col("by_class")).alias("score"),
    )
