"""Quality rules by line labelling: a linear-chain CRF marks boilerplate lines.

Every line with a word gets features of its own (symbols, capitals, repeated
words, an equal earlier line, ...); Viterbi decoding labels the sequence of
lines, and a document is retained if enough of its words are in content lines.

The CRF is fitted on the driver from a bounded sample of labelled documents
(``SAMPLE`` of each class, ``SAMPLE_LINES`` consecutive lines of each, from a
place that the hash of its id gives): the lines of a document carry its quality
label; documents with labels of both classes are left out. The fit is penalised towards ``PRIOR``, which
serves unchanged if there are no labels of both classes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq, mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import arrow_filter, arrow_map, named, text_bytes

#: Documents of each class, and lines of each of them, that the fit may use.
SAMPLE, SAMPLE_LINES = 500, 64
#: Least share of a document's words in content lines.
CONTENT_SHARE = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
FEATURES = ("bias", "symbols", "capitals", "word_after_itself", "few_distinct", "exclamation", "bars", "digits", "long_words", "seen_before", "no_stop", "few_words")
#: Log-odds of boilerplate for each feature before any label is seen.
PRIOR = (-3.0, 6.0, 5.0, 6.0, 5.0, 3.0, 4.0, 2.0, 3.0, 2.0, 0.3, 0.3)
#: Log-potentials of staying in content, leaving it, coming back, staying in boilerplate.
PRIOR_STEPS = (0.5, -0.5, -0.5, 0.5)
PULL = 0.001  # strength of the penalty towards the prior, for each line's log-likelihood
ROUNDS, RATE = 120, 0.08

BASE = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_lines long, n_boilerplate_lines long, content_share double, kept boolean"


def line_features(raw: bytes) -> tuple[list[tuple[float, ...]], list[int]]:
    """Features and number of words of every line that has a word."""
    out, sizes, seen = [], [], set()
    for line in raw.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        marks = sum(map(line.count, SYMBOLS))
        out.append((
            1.0,
            min(1.0, marks / n),
            sum(map(bytes.isupper, words)) / n if n > 2 else 0.0,
            sum(map(eq, words, words[1:])) / n,
            max(0.0, 1 - 2.5 * len(set(words)) / n) if n > 20 else 0.0,
            min(1.0, line.count(b"!") / n),
            min(1.0, line.count(b"|") / n),
            (len(line) - len(line.translate(None, b"0123456789"))) / len(line),
            min(1.0, max(0.0, len(line) / n - 16) / 16),
            1.0 if line in seen else 0.0,
            0.0 if words[-1][-1:] in b".!?:;\"" else 1.0,
            1.0 if n < 4 else 0.0,
        ))
        sizes.append(n)
        seen.add(line)
    return out, sizes


def viterbi(scores: list[float], steps: tuple[float, ...]) -> list[int]:
    """Most probable labels (1: boilerplate) given each line's log-odds of label 1.

    Of equally probable labellings, the one that is content as late as possible.
    """
    c, b, back = 0.0, scores[0] if scores else 0.0, []
    cc, cb, bc, bb = steps
    for s in scores[1:]:
        from_c, to_b = c + cc >= b + bc, b + bb > c + cb
        back.append((0 if from_c else 1, 1 if to_b else 0))
        c, b = max(c + cc, b + bc), max(b + bb, c + cb) + s
    if not scores:
        return []
    labels = [1 if b > c else 0]
    for choice in reversed(back):
        labels.append(choice[labels[-1]])
    return labels[::-1]


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = raw.split()
    n = len(words)
    chars = len(raw.decode()) - len(raw) + sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if n > 3:
        counts = Counter(zip(words, words[1:], words[2:], strict=False))
        if len(counts) < n - 2:
            again = np.fromiter((counts[x] > 1 for x in zip(words, words[1:], words[2:], strict=False)), np.bool_, n - 2)
            covered = np.zeros(n, np.bool_)
            for k in range(3):
                covered[k : n - 2 + k] |= again
            repeated = int(covered.sum())
    return n, chars, sum(map(raw.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def judge(raw: bytes, weights: tuple[float, ...], steps: tuple[float, ...], share: float = CONTENT_SHARE) -> tuple:
    """The columns of ``BASE`` after doc_id."""
    n, chars, symbols, dup, repeat = base_counts(raw)
    failed = n < MIN_WORDS or 100 * repeat > 50 * n
    rows, sizes = line_features(raw)
    labels = viterbi([sum(map(mul, x, weights)) for x in rows], steps)
    content = sum(size for size, label in zip(sizes, labels, strict=True) if not label)
    part = content / n if n else 0.0
    return n, chars, symbols, dup, repeat, failed, len(labels), sum(labels), part, not failed and part >= share


def fit_crf(rows: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Weights and steps with the highest penalised conditional likelihood.

    ``rows`` has a (lines, features) array for each document and ``labels`` the
    label of all its lines. Adam on exact gradients from the forward-backward
    recursion over all documents at once; the two classes count alike.
    """
    theta0 = np.array([*PRIOR, *PRIOR_STEPS])
    d = len(PRIOR)
    keep = [k for k, x in enumerate(rows) if len(x)]
    if len({labels[k] for k in keep}) < 2:
        return PRIOR, PRIOR_STEPS
    keep.sort(key=lambda k: -len(rows[k]))
    size = np.array([len(rows[k]) for k in keep])
    y = np.array([labels[k] for k in keep])
    longest = int(size[0])
    x = np.zeros((len(keep), longest, d))
    for i, k in enumerate(keep):
        x[i, : size[i]] = rows[k]
    active = [int((size > t).sum()) for t in range(longest)]
    lines = np.array([size[y == 0].sum(), size[y == 1].sum()])
    weight = (lines.sum() / 2 / lines)[y]  # of each document's lines
    mask = np.arange(longest)[None] < size[:, None]
    theta, m, v = theta0.copy(), np.zeros(d + 4), np.zeros(d + 4)
    truth = np.zeros(d + 4)
    truth[:d] = ((mask * (y * weight)[:, None])[:, :, None] * x).sum((0, 1))
    stays = (size - 1) * weight
    truth[d], truth[d + 3] = stays[y == 0].sum(), stays[y == 1].sum()
    for step in range(1, rounds + 1):
        s, a = x @ theta[:d], np.exp(theta[d:].reshape(2, 2))
        e = np.stack([np.ones_like(s), np.exp(np.clip(s, -30, 30))], -1)
        alpha = np.zeros_like(e)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(-1, keepdims=True)
        for t in range(1, longest):
            n = active[t]
            z = (alpha[:n, t - 1] @ a) * e[:n, t]
            alpha[:n, t] = z / z.sum(-1, keepdims=True)
        beta = np.ones((len(keep), 2))
        model = np.zeros(d + 4)
        p1 = np.zeros_like(s)
        for t in range(longest - 1, -1, -1):
            n = active[t]
            g = alpha[:n, t] * beta[:n]
            p1[:n, t] = g[:, 1] / g.sum(-1)
            if t:
                tail = e[:n, t] * beta[:n]
                pair = alpha[:n, t - 1][:, :, None] * a[None] * tail[:, None, :]
                z = pair.sum((1, 2), keepdims=True)
                model[d:] += (pair / z * weight[:n, None, None]).sum(0).ravel()
                back = tail @ a.T
                beta[:n] = back / back.sum(-1, keepdims=True)
        model[:d] = ((mask * weight[:, None] * p1)[:, :, None] * x).sum((0, 1))
        grad = (truth - model) / lines.sum() - PULL * (theta - theta0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return tuple(map(float, theta[:d])), tuple(map(float, theta[d:]))


def some_lines(doc_id: int, lines: list, most: int = SAMPLE_LINES) -> list:
    """``most`` consecutive lines from a place that depends on the id; all lines if there are no more."""
    at = zlib.crc32(str(doc_id).encode()) % max(1, len(lines) - most + 1)
    return lines[at : at + most]


def train(documents: DataFrame, labels: DataFrame | None, sample: int = SAMPLE) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Fit the CRF on the ``sample`` labelled documents of each class first by hash of their id."""
    if labels is None:
        return PRIOR, PRIOR_STEPS
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("__most")).where("quality = __most").drop("__most")
    chosen = None
    for q in (0, 1):
        part = known.where(F.col("quality") == q).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    picked = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, raw, quality in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            yield doc_id, 1 - quality, np.array(some_lines(doc_id, line_features(raw)[0]), np.float64).tobytes()

    got = sorted(arrow_map(picked, rows, "doc_id long, label int, features binary").collect())
    return fit_crf([np.frombuffer(r[2], np.float64).reshape(-1, len(FEATURES)) for r in got], [r[1] for r in got])


def quality(documents: DataFrame, labels: DataFrame | None, share: float = CONTENT_SHARE) -> DataFrame:
    """Base counts and the CRF's verdict of every document, in one pass without shuffle.

    A null or empty text has no words, fails the base rules and is not kept.
    Repeated rows give repeated rows; an empty table gives none. Labels that are
    null or of unknown documents are ignored, and so are further columns.
    """
    weights, steps = train(documents, labels)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for doc_id, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            yield doc_id, *judge(raw, weights, steps, share)

    return arrow_map(documents.select("doc_id", "text"), rows, T.StructType.fromDDL(BASE))


def keep_good(documents: DataFrame, labels: DataFrame | None, share: float = CONTENT_SHARE) -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns, whatever their names.

    A null or empty text goes, repeated rows are judged each, an empty table
    stays empty; labels are taken as ``quality`` takes them.
    """
    weights, steps = train(documents, labels)

    def keep(batch: pa.RecordBatch) -> list[bool]:
        return [judge(raw, weights, steps, share)[-1] for raw in text_bytes(named(batch, "text"))]

    return arrow_filter(documents, keep)
