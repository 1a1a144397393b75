"""Quality rules, language model, decontamination, packing and SimHash."""

from __future__ import annotations

import itertools
import math
import random
import struct
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewell.llm import decontamination, hmm_lm, packing, quality_crf, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [None, "", " \n\t ", "one", "two words", "a b c", "A b C", "dup\ndup\nx\n\ndup", "nul\x00 byte \x1c sep nbsp", "é è ü # $ | <|im_end|> <|endoftext|>", "word " * 300, "x" * 5000, "# " * 60, "THE END!! " * 60]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return read(spark, sf_dir, "documents")


def clashing(df):
    """The frame with further columns that have names of results."""
    return df.selectExpr("*", "1 AS fp", "'k' AS kept", "2 AS n_words", "3 AS component_id", "4 AS sequence_id", "5 AS score", "6 AS spans", "7 AS __marks0")


# --- quality rules


def test_base_counts_match_brute_force(docs):
    for row in docs.collect():
        n, chars, symbols, dup, repeat, failed = brute.quality_base(row.text)
        assert quality_crf.base_counts((row.text or "").encode()) == (n, chars, symbols, dup, repeat)
        assert quality_crf.judge((row.text or "").encode(), quality_crf.PRIOR, quality_crf.PRIOR_STEPS)[5] == failed


@pytest.mark.parametrize("text", AWKWARD)
def test_base_counts_of_awkward_texts(text):
    assert (*quality_crf.base_counts((text or "").encode()),) == brute.quality_base(text)[:5]


def test_viterbi_finds_the_best_of_all_labellings():
    random.seed(3)
    for _ in range(60):
        scores = [random.uniform(-3, 3) for _ in range(random.randint(1, 7))]
        steps = tuple(random.uniform(-2, 2) for _ in range(4))

        def total(labels, scores=scores, steps=steps):
            return sum(s for s, y in zip(scores, labels, strict=True) if y) + sum(steps[2 * a + b] for a, b in itertools.pairwise(labels))

        best = max(map(total, itertools.product((0, 1), repeat=len(scores))))
        assert total(quality_crf.viterbi(scores, steps)) == pytest.approx(best)


def test_fit_raises_the_likelihood_and_separates():
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(60):
        y = k % 2
        x = np.zeros((rng.integers(1, 6), len(quality_crf.FEATURES)))
        x[:, 0] = 1
        x[:, 7] = rng.uniform(0.1, 0.4, len(x)) * y
        rows.append(x)
        labels.append(y)
    weights, steps = quality_crf.fit_crf(rows, labels, 150)
    decide = [np.mean(quality_crf.viterbi((x @ np.array(weights)).tolist(), steps)) > 0.5 for x in rows]
    assert np.mean([d == bool(y) for d, y in zip(decide, labels, strict=True)]) > 0.9


def test_one_class_leaves_the_prior():
    assert quality_crf.fit_crf([np.ones((2, len(quality_crf.FEATURES)))], [1]) == (quality_crf.PRIOR, quality_crf.PRIOR_STEPS)


def test_quality_on_labelled_documents(spark, sf_dir, docs):
    got = {r.doc_id: r for r in quality_crf.quality(docs, read(spark, sf_dir, "labels")).collect()}
    assert len(got) == docs.count()
    judged = [(got[r.doc_id].kept, r.quality) for r in read(spark, sf_dir, "labels").collect() if not got[r.doc_id].base_failed]
    assert sum(k == bool(q) for k, q in judged) >= 0.95 * len(judged)


def test_verdicts_match_a_plain_decoder(spark, sf_dir, docs):
    labels = read(spark, sf_dir, "labels")
    weights, steps = quality_crf.train(docs, labels)
    got = {r.doc_id: r.kept for r in quality_crf.quality(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {k: brute.quality_kept(t, weights, steps) for k, t in texts.items()}
    for t in AWKWARD:
        assert quality_crf.judge((t or "").encode(), weights, steps)[-1] == brute.quality_kept(t, weights, steps)


def test_contradictory_labels_are_left_out(spark):
    texts = [f"line {k} of text, as it is.\nmore of it here\n" * 20 for k in range(4)] + ["# | # | 99\n" * 70 for _ in range(4)]
    labels = spark.createDataFrame([(k, int(k < 4), 0) for k in range(8)], "doc_id long, quality int, toxic int")
    twice = labels.unionByName(labels).unionByName(spark.createDataFrame([(0, 0, 0), (7, 1, 0)], labels.schema))
    assert quality_crf.train(frame(spark, texts), twice) == quality_crf.train(frame(spark, texts), labels.where("doc_id NOT IN (0, 7)"))


def test_lines_of_the_fit_come_from_anywhere():
    lines = list(range(1000))
    starts = {quality_crf.some_lines(k, lines)[0] for k in range(300)}
    assert min(starts) < 100 and max(starts) > 800 and len(starts) > 200
    assert quality_crf.some_lines(1, lines[:64]) == lines[:64] and quality_crf.some_lines(1, []) == []


def test_quality_of_awkward_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (None, empty, odd):
        out = quality_crf.quality(clashing(frame(spark, AWKWARD)), labels).orderBy("doc_id").collect()
        assert [(r.n_words, r.base_failed) for r in out] == [(brute.quality_base(t)[0], brute.quality_base(t)[5]) for t in AWKWARD]
        assert not out[0].kept and not out[-1].kept
    kept = quality_crf.keep_good(frame(spark, AWKWARD), None)
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert quality_crf.quality(frame(spark, []), empty).count() == 0


# --- language model


def plain_forward(model, classes):
    total, a = 0.0, None
    for c in classes:
        a = (model.start if a is None else a @ model.step) * model.emit[:, c]
        total += math.log10(a.sum())
        a = a / a.sum()
    return total


def some_model(k=3, n=9, seed=0):
    rng = np.random.default_rng(seed)
    return hmm_lm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(n), k))


def test_segmented_likelihood_is_the_forward_recursion():
    rng, model = np.random.default_rng(5), some_model()
    texts = [rng.integers(0, 9, n).astype(np.int16) for n in (1, 2, 127, 128, 129, 256, 1000, 3)]
    assert hmm_lm.log_likelihood(model, texts) == pytest.approx([plain_forward(model, t) for t in texts])


def test_likelihood_sums_to_one_over_all_sequences():
    model = some_model(2, 3)
    every = [np.array(s, np.int16) for s in itertools.product(range(3), repeat=5)]
    assert (10 ** hmm_lm.log_likelihood(model, every)).sum() == pytest.approx(1)


def test_expected_counts_match_enumeration():
    model, classes = some_model(2, 4, 2), [np.array([1, 3, 0, 2, 2], np.int16), np.array([2], np.int16)]
    start, step, seen = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4))
    for text in classes:
        paths = list(itertools.product(range(2), repeat=len(text)))
        p = np.array([model.start[s[0]] * np.prod([model.step[a, b] for a, b in itertools.pairwise(s)]) * np.prod([model.emit[a, c] for a, c in zip(s, text, strict=True)]) for s in paths])
        for s, w in zip(paths, p / p.sum(), strict=True):
            start[s[0]] += w
            for a, b in itertools.pairwise(s):
                step[a, b] += w
            for a, c in zip(s, text, strict=True):
                seen[a, c] += w
    got = hmm_lm.expected_counts(model, classes)
    assert [g == pytest.approx(e) for g, e in zip(got, (start, step, seen), strict=True)] == [True] * 3


def test_segments_do_not_change_expected_counts(monkeypatch):
    rng, model = np.random.default_rng(8), some_model()
    texts = [rng.integers(0, 9, n).astype(np.int16) for n in (300, 1, 77, 128)]
    whole = hmm_lm.expected_counts(model, texts)
    monkeypatch.setattr(hmm_lm, "SEGMENT", 16)
    monkeypatch.setattr(hmm_lm, "BLOCK", 5)
    assert [a == pytest.approx(b) for a, b in zip(hmm_lm.expected_counts(model, texts), whole, strict=True)] == [True] * 3


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(4)
    texts = [(rng.integers(0, 4, 60) + 5 * (k % 2)).astype(np.int16) for k in range(20)]
    model, before = some_model(2, 10, 7), -np.inf
    for _ in range(6):
        now = hmm_lm.log_likelihood(model, texts).sum()
        assert now > before - 0.5  # the little that is added to each outcome may cost a trace
        before, model = now, hmm_lm.maximised(*hmm_lm.expected_counts(model, texts))
    assert now > hmm_lm.log_likelihood(some_model(2, 10, 7), texts).sum() + 50


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


def test_scores_match_brute_force(spark, docs):
    rows = docs.collect()
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    counts = Counter(w for r in train for w in words_of(r.text))
    total, kinds = sum(counts.values()), len(counts)
    out = {r.doc_id: r for r in hmm_lm.score(docs, head_words=500).collect()}
    assert len(out) == len(rows)
    better = []
    for r in rows:
        words, got = words_of(r.text), out[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        assert (got.held_out, got.n_tokens, got.n_known, got.train_tokens) == (r not in train, len(words), sum(w in counts for w in words), total)
        assert got.base_score == pytest.approx(base)
        if got.held_out:
            better.append(got.score - got.base_score)
    assert sum(better) > 0


def plain_score(model, counts, totals, kinds, text):
    """log10 probability of a text, word by word: forward recursion over classes times each word's share of its class."""
    total, a = 0.0, None
    for w in words_of(text):
        c = 0 if not w else zlib.crc32(w[-3:]) % 1024 + 1
        a = (model.start if a is None else a @ model.step) * model.emit[:, c] * ((counts[w] + 1) / (totals[c] + kinds[c] + 1))
        total += math.log10(a.sum())
        a = a / a.sum()
    return total


@pytest.mark.parametrize("head", [(hmm_lm.HEAD, hmm_lm.HEAD_BYTES), (100, 10**6), (10**6, 300)])
def test_model_scores_match_a_plain_recursion(spark, docs, head):
    more = frame(spark, [*AWKWARD, "x" * 90_000 + " " + "word " * 4000]).selectExpr("doc_id + 100000 AS doc_id", "text")
    every = docs.select("doc_id", "text").unionByName(more)
    learned = hmm_lm.learn(every, rounds=2, head_words=head[0], head_bytes=head[1])
    rows = every.collect()
    counts = Counter(w for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for w in words_of(r.text))
    totals, kinds = np.zeros(1025), np.zeros(1025)
    for w, c in counts.items():
        totals[0 if not w else zlib.crc32(w[-3:]) % 1024 + 1] += c
        kinds[0 if not w else zlib.crc32(w[-3:]) % 1024 + 1] += 1
    assert (learned.totals == totals).all() and (learned.kinds == kinds).all()
    got = {r.doc_id: r.score for r in hmm_lm.score(every, rounds=2, head_words=head[0], head_bytes=head[1]).collect()}
    for r in rows:
        assert got[r.doc_id] == pytest.approx(plain_score(learned.model, counts, totals, kinds, r.text), rel=1e-9, abs=1e-9)


def test_the_head_is_bounded_in_bytes(spark):
    words = [(f"{k}".encode() * 30, 1, 100) for k in range(50)] + [(b"y" * 10_000, 1, 10**6)]
    counts = spark.createDataFrame(words, "word binary, cls int, c long")
    assert hmm_lm.frequent(counts, 1000, 10**6).agg({"word": "count"}).first()[0] == 50
    assert hmm_lm.frequent(counts, 1000, 100).count() == 0 == hmm_lm.frequent(counts, 10).count()


def test_scores_of_awkward_tables(spark):
    out = hmm_lm.score(clashing(frame(spark, AWKWARD * 2)), rounds=1).collect()
    assert len(out) == 2 * len(AWKWARD)
    assert all(math.isfinite(r.score) and r.score <= 0 and r.n_tokens >= 1 for r in out)
    assert hmm_lm.score(frame(spark, []), rounds=1).count() == 0
    alone = next(i for i in range(99) if hmm_lm.is_held_out(i))
    only = spark.createDataFrame([(alone, "no training here"), (None, None)], "doc_id long, text string").limit(1)
    got = hmm_lm.score(only, rounds=1).first()
    assert (got.held_out, got.train_tokens, got.n_known, got.base_score) == (True, 0, 0, 0.0)


# --- decontamination


def test_decontamination_matches_brute_force(spark, sf_dir, docs):
    bench = read(spark, sf_dir, "benchmark")
    items = [(str(r.item_id), r.text) for r in bench.collect()]
    for windows in (decontamination.WINDOWS, 300, 40):
        got = {r.doc_id: r for r in decontamination.digest(decontamination.find_contamination(docs, bench, windows=windows)).collect()}
        stay = {r.doc_id for r in decontamination.remove_contaminated(clashing(docs), bench, windows=windows).collect()}
        assert stay == {k for k, r in got.items() if not r.contaminated}
        for r in docs.collect():
            n, hit, names, sha = decontamination.brute_force(r.text, items)
            g = got[r.doc_id]
            assert (g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) == (n, hit, len(names), sha, hit > 0 and 20 * hit >= n)


def test_random_words_match_brute_force():
    random.seed(11)
    for size in (13, 7, 3, 1):
        for _ in range(60):
            pick = lambda n, words: " ".join(random.choice(words) for _ in range(n))
            few = ["a", "b"] if random.random() < 0.5 else list("abcdefgh")
            items = [(str(k), pick(random.randrange(40), few)) for k in range(6)]
            parts = [random.choice(items)[1][random.randrange(30) :] if random.random() < 0.6 else pick(random.randrange(20), few) for _ in range(6)]
            text = " x ".join(parts)
            block = [(name, b" ".join(decontamination.words_of(t))) for name, t in items if decontamination.words_of(t)]
            words = decontamination.words_of(text)
            runs, names = decontamination.Windows(block, size).scan(words)
            hit = sum(b - a for a, b in decontamination.union(runs))
            assert (len(words), hit, sorted(names)) == decontamination.brute_force(text, items, size)[:3]


def test_long_items_in_parts(spark):
    random.seed(4)
    item = [f"w{random.randrange(30)}" for _ in range(500)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for windows in (1, 7, 100):
        parts = [text.decode().split() for block in decontamination.blocks(bench, 13, windows) for _, text in block]
        got = [tuple(p[i : i + 13]) for p in parts for i in range(len(p) - 12)]
        assert got == [tuple(item[i : i + 13]) for i in range(488)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(decontamination, "BENCHMARK_BYTES", 10)
        with pytest.raises(ValueError, match="bytes of text"):
            decontamination.find_contamination(bench.selectExpr("item_id AS doc_id", "text"), bench)


def test_many_words_and_items_that_share_windows():
    block = [(str(k), f"which of the following is the best answer to question {k} of this set please".encode()) for k in range(4000)]
    block += [("big", b" ".join(b"v%d" % k for k in range(70_000)))]
    built = decontamination.Windows(block, 7)
    runs, names = built.scan(b"which of the following is the best answer to question".split() * 200)
    assert len(names) == 4000 and sum(b - a for a, b in decontamination.union(runs)) == 2000
    assert built.scan([b"v%d" % k for k in range(60_000, 60_020)]) == ([[0, 20]], {"big"})


def test_spans_point_into_the_original(spark):
    item = "What's the CAPITAL of France, and why is it not Lyon or any other?"
    text = "Ünten!  what S the--capital of\nfrance and why is it not lyon OR any other... bye"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = decontamination.find_contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert [text.encode()[a:b].decode() for a, b in row.spans] == ["what S the--capital of\nfrance and why is it not lyon OR any other"]


def test_decontamination_of_awkward_tables(spark):
    bench = spark.createDataFrame([(1, "b C"), (2, None), (3, "..."), (None, "two words"), (1, "one"), (10, "one")], "item_id long, text string")
    items = [("1", "b C"), ("2", None), ("3", "..."), (None, "two words"), ("1", "one"), ("10", "one")]
    out = decontamination.find_contamination(clashing(frame(spark, AWKWARD)), bench).orderBy("doc_id").collect()
    for t, r in zip(AWKWARD, out, strict=True):
        assert (r.n_words, r.n_hit, list(r["items"])) == decontamination.brute_force(t, items)[:3]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_contamination(frame(spark, AWKWARD), none).where("n_hit > 0").count() == 0
    assert decontamination.remove_contaminated(frame(spark, AWKWARD), none).count() == len(AWKWARD)
    assert decontamination.find_contamination(frame(spark, []), bench).count() == 0


# --- packing


def test_binary_lengths():
    assert packing.binary_lengths(2048 * 2 + 13) == [2048, 2048, 8, 4, 1]
    for n in range(1, 5000, 7):
        lengths = packing.binary_lengths(n)
        assert sum(lengths) == n and all(x & (x - 1) == 0 for x in lengths)


def paths():
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_pieces(rows, texts):
    """Pieces of each text have its ids, in order and whole; returns the sequences."""
    exact = Tokenizer.from_file(paths()[0])
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(texts)
    for k, text in texts.items():
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.offset) == (at, len(ids), 0)
            assert r.length & (r.length - 1) == 0 and r.length <= 2048
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_packing_matches_the_tokenizer(docs):
    rows = docs.collect()
    check_pieces(packing.digest(packing.pack(docs, *paths())).collect(), {r.doc_id: r.text for r in rows})
    some = docs.limit(30)
    assert sorted(packing.digest(packing.pack(some.coalesce(1), paths()[0])).drop("sequence_id").collect()) == sorted(packing.digest(packing.pack(some.coalesce(1), *paths())).drop("sequence_id").collect())


def test_packing_of_awkward_tables(spark, tmp_path):
    texts = [*AWKWARD, "A long text, " * 90_000]
    pieces = packing.pack(clashing(frame(spark, texts)), *paths())
    check_pieces(packing.digest(pieces).collect(), dict(enumerate(texts)))
    assert packing.pack(frame(spark, []), *paths()).count() == 0
    packing.write_buckets(pieces.where("doc_id < 6"), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == pieces.where("doc_id < 6").count()


# --- SimHash


def test_fingerprints_match_brute_force(docs):
    for r in docs.limit(60).collect():
        assert simhash.fingerprint((r.text or "").encode()) == brute.simhash(r.text)
    for t in AWKWARD:
        assert simhash.fingerprint((t or "").encode()) == brute.simhash(t)


def test_components_match_all_pairs(spark, docs):
    got = simhash.digest(simhash.near_duplicates(docs)).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got}
    assert {r.doc_id: r.component_id for r in got} == brute.components(prints)


def test_bk_tree_takes_each_value_once():
    random.seed(2)
    values = [random.getrandbits(64) for _ in range(50)]
    values += [v ^ 1 << random.randrange(64) ^ 1 << random.randrange(64) for v in values]
    tree = simhash.BKTree()
    added = [v for v in values if tree.add(v)]
    assert sorted(tree.take(values[0], 2)) == sorted(v for v in set(values) if (v ^ values[0]).bit_count() <= 2)
    assert tree.take(values[0], 2) == []
    rest = [x for v in added for x in tree.take(v, 0)]
    assert len(rest) + sum((v ^ values[0]).bit_count() <= 2 for v in set(values)) == len(added)


@pytest.mark.parametrize("shard", [simhash.SHARD, 3])
def test_links_of_chains_and_dense_groups(spark, shard):
    random.seed(9)
    prints = {}
    for group in range(6):
        at = random.getrandbits(64)
        for _ in range(40):  # a chain that wanders, with near copies on the way
            at ^= 1 << random.randrange(64)
            if random.random() < 0.5:
                at ^= 1 << random.randrange(64)
            prints[len(prints)] = at
    dense = random.getrandbits(64)
    for k in range(30):
        prints[len(prints)] = dense ^ 1 << k
    nodes = spark.createDataFrame([(simhash.signed(v),) for v in set(prints.values())], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(nodes, shard)).collect()}
    want = brute.components(prints)
    name = {i: roots.get(simhash.signed(v), simhash.signed(v)) for i, v in prints.items()}
    for a, b in itertools.combinations(prints, 2):
        assert (name[a] == name[b]) == (want[a] == want[b])


def test_simhash_of_awkward_tables(spark):
    texts = AWKWARD * 2
    got = simhash.near_duplicates(clashing(frame(spark, texts))).collect()
    want = brute.components({i: brute.simhash(t) for i, t in enumerate(texts)})
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(frame(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    again = spark.createDataFrame([(1, "same row"), (1, "same row"), (None, "same row")], "doc_id long, text string")
    assert [(r.doc_id, r.component_id) for r in simhash.near_duplicates(again).orderBy("doc_id").collect()] == [(None, 1), (1, 1), (1, 1)]


@pytest.mark.parametrize("broadcast", [simhash.BROADCAST, -1])
def test_one_row_of_each_component_stays(spark, monkeypatch, broadcast):
    monkeypatch.setattr(simhash, "BROADCAST", broadcast)
    one, two, three, four = (" ".join(f"{w}{k}" for k in range(30)) for w in ("ant", "bee", "cat", "dog"))
    rows = [(3, one, "c"), (5, one, "c"), (5, two, "b"), (7, two, "a"), (None, three, "b"), (None, three, "a"), (9, four, "b"), (9, four, "a"), (None, four, "0"), (8, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = "__row __id __text __doc __hash __stays __n stays best n fp".split()
    kept = simhash.keep_one(docs.selectExpr("*", *[f"{k} AS `{c}`" for k, c in enumerate(names)]))
    assert kept.columns == [*docs.columns, *names]
    kept = kept.select(*docs.columns)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, one, "c"), (5, two, "b"), (None, three, "a"), (9, four, "a"), (8, None, "x")], key=str)
