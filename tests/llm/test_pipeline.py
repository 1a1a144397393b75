"""The pipeline against a plain version of its stages."""

from __future__ import annotations

import brute
import pytest
from test_text_ops import check_pieces

import corpus_pipeline
from tidewell.llm import decontamination, pii, quality_crf, simhash


def plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    weights, steps = quality_crf.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    docs = [r for r in docs if quality_crf.judge((r.text or "").encode(), weights, steps)[-1]]
    near = brute.components({r.doc_id: brute.simhash(r.text) for r in docs})
    docs = [r for r in docs if near[r.doc_id] == r.doc_id]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {}
    for r in docs:
        n, hit, *_ = decontamination.brute_force(r.text, items)
        if not (hit > 0 and 20 * hit >= n):
            texts[r.doc_id] = r.text
    return dict(zip(texts, map(masked, texts.values(), brute.pii_added(list(texts.values()))), strict=True))


def masked(text, added=()):
    out, at = [], 0
    for kind, a, b in sorted([*brute.pii_spans(text), *added], key=lambda s: (s[1], -s[2])):
        if a >= at:
            out.append(text[at:a] + f"[{kind.upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def test_pipeline_matches_the_plain_version(spark, sf_dir):
    want = plain(spark, sf_dir)
    check_pieces(corpus_pipeline.run(spark, sf_dir).collect(), want)


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes


AWKWARD = [None, "", " \n", "one", "two words", "x" * 4000, "a@b.cc +1 555 123 4567 10.0.0.1 " * 20, "dup line\n" * 40, "same words here again and again in one text " * 3, "é\x00\U0001f600 <|endoftext|>"]


@pytest.mark.parametrize("few", [True, False])
def test_stages_on_awkward_documents(spark, sf_dir, monkeypatch, few):
    if not few:  # the ways beyond the sizes that are broadcast
        monkeypatch.setattr(simhash, "BROADCAST", -1)
        monkeypatch.setattr(pii, "INLINE", -1)
    rows = [(i, t, "en" if i % 2 else None, None, None if t is None else len(t), "k", i) for i, t in enumerate(AWKWARD)] * 2 + [(None, "no id", "en", "s", 5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, spans int")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        got, want = {r.doc_id: r.text for r in out.collect()}, dict((r[0], r[1]) for r in rows)
        if name == "PII":
            assert got == {k: None if t is None else masked(t) for k, t in want.items()} and out.count() == len(rows)
        elif name == "SimHash near-dedup":
            near = brute.components({k: brute.simhash(t) for k, t in want.items() if k is not None})
            assert set(got) == {k for k, c in near.items() if k == c} | {None}
        else:
            assert got == want
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[0][1](spark, docs, sf_dir).dtypes == docs.dtypes
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs.dropDuplicates(["doc_id"]), sf_dir).collect()
    check_pieces(pieces, dict((r[0], r[1]) for r in rows))


def test_empty_table_through_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
