"""Every registered query with SQL against DuckDB, and plans that must hold at scale."""

from __future__ import annotations

import math

import duckdb
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

import __spark_entry__
from tidewell.operators import candidates, features, models

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(rows, names):
    place = sorted(range(len(names)), key=lambda k: names[k])
    value = lambda x: None if x is None or isinstance(x, float) and math.isnan(x) else round(float(x), 6) + 0.0 if isinstance(x, int | float) and not isinstance(x, bool) else str(x)
    return sorted([tuple(value(r[k]) for k in place) for r in rows], key=str)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = __spark_entry__.queries()[name](spark, sf_dir)
    cursor = con.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(cursor.fetchall(), names)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf_dir):
    queries = __spark_entry__.queries()
    assert "WindowGroupLimit" in plan_of(queries["c_repurchase"](spark, sf_dir))
    for name in ("c_pool", "f_customer", "f_pair", "n_offers_surrogate", "e_recall_report"):
        plan = plan_of(queries[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "Python" not in plan, name
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in plan_of(queries["c_recent_top"](spark, sf_dir))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


class Asked(Exception):
    """Raised in a fit's place, with the sizes it was asked for."""


@pytest.mark.parametrize("name, rank, rounds", [("c_als", 64, 15), ("c_pool_with_als", 64, 15)])
def test_als_queries_fit_the_full_model(spark, sf_dir, monkeypatch, name, rank, rounds):
    def fit(self, *_):
        raise Asked(self.getRank(), self.getMaxIter())

    monkeypatch.setattr(ALS, "fit", fit)
    with pytest.raises(Asked) as asked:
        __spark_entry__.queries()[name](spark, sf_dir)
    assert asked.value.args == (rank, rounds)


@pytest.mark.parametrize("name", ["f_backtest", "m_top12"])
def test_feature_queries_deal_no_popularity_rows(spark, sf_dir, monkeypatch, name):
    def build(*_):
        raise Asked("features")

    monkeypatch.setattr(candidates, "pooled", None)  # dealing all strategies' rows would fail
    monkeypatch.setattr(models, "train_ranker", lambda *_: None)
    monkeypatch.setattr(features, "training_matrix", lambda *_: None)
    monkeypatch.setattr(features, "build", build)
    with pytest.raises(Asked):
        __spark_entry__.queries()[name](spark, sf_dir)


@pytest.mark.parametrize("name, trees, probes", [("m_train", 500, True), ("m_top12", 500, True), ("x_importances", 500, True), ("m_train_backtest", 212, False)])
def test_ranker_queries_train_the_full_model(spark, sf_dir, monkeypatch, name, trees, probes):
    """The first fit is the probe, judged on the last window; the backtest has no probe."""

    def boosted(train, most, seed, judge=None, patience=models.PATIENCE):
        raise Asked(most, judge is not None and train.agg(F.max("window_start")).first()[0] < judge.agg(F.min("window_start")).first()[0])

    monkeypatch.setattr(models, "_boosted", boosted)
    with pytest.raises(Asked) as asked:
        __spark_entry__.queries()[name](spark, sf_dir)
    assert asked.value.args == (trees, probes) and models.PATIENCE == 50


def test_the_classifier_of_m_train_is_the_full_model(spark, sf_dir, monkeypatch):
    """The first fit is the probe, without the last window."""
    real = models.train

    def train(matrix, *args, **more):
        last.append(matrix.agg(F.max("window_start")).first()[0])
        return real(matrix, *args, **more)

    def fit(self, df, *_):
        raise Asked(self.getMaxIter(), df.agg(F.max("window_start")).first()[0] < last[0])

    last = []
    monkeypatch.setattr(models, "train_ranker", lambda matrix: None)
    monkeypatch.setattr(models, "train", train)
    monkeypatch.setattr(GBTClassifier, "fit", fit)
    with pytest.raises(Asked) as asked:
        __spark_entry__.queries()["m_train"](spark, sf_dir)
    assert asked.value.args == (500, True)
