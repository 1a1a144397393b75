"""Whole flows: training from tables to metrics, and scoring from a date to the served store.

Stages are tables below one folder; each is written once and read by the next,
so a flow can be resumed at a stage and survives lost executors.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import GBTRegressionModel, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import als, calibrate, candidates, drift, evaluate, features, models, offers, periods, store
from tidewell.sources import report
from tidewell.sources.publish import assert_exact, read_manifest, require_pinned, write_manifest
from tidewell.sources.retail import Retail
from tidewell.sources.shared import written


@dataclass(frozen=True)
class Settings:
    """Sizes of the models and the decision's constants."""

    trees: int = models.MAX_TREES
    factors: int = als.FACTORS
    iterations: int = als.ITERATIONS
    margin: float = offers.MARGIN
    cost_multiplier: float = offers.COST_MULTIPLIER


class Folder:
    """Stage tables of a flow, and the wall time of each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.seconds: dict[str, float] = {}

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        began = time.monotonic()
        build().write.mode("overwrite").parquet(f"{self.path}/{name}")
        self.seconds[name] = round(time.monotonic() - began, 3)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def pool(r: Retail, starts: list[datetime.date], settings: Settings) -> DataFrame:
    """The pool of all windows with the collaborative strategy, whose model is fitted before each window."""
    also = None
    for s in starts:
        got = als.recommend(als.fit(r.tx, s, settings.factors, settings.iterations), s)
        also = got if also is None else also.unionByName(got)
    frames = candidates.strategies(r.tx, r.articles, r.customers, starts, als=also)
    return candidates.require_candidates(candidates.pooled(frames), r.customers, starts)


def _metrics(df: DataFrame) -> list[dict]:
    """A few rows of a report as plain values."""
    return [{k: str(v) if isinstance(v, datetime.date) else v for k, v in row.asDict().items()} for row in df.collect()]


def train_flow(r: Retail, path: str, anchor: datetime.date, settings: Settings = Settings()) -> dict:  # noqa: B008
    """Candidates, features, labels, both models, calibration and evaluation; returns the manifest."""
    spark = r.tx.sparkSession
    folder, train, week = Folder(spark, path), periods.train_starts(anchor), [anchor]
    train_pool = folder.stage("train_pool", lambda: pool(r, train, settings))
    valid_pool = folder.stage("validation_pool", lambda: pool(r, week, settings))
    labelled = folder.stage("labelled", lambda: periods.training_labels(train_pool, periods.actual_purchases(r.tx, train)))
    matrix = folder.stage("matrix", lambda: features.training_matrix(labelled, r.tx, r.articles, r.customers, r.vectors, train))
    valid = folder.stage("validation_features", lambda: features.build(valid_pool, r.tx, r.articles, r.customers, r.vectors, week))
    ranker, classifier = models.train_ranker(matrix, settings.trees), models.train(matrix, settings.trees)
    ranker.model.write().overwrite().save(f"{folder.path}/ranker")
    classifier.model.write().overwrite().save(f"{folder.path}/classifier")
    classifier.mapping.write.mode("overwrite").parquet(f"{folder.path}/mapping")
    actual = folder.stage("actual", lambda: periods.actual_purchases(r.tx, week))
    scored = folder.stage("scored", lambda: models.scored_by({"ranker_score": ranker, "raw_prob": classifier}, valid).join(actual.withColumn("h", F.lit(1)), [*candidates.KEYS, "article_id"], "left").withColumn("label", F.coalesce("h", F.lit(0))).drop("h").withColumn("bucket", calibrate.customer_bucket()))
    fit, held = scored.where(calibrate.in_fit(F.col("bucket"))), scored.where(calibrate.in_eval(F.col("bucket")))
    if fit.select("customer_id").intersect(held.select("customer_id")).head(1):
        raise RuntimeError("a customer is in the fit and the evaluation part")
    calibrator = calibrate.fit_calibrator(fit)
    calibrator.write().overwrite().save(f"{folder.path}/calibrator")
    judged = calibrate.apply_calibrator(calibrator, held)
    buckets = evaluate.recency(r.tx, r.customers, week)
    ranked = evaluate.score_order(scored)
    top = candidates.recent_top(r.tx, week)
    named = {
        "ranker": evaluate.ap_per_customer(ranked, actual),
        "popularity": evaluate.ap_per_customer(evaluate.popularity_order(top, actual), actual),
        "pool": evaluate.ap_per_customer(evaluate.pool_order(valid_pool), actual),
        "oracle": evaluate.oracle_ap(valid_pool, actual),
    }
    manifest = {
        "anchor": str(anchor), "model_id": uuid.uuid4().hex, "trees": {"ranker": ranker.model.getNumTrees, "classifier": classifier.model.getNumTrees}, "rows": {n: folder.read(n).count() for n in ("train_pool", "validation_pool", "matrix", "scored")},
        "recall": _metrics(evaluate.recall_report(valid_pool, actual, buckets)), "orderings": _metrics(evaluate.orderings(named, buckets)),
        "brier": {"raw": _metrics(calibrate.brier_table(judged, "raw_prob")), "calibrated": _metrics(calibrate.brier_table(judged))}, "seconds": folder.seconds,
    }
    write_manifest(spark, f"{folder.path}/_manifest.json", manifest)
    return manifest


def batch_score_flow(r: Retail, model_path: str, path: str, date: datetime.date, table: str | None = None, settings: Settings = Settings(), pinned: str | None = None, known: DataFrame | None = None) -> dict:  # noqa: B008
    """Candidates and features of a date, the trained models' scores, the decision and the store; returns the manifest.

    With ``pinned`` any other model is refused. ``known`` has raw probabilities
    of an earlier run of the same model; only pairs that it lacks are scored.
    """
    spark = r.tx.sparkSession
    folder, week = Folder(spark, path), [date]
    of_model = read_manifest(spark, f"{model_path}/_manifest.json")
    require_pinned(of_model, pinned)
    mapping = spark.read.parquet(f"{model_path}/mapping")
    ranker = models.Trained(GBTRegressionModel.load(f"{model_path}/ranker"), mapping, [])
    classifier = models.Trained(GBTClassificationModel.load(f"{model_path}/classifier"), mapping, [])
    calibrator = IsotonicRegressionModel.load(f"{model_path}/calibrator")
    now = folder.stage("pool", lambda: pool(r, week, settings))
    wide = folder.stage("features", lambda: features.build(now, r.tx, r.articles, r.customers, r.vectors, week))
    best = folder.stage("best", lambda: models.top12(ranker, wide))
    key = [*candidates.KEYS, "article_id"]
    asked = wide.join(best.select(*key), key, "left_semi")  # probabilities are for the twelve alone
    raw = folder.stage("raw", lambda: models.scored(classifier, asked) if known is None else models.scored_missing(classifier, asked, known))
    top = folder.stage("top12", lambda: calibrate.apply_calibrator(calibrator, best.join(raw.select(*key, "raw_prob"), key)))
    prices = folder.stage("prices", lambda: offers.trailing_price(r.tx, date))
    cost = offers.contact_cost(prices, settings.cost_multiplier)
    marked = offers.with_eligibility(top, offers.recently_sold(r.tx, date), offers.recently_bought(r.tx, date))
    valued = offers.with_cost(marked.join(prices, "article_id", "left"), cost).withColumn("expected_value", offers.expected_value(settings.margin)).withColumn("bucket", calibrate.customer_bucket())
    selected = folder.stage("offers", lambda: offers.select_offers(valued))
    if store.unmatched_provenance(top, now).head(1):
        raise RuntimeError("a served pair isn't in the pool")
    served = folder.stage("served", lambda: store.served(marked, now, prices, selected))
    n = r.customers.select("customer_id").distinct().count()
    if served.groupBy("customer_id").count().where("count = 12").count() == n:
        assert_exact(served, n)
    if table:
        store.save(served, table)
    manifest = {"date": str(date), "model": of_model["anchor"], "model_id": of_model["model_id"], "rows": {x: folder.read(x).count() for x in ("pool", "top12", "offers", "served")}, "coverage": _metrics(offers.coverage(selected, r.customers)), "seconds": folder.seconds}
    write_manifest(spark, f"{folder.path}/_manifest.json", manifest)
    return manifest


def load_store(spark: SparkSession, path: str, pinned: str | None = None) -> DataFrame:
    """The served rows of a scoring flow; refused if another model than the pinned one scored them."""
    require_pinned(read_manifest(spark, f"{path.rstrip('/')}/_manifest.json"), pinned)
    return Folder(spark, path).read("served")


def drift_gate(reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str], least: int = drift.LEAST_ROWS, report_path: str | None = None) -> dict:
    """The verdict on two samples; only a matched comparison should gate. ``report_path`` gets both tables as Markdown or HTML."""
    table = written(drift.psi(reference, current, numeric, categorical), "psi")  # read for the verdict and the report
    decided = drift.decide(table, reference.count(), current.count(), least)
    if report_path:
        report.save(reference.sparkSession, report_path, "Drift", {"Verdict": decided, "Columns": table})
    return decided.first().asDict()


def sweep_report(pools: dict[str, DataFrame], actual: DataFrame, buckets: DataFrame, path: str) -> None:
    """Recall of the pool of each allocation of caps, one table each, as Markdown or HTML."""
    report.save(actual.sparkSession, path, "Allocations of caps", {name: evaluate.recall_report(pool, actual, buckets) for name, pool in pools.items()})
