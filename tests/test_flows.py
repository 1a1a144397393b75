"""Whole flows on the smallest tables, publishing and landing."""

from __future__ import annotations

import datetime
import json
import threading
import urllib.error
import urllib.request
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewell import serving
from tidewell.operators import candidates, contracts, drift, evaluate, periods
from tidewell.plans import flows
from tidewell.sources import publish, report
from tidewell.sources.retail import ANCHOR, from_star
from tidewell.streaming.landing import land


def test_train_and_score(spark, sf_dir, tmp_path):
    r = from_star(spark, sf_dir)
    small = flows.Settings(trees=3, factors=4, iterations=2)
    trained = flows.train_flow(r, str(tmp_path / "train"), ANCHOR, small)
    best = {x["ordering"]: x["map"] for x in trained["orderings"] if x["recency_bucket"] == "all"}
    assert set(best) == {"ranker", "popularity", "pool", "oracle"} and best["oracle"] >= max(best.values()) - 1e-12
    assert all(1 <= n <= 3 for n in trained["trees"].values()) and trained["rows"]["scored"] == trained["rows"]["validation_pool"]
    with pytest.raises(RuntimeError, match="pinned"):
        flows.batch_score_flow(r, str(tmp_path / "train"), str(tmp_path / "score"), ANCHOR, "flow_store", small, "another")
    scored = flows.batch_score_flow(r, str(tmp_path / "train"), str(tmp_path / "score"), ANCHOR, "flow_store", small, trained["model_id"])
    assert flows.load_store(spark, str(tmp_path / "score"), trained["model_id"]).count() == scored["rows"]["served"]
    with pytest.raises(RuntimeError, match="pinned"):
        flows.load_store(spark, str(tmp_path / "score"), "another")
    assert scored["rows"]["served"] == scored["rows"]["top12"] == spark.table("flow_store").count()
    assert scored["rows"]["offers"] <= r.customers.count() and scored["seconds"].keys() >= scored["rows"].keys() and trained["seconds"].keys() >= trained["rows"].keys()
    als = spark.read.parquet(str(tmp_path / "train" / "validation_pool")).where("rank_als IS NOT NULL").select("customer_id", "article_id")
    assert als.join(r.tx.where(F.col("t_dat") < F.lit(ANCHOR)), ["customer_id", "article_id"], "left_semi").count() == 0


def test_drift_gate(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 97).alias("x"), F.lit("a").alias("c"), (F.col("id") % 7 / 7.0).alias(drift.PROBABILITY))
    assert flows.drift_gate(df, df, ["x", drift.PROBABILITY], ["c"], 1000)["passed"]
    with pytest.raises(ValueError, match="rows"):
        flows.drift_gate(df, df, ["x"], ["c"])
    flows.drift_gate(df, df, ["x", drift.PROBABILITY], ["c"], 1000, f"{tmp_path}/drift.html")
    assert (tmp_path / "drift.html").read_text().count("<table>") == 2


def test_reports_hold_every_cell(spark, tmp_path):
    df = spark.createDataFrame([("a|b\n<c>", 0.1234567891, None), ("", 2.0, 3)], "what string, x double, n int")
    report.save(spark, f"{tmp_path}/r.md", "All", {"One": df, "None": df.limit(0)})
    assert (tmp_path / "r.md").read_text() == "# All\n\n## One\n\n| what | x | n |\n| - | - | - |\n| a\\|b <c> | 0.123457 |  |\n|  | 2 | 3 |\n\n## None\n\n| what | x | n |\n| - | - | - |\n"
    report.save(spark, f"{tmp_path}/r.html", "A & B", {"One": df})
    text = (tmp_path / "r.html").read_text()
    assert "<title>A &amp; B</title>" in text and "&lt;c&gt;" in text and text.count("<tr>") == 3
    with pytest.raises(ValueError, match="rows"):
        report.markdown("Long", {"One": df}, 1)


def test_allocations_of_caps_as_a_report(spark, sf_dir, tmp_path):
    r = from_star(spark, sf_dir)
    frame = candidates.strategies(r.tx, r.articles, r.customers, [ANCHOR])
    pool = candidates.pooled(frame)
    flows.sweep_report({"A": pool, "B": pool.limit(0)}, periods.actual_purchases(r.tx, [ANCHOR]), evaluate.recency(r.tx, r.customers, [ANCHOR]), f"{tmp_path}/sweep.md")
    text = (tmp_path / "sweep.md").read_text()
    assert "## A\n" in text and "## B\n" in text and "recall" in text


STORE = "customer_id string, rank int, article_id string, ranker_score double, selected boolean, price decimal(6,2)"


def test_lookups_over_http(spark):
    rows = [(c, k + 1, f"a{k}", 1.0 / (k + 1), k == 11, Decimal("1.50")) for c in ("c1", "c/2 é") for k in range(12)]
    service = serving.Service(spark.createDataFrame(rows, STORE), {"model_id": "m1"})
    assert 'tidewell_requests_total{endpoint="recommend",status="404"} 0' in service.metrics.text()
    with serving.server(service, port=0) as running:
        threading.Thread(target=running.serve_forever, daemon=True).start()

        def get(path):
            try:
                with urllib.request.urlopen(f"http://127.0.0.1:{running.server_port}{path}", timeout=60) as answer:
                    return answer.status, answer.read().decode()
            except urllib.error.HTTPError as e:
                return e.code, e.read().decode()

        status, body = get("/recommend/c1?k=3")
        got = json.loads(body)
        assert status == 200 and [x["article_id"] for x in got["items"]] == ["a0", "a1", "a2"] and got["offer"]["article_id"] == "a11" and got["model_id"] == "m1"
        assert get("/recommend/c%2F2%20%C3%A9")[0] == 200 and get("/recommend/c3")[0] == 404
        assert [get(f"/recommend/c1?k={k}")[0] for k in ("0", "13", "x", "", "-1", "%C2%B2")] == [422] * 6
        assert json.loads(get("/health")[1]) == {"status": "ok", "model_id": "m1"} and get("/else")[0] == 404
        text = get("/metrics")[1]
        running.shutdown()
    assert 'tidewell_requests_total{endpoint="recommend",status="200"} 2' in text and 'tidewell_requests_total{endpoint="recommend",status="422"} 6' in text
    assert 'tidewell_request_seconds_bucket{endpoint="recommend",le="+Inf"} 9' in text and 'tidewell_request_seconds_count{endpoint="other"} 1' in text


def test_a_failing_lookup_is_an_answer(spark):
    service = serving.Service(spark.createDataFrame([("c1", 1)], "customer_id string, place int"))
    assert service.answer("/recommend/c1")[0] == 500 and 'endpoint="recommend",status="500"} 1' in service.metrics.text()


def test_publish_is_all_or_nothing(spark, tmp_path):
    one = contracts.Contract({"customer_id": contracts.Column("string", width=3, unique=True), "n": contracts.Column("int", least=0)})
    (tmp_path / "good.csv").write_text("customer_id,n\n001,1\n002,2\n")
    (tmp_path / "bad.csv").write_text("customer_id,n\n1,1\n")
    target = str(tmp_path / "out")
    with pytest.raises(ValueError, match="width"):
        publish.publish_csv(spark, {"a": (str(tmp_path / "good.csv"), one), "b": (str(tmp_path / "bad.csv"), one)}, target)
    assert not (tmp_path / "out").exists() and not (tmp_path / "out.staging").exists()
    publish.publish_csv(spark, {"a": (str(tmp_path / "good.csv"), one)}, target)
    got = publish.open_published(spark, target, "a")
    assert sorted(map(tuple, got.collect())) == [("001", 1), ("002", 2)]
    (tmp_path / "out").rename(tmp_path / "out.before")  # as if a publishing had ended between its renames
    assert publish.open_published(spark, target, "a").count() == 2
    (tmp_path / "more.csv").write_text("customer_id,n\n003,1\n")
    publish.publish_csv(spark, {"a": (str(tmp_path / "more.csv"), one)}, target)
    assert [r.customer_id for r in publish.open_published(spark, target, "a").collect()] == ["003"] and not (tmp_path / "out.before").exists()
    publish.publish_csv(spark, {"a": (str(tmp_path / "good.csv"), one)}, target)
    with pytest.raises(FileNotFoundError):
        publish.open_published(spark, target, "b")
    publish.pin(spark, f"{target}/_production.json", "m1")
    publish.require_pinned({"model_id": "m1"}, publish.read_manifest(spark, f"{target}/_production.json")["model_id"])
    got = publish.open_published(spark, target, "a")
    publish.write_manifest(spark, f"{target}/_manifest.json", {"rows": 3})
    with pytest.raises(RuntimeError, match="3"):
        publish.assert_rows_match(got, publish.read_manifest(spark, f"{target}/_manifest.json"))
    with pytest.raises(RuntimeError, match="expected"):
        publish.assert_exact(got, 2, 2)


def test_landing_repeats_safely(spark, tmp_path):
    contract = contracts.Contract({"t_dat": contracts.Column("date"), "price": contracts.Column("double", least=0)})
    spark.createDataFrame([(datetime.date(2020, 9, 1), 1.0)], "t_dat date, price double").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        query = land(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), contract)
        query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
