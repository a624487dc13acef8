"""The batch plans end to end on a small store with small models."""

from __future__ import annotations

import os
import random
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.params import LABEL, SnapshotPlan, SplitPlan
from tidemark.plans.alerts import evaluate_alerts
from tidemark.plans.evaluate import resolve_matured
from tidemark.plans.ingest import bootstrap_store, ingest_batch, reconstruct_history
from tidemark.plans.retrain import retrain
from tidemark.plans.score import backfill_shadow, monthly_run, monthly_score
from tidemark.plans.workspace import Workspace
from tidemark.session import shared_dir
from tidemark.sources import history

PLAN = SnapshotPlan(start=date(2009, 12, 1), feature=2, outcome=1, step=1)
SPLIT = SplitPlan(2, 1, 1)
HEAD = "Invoice,StockCode,Quantity,InvoiceDate,Price,CustomerID\n"


def month_csv(year: int, month: int, customers: int = 60) -> str:
    """Customers with an odd id buy every month, the others now and then."""
    rng = random.Random(year * 100 + month)
    rows = []
    for c in range(1, customers + 1):
        for k in range(2 if c % 2 else int(rng.random() < 0.4)):
            when = datetime(year, month, 1) + timedelta(minutes=rng.randrange(27 * 24 * 60))
            qty = -1 if rng.random() < 0.1 else rng.randint(1, 6)
            rows.append(f"{year}{month:02d}-{c}-{k},S{rng.randint(1, 9)},{qty},{when:%d-%m-%Y %H:%M},{rng.randint(100, 999) / 100},{c}.0")
    return HEAD + "\n".join(rows) + "\n"


def small_forest():
    params = {"n_estimators": 4, "max_depth": 3, "min_samples_leaf": 2}
    return models.random_forest(**params), params


def test_life_of_a_model(spark, tmp_path, monkeypatch):
    ws = Workspace(str(tmp_path / "ws"))
    months = [(2009, 12)] + [(2010, m) for m in range(1, 10)]
    for y, m in months:
        folder = tmp_path / "in" / f"{y}-{m:02d}"
        folder.mkdir(parents=True)
        (folder / f"{y}_{m:02d}.csv").write_text(month_csv(y, m))
    path = lambda y, m: str(tmp_path / "in" / f"{y}-{m:02d}")

    bootstrap_store(spark, ws, [path(*m) for m in months[:6]])
    first = retrain(spark, ws, "v1", "random_forest", date(2010, 5, 31), plan=PLAN, split=SPLIT, candidate=small_forest())
    # Coverage is the last event, so the snapshot whose outcome ends with May is not complete yet.
    assert first["reason"] == "not_enough_snapshots"
    assert ingest_batch(spark, ws, path(2010, 6), "2010-07-01")
    assert not ingest_batch(spark, ws, path(2010, 6), "2010-07-01")
    with pytest.raises(ValueError, match="outside|lie"):
        ingest_batch(spark, ws, path(2010, 7), "2010-07-01")
    assert [r.status for r in ws.manifest(spark).orderBy("recorded_at").collect()] == ["SUCCESS", "FAILED"]

    first = retrain(spark, ws, "v1", "random_forest", date(2010, 7, 1), plan=PLAN, split=SPLIT, candidate=small_forest())
    assert first["promote"] and first["reason"] == "no_champion" and 0 <= first["test"]["roc_auc"] <= 1
    again = retrain(spark, ws, "v1b", "random_forest", date(2010, 7, 1), plan=PLAN, split=SPLIT, candidate=small_forest())
    assert again["reason"] == "no_new_snapshot"

    row = monthly_score(spark, ws, "2010-07-01", "random_forest", "run-1", PLAN).first()
    assert row.model_version == "v1" and row.active_customers > 30 and row.prediction_psi is not None
    assert resolve_matured(spark, ws, "2010-07-01", PLAN) is None

    assert ingest_batch(spark, ws, path(2010, 7), "2010-08-01")
    metrics = resolve_matured(spark, ws, "2010-08-01", PLAN).collect()
    assert [(str(r.snapshot_date), r.prediction_role) for r in metrics] == [("2010-07-01", "official")]
    assert metrics[0].n_resolved == row.active_customers and metrics[0].ece is not None
    assert resolve_matured(spark, ws, "2010-08-01", PLAN) is None
    log = {(r.stage, r.status) for r in spark.read.json(ws.path("run_log")).select("stage", "status").collect()}
    assert {("retrain", "SKIPPED"), ("ingest", "FAILED")} <= log and spark.read.json(ws.path("run_log")).where("run_id = 'run-1'").count() == 1

    second = retrain(spark, ws, "v2", "random_forest", date(2010, 8, 1), plan=PLAN, split=SPLIT, candidate=small_forest())
    assert not second["retrain_skipped"] and second["champion"] is not None
    if not second["promote"]:
        from tidemark.params import GuardrailPolicy

        loose = GuardrailPolicy(max_metric_regression=1, max_recall_regression=1, max_brier_regression=1)
        second = retrain(spark, ws, "v2", "random_forest", date(2010, 8, 1), plan=PLAN, split=SPLIT, candidate=small_forest(), guardrails=loose)
    assert second["promote"]
    monthly_score(spark, ws, "2010-08-01", "random_forest", "run-2", PLAN)
    roles = {(r.prediction_role, r.model_version) for r in ws.table(spark, "predictions").where("snapshot_date = '2010-08-01'").collect()}
    assert roles == {("official", "v2"), ("shadow", "v1")}

    assert ingest_batch(spark, ws, path(2010, 8), "2010-09-01")
    # An evaluation that fails after some of its tables were written is made whole by the next one.
    with monkeypatch.context() as broken:
        broken.setattr(history, "append_history", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            resolve_matured(spark, ws, "2010-09-01", PLAN)
    both = resolve_matured(spark, ws, "2010-09-01", PLAN).collect()
    tables = ws.table(spark, "calibration").groupBy("snapshot_date", "prediction_role").agg(F.count("*").alias("n"), F.countDistinct("risk_decile").alias("bins"))
    assert {str(r.snapshot_date) for r in tables.collect()} == {"2010-07-01", "2010-08-01"} and all(r.n == r.bins for r in tables.collect())
    assert {r.prediction_role for r in both} == {"official", "shadow"}
    compared = ws.table(spark, "shadow_comparison").collect()
    assert [(r.official_model_version, r.shadow_model_version) for r in compared] == [("v2", "v1")]

    alerts = evaluate_alerts(spark, ws, "v2").collect()
    assert len(alerts) == 2 and all(a.overall_status for a in alerts)
    # A later set of a labelled date with a customer not seen before: that customer gets a label, the others keep theirs.
    labels_before = {(r.snapshot_date, r.CustomerID): r.resolved_at for r in ws.table(spark, "labels").collect()}
    set_ = ws.table(spark, "predictions").where("snapshot_date = '2010-08-01' and prediction_role = 'shadow'")
    late = set_.limit(1).withColumn("CustomerID", F.lit(9999).cast("long")).withColumn("model_version", F.lit("v0"))
    history.write_predictions(set_.withColumn("model_version", F.lit("v0")).unionByName(late), ws.path("predictions"))
    again = resolve_matured(spark, ws, "2010-09-01", PLAN).collect()
    assert [(r.model_version, r.n_resolved) for r in again] == [("v0", set_.count() + 1)]
    labels_after = {(r.snapshot_date, r.CustomerID): r.resolved_at for r in ws.table(spark, "labels").collect()}
    assert labels_after.items() > labels_before.items() and (date(2010, 8, 1), 9999) in labels_after
    # Broken prediction tables are refused and logged.
    history.write_predictions(late.withColumn("churn_probability", F.lit(1.5)).withColumn("model_version", F.lit("bad")), ws.path("predictions"))
    with pytest.raises(ValueError, match="rules"):
        resolve_matured(spark, ws, "2010-09-01", PLAN)
    assert spark.read.json(ws.path("run_log")).where("stage = 'evaluate' and status = 'FAILED'").count() == 1
    shutil.rmtree(tmp_path / "ws" / "predictions" / "snapshot_date=2010-08-01" / "prediction_role=shadow" / "model_version=bad")

    with pytest.raises(RuntimeError):
        backfill_shadow(spark, ws, "2010-07-01", "b", PLAN)  # v1 replaced nothing
    assert backfill_shadow(spark, ws, "2010-08-01", "b", PLAN, "2010-09-01").count() > 30
    assert ws.champion(spark, "random_forest", "2010-07-15").version == "v1"

    made = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    month = monthly_run(spark, ws, path(2010, 9), "2010-10-01", "random_forest", "run-3", PLAN)
    assert month["new_ingestion"] and month["prediction_sets_evaluated"] == 0 and month["active_customers"] > 30
    assert set(os.listdir(shared_dir(spark).removeprefix("file://"))) <= made  # plans delete their working tables


def test_history_from_two_feeds(spark, tmp_path):
    for y, m in ((2010, 1), (2010, 2)):
        (tmp_path / f"{m}").mkdir()
        (tmp_path / f"{m}" / "lines.csv").write_text(month_csv(y, m))
    old, new = str(tmp_path / "1"), str(tmp_path / "2")
    clean = reconstruct_history(spark, old, new, "2010-02-15")
    assert clean.agg(F.max("InvoiceDate")).first()[0] < datetime(2010, 2, 15)
    with pytest.raises(ValueError, match="overlap"):
        reconstruct_history(spark, new, old, "2010-03-01")
    with pytest.raises(ValueError, match="replay"):
        reconstruct_history(spark, old, new, "2010-02-01", whole_bootstrap=True)


@pytest.fixture(scope="module")
def panel(spark):
    rng = random.Random(4)
    rows = [(s, float(rng.randint(1, 90)), None if rng.random() < 0.2 else rng.random()) for s in (2, 3, 4) for _ in range(80)]
    df = spark.createDataFrame(rows, "snapshot_no int, recency double, gap double")
    return df.withColumn(LABEL, (F.col("recency") + F.coalesce("gap", F.lit(0.0)) * 20 > 50).cast("int")).cache()


FEATS = ["recency", "gap"]


def test_folds_only_look_back(panel):
    assert models.fold_list(panel) == [([2], [3]), ([2, 3], [4])]
    with pytest.raises(ValueError):
        models.fold_list(panel.where("snapshot_no = 2"))


def test_models_fit_and_score(spark, panel):
    gbt = models.gradient_boosting(FEATS, n_estimators=3, max_depth=2)
    folds = models.forward_validation(gbt, panel)
    assert [f["validation_snapshot"] for f in folds] == [3, 4] and models.mean_auc(folds) > 0.8
    model = models.fit(models.random_forest(FEATS, n_estimators=5, max_depth=3), panel)
    importance = models.feature_importance(model).collect()
    assert importance[0].feature == "recency" and sum(r.importance for r in importance) == pytest.approx(1)
    assert models.auc(models.fit(models.logistic_regression(FEATS), panel), panel) > 0.8
    p = models.probabilities(model, panel, ["snapshot_no"])
    assert p.where("churn_probability between 0 and 1").count() == panel.count()


def test_tuning(panel, monkeypatch):
    monkeypatch.setitem(models.BUILDERS, "random_forest", lambda **p: models.random_forest(FEATS, **p))
    model, best, table = models.tune("random_forest", panel, {"n_estimators": [2], "max_depth": [1, 3]})
    rows = table.collect()
    assert len(rows) == 2 and rows[0].cv_roc_auc >= rows[1].cv_roc_auc and best["max_depth"] in (1, 3)
    assert models.auc(model, panel) > 0.8


def test_model_round_trip(spark, panel, tmp_path):
    model = models.fit(models.random_forest(FEATS, n_estimators=2), panel)
    models.save_model(model, str(tmp_path), "v1")
    loaded = models.load_model(str(tmp_path), "v1")
    score = lambda m: sorted(r[0] for r in models.probabilities(m, panel, []).collect())
    assert score(loaded) == score(model)


def test_candidates():
    assert models.production_candidate("gradient_boosting")[1]["n_estimators"] == 200
    assert len(models.grid_points(models.GRIDS["gradient_boosting"])) == 162
    with pytest.raises(ValueError):
        models.production_candidate("svm")
