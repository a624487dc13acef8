"""Drift, metrics, quality, delayed evaluation, governance and lineage on hand-made rows."""

from __future__ import annotations

import random
from datetime import date

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.numeric import risk_tier
from tidemark.operators import calibration, delayed, drift, governance, labels, lineage, metrics, ordering, quality, scoring
from tidemark.params import LABEL, GuardrailPolicy, SnapshotPlan
from tidemark.plans import alerts


def psi_reference(base, cur, bins=10):
    edges = np.unique(np.quantile(base, np.linspace(0, 1, bins + 1)))
    if len(edges) < 3:
        return 0.0
    edges[0], edges[-1] = -np.inf, np.inf
    b, c = np.histogram(base, edges)[0] + 1, np.histogram(cur, edges)[0] + 1
    b, c = b / b.sum(), c / c.sum()
    return float(np.sum((c - b) * np.log(c / b)))


def sides(spark, base, cur):
    rows = [("k", "baseline", x) for x in base] + [("k", "current", x) for x in cur]
    return spark.createDataFrame(rows, "g string, side string, value double")


@pytest.mark.parametrize("shape", ["normal", "ties", "skewed", "shifted"])
def test_psi_matches_definition(spark, shape):
    rng = random.Random(shape)
    base = [rng.gauss(0, 1) if shape == "normal" else float(rng.randint(0, 6)) if shape == "ties" else rng.paretovariate(1) for _ in range(400)]
    cur = [x * 1.1 + (3 if shape == "shifted" else 0) for x in base[:250]] + [float(rng.randint(0, 9)) for _ in range(60)]
    got = drift.stability_index(sides(spark, base, cur).repartition(5), ["g"]).first().psi
    assert got == pytest.approx(psi_reference(base, cur), abs=1e-12)


def test_psi_edge_cases(spark):
    assert drift.stability_index(sides(spark, [5.0] * 9, [1.0, 9.0]), ["g"]).first().psi == 0.0
    assert drift.stability_index(sides(spark, [1.0, 2.0, 3.0], []), ["g"]).first().psi is None


def test_drift_report_separates_temporal_features(spark):
    old = {"tenure_days": [5.0, 26.0, 66.0, 201.0, 410.0, 37.0], "recency": [12.0, 7.0, 30.0, 3.0, 18.0, 51.0]}
    new = {"tenure_days": [64.0, 390.0, 512.0, 230.0, 488.0, 71.0], "recency": [3.0, 51.0, 18.0, 12.0, 7.0, 30.0]}
    base, cur = (spark.createDataFrame(list(zip(*x.values())), "tenure_days double, recency double") for x in (old, new))
    side = lambda df, s: df.withColumn("side", F.lit(s)).withColumn("pair", F.lit(1))
    report = drift.feature_drift(side(base, "baseline").unionByName(side(cur, "current")), features=["tenure_days", "recency"])
    rows = {r.feature: r for r in report.collect()}
    assert rows["tenure_days"].drift_type == "expected_temporal" and rows["recency"].drift_type == "behavioral"
    assert rows["tenure_days"].psi == pytest.approx(psi_reference(old["tenure_days"], new["tenure_days"]), abs=1e-12) and rows["recency"].psi == 0
    roll = drift.drift_rollup(report).first()
    assert roll.max_behavioral_feature_psi == 0 and roll.temporal_psi_tenure_days == roll.max_feature_psi


def test_drift_status_is_inclusive(spark):
    df = spark.createDataFrame([(0.099,), (0.10,), (0.25,), (None,)], "psi double")
    assert [r[0] for r in df.select(drift.drift_status(F.col("psi"))).collect()] == ["OK", "WARNING", "CRITICAL", "NOT_AVAILABLE"]


def test_risk_tiers(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.6,), (1.0,), (-0.01,), (1.01,), (None,)], "p double")
    assert [r[0] for r in df.select(risk_tier(F.col("p"))).collect()] == ["low", "low", "medium", "high", None, None, None]


def cohort(spark, pairs):
    rows = [(i, date(2020, 1, 1), "v", "official", float(p), 0.5, int(y)) for i, (p, y) in enumerate(pairs)]
    schema = f"CustomerID long, snapshot_date date, model_version string, prediction_role string, churn_probability double, threshold_used double, {LABEL} int"
    return spark.createDataFrame(rows, schema)


def test_delayed_metrics_golden(spark):
    got = delayed.delayed_evaluation(cohort(spark, [(0.15, 0), (0.35, 1), (0.6, 0), (0.65, 1), (0.95, 1)]), bins=2).first()
    assert got.n_resolved == 5 and got.roc_auc == pytest.approx(5 / 6) and got.accuracy == 0.6 and got.f1 == pytest.approx(2 / 3)
    # Bins of three and two: gaps 1/30 and 1/5.
    assert got.brier_score == pytest.approx(0.186) and got.ece == pytest.approx(0.1)
    assert got.mean_churn_probability == pytest.approx(0.54)


@pytest.mark.parametrize("ids", ["dense", "sparse", "text", "prefixes"])
def test_calibration_of_tied_scores(spark, ids, monkeypatch):
    """Few distinct scores: blocks of equal ones cross bin edges and are split by id, whatever the ids look like."""
    monkeypatch.setattr(ordering.text_ranks, "__defaults__", (20,))
    rng = random.Random(ids)
    name = {"dense": lambda i: i, "sparse": lambda i: i * 100_003 + 7, "text": lambda i: f"customer-{i:05d}", "prefixes": lambda i: f"{('acct', 'user-of-a-shop')[i % 2]}-{i:05d}"}[ids]
    data = [(name(i), rng.choice([0.2, 0.2, 0.2, 0.7, rng.random()]), rng.randint(0, 1)) for i in range(700)]
    df = spark.createDataFrame([("g", *x) for x in data], f"g string, CustomerID {'string' if ids in ('text', 'prefixes') else 'long'}, churn_probability double, y int")
    got = {r.risk_decile: (r.n, r.mean_predicted_probability, r.actual_churn_rate) for r in calibration.calibration_deciles(df.repartition(5), ["g"], "y").collect()}
    ranked = sorted(data, key=lambda x: (x[1], x[0]))
    edges = np.quantile(np.arange(1, 701), np.linspace(0, 1, 11)[1:-1])
    bins = {}
    for rank, (_, p, y) in enumerate(ranked, 1):
        bins.setdefault(1 + int((edges < rank).sum()), []).append((p, y))
    assert {b: v[0] for b, v in got.items()} == {b: len(v) for b, v in bins.items()}
    for b, v in bins.items():
        assert got[b][1:] == pytest.approx(tuple(np.mean(v, axis=0)))


def test_crowded_texts_are_split(spark):
    """20,000 ids with two beginnings lie in many cells, and their ranks are those of one sort."""
    name = F.when(F.col("id") % 2 == 0, F.lit("acct-")).otherwise(F.lit("user-"))
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.concat(name, F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    odd = spark.createDataFrame([("g", ""), ("g", None), ("g", "a"), ("g", "acct-"), ("g", "\u00e9\U0001f600"), ("few", "x")], "g string, c string")
    df = df.unionByName(odd)
    crowd = ordering.text_ranks(df, ["g"], "c").groupBy("g", "depth", "cell").count().agg(F.max("count")).first()[0]
    assert crowd <= ordering.TEXT_CELL
    got = ordering.text_ranks(df.repartition(4), ["g"], "c", 20).collect()
    assert len({r.cell for r in got}) > 1000
    for g in ("g", "few"):
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.rows_below)
        assert [r.rows_below for r in mine] == list(range(len(mine)))
        texts = [r.c for r in mine if r.c]
        assert texts == sorted(texts) and len(mine) - len(texts) == (2 if g == "g" else 0)


def test_drift_of_the_last_run_counts_once(spark):
    rows = [("2020-01-01", "run-1", "a", 0.9), ("2020-01-01", "run-2", "a", 0.1), ("2020-01-01", "run-2", "a", 0.1), ("2020-01-01", "run-2", "b", None), ("2020-02-01", None, "a", 0.3)]
    df = spark.createDataFrame(rows, "snapshot_date string, run_id string, feature string, psi double")
    got = alerts.latest_run(df).select("snapshot_date", "run_id", "feature", "psi").collect()
    assert sorted(map(tuple, got), key=str) == [rows[1], rows[3], rows[4]]


def test_single_class_has_no_ranking_metrics(spark):
    got = delayed.delayed_evaluation(cohort(spark, [(0.1, 1), (0.8, 1)])).first()
    assert got.roc_auc is None and got.pr_auc is None and got.recall == 0.5 and got.ece is not None


def test_ranking_metrics_brute_force(spark):
    rng = random.Random(11)
    pairs = [(rng.choice([rng.random(), 0.4, 0.4, 0.7]), rng.randint(0, 1)) for _ in range(300)]
    scores = metrics.score_table(cohort(spark, pairs).repartition(6), ["model_version"], LABEL)
    got = metrics.ranking_metrics(scores, ["model_version"]).first()
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0.0
    for t in sorted({p for p, _ in pairs}, reverse=True):
        tp, fp = sum(p >= t for p in pos), sum(p >= t for p in neg)
        ap += (tp / len(pos) - seen) * tp / (tp + fp)
        seen = tp / len(pos)
    assert got.roc_auc == pytest.approx(auc, abs=1e-12) and got.pr_auc == pytest.approx(ap, abs=1e-12)


def test_threshold_sweep_and_ties(spark):
    scores = metrics.score_table(cohort(spark, [(0.2, 0), (0.4, 1), (0.9, 1), (0.1, 0)]), ["model_version"], LABEL)
    sweep = metrics.threshold_sweep(scores, ["model_version"])
    assert sweep.count() == 19
    best = metrics.best_threshold(sweep, ["model_version"]).first()
    assert best.best_threshold == pytest.approx(0.25) and best.best_value == 1  # the lowest of several
    with pytest.raises(ValueError):
        metrics.best_threshold(sweep, ["model_version"], "accuracy")


def test_stored_class_and_lineage(spark):
    df = cohort(spark, [(0.9, 1), (0.1, 0)]).withColumn("predicted_churn", F.lit(0)).withColumn("run_id", F.col("CustomerID").cast("string"))
    got = delayed.delayed_evaluation_stored(df).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (1, 0, 1, 0)
    assert got.model_lineage == "v" and got.scoring_run_id is None and got.customers_with_positive_sale == 1


def test_repeated_keys_are_refused(spark):
    twice = cohort(spark, [(0.5, 1)]).unionByName(cohort(spark, [(0.5, 1)]))
    with pytest.raises(ValueError):
        delayed.resolved_predictions(twice.drop(LABEL), cohort(spark, [(0.5, 1)]), check=True)


def test_labels_use_future_sales_only(spark, lines):
    tx = lines(
        [("1", "A", 1, "2010-04-30 23:59", 1.0, 1), ("2", "A", -1, "2010-06-01 10:00", 1.0, 2), ("3", "A", 1, "2010-07-31 23:59", 1.0, 3),
         ("4", "A", 1, "2010-08-01 00:00", 1.0, 4)]
    )
    who = spark.createDataFrame([(date(2010, 5, 1), c) for c in (1, 2, 3, 4, 4)], "snapshot_date date, CustomerID long")
    got = {r.CustomerID: r[LABEL] for r in labels.outcome_labels(who, tx, SnapshotPlan()).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 1}


def test_label_upsert_keeps_the_last(spark):
    schema = f"snapshot_date date, CustomerID long, {LABEL} int, resolved_at string"
    d = date(2010, 5, 1)
    stored = spark.createDataFrame([(d, 1, 1, "2010-08-01"), (d, 2, 1, "2010-08-01")], schema)
    fresh = spark.createDataFrame([(d, 1, 0, "2010-08-01"), (d, 2, 0, "2010-07-01"), (d, 3, 0, "2010-08-01")], schema)
    assert {r.CustomerID: r[LABEL] for r in labels.upsert_labels(stored, fresh).collect()} == {1: 0, 2: 1, 3: 0}


def test_structural_quality(spark, lines):
    good = [("1", "A", 1, "2010-01-01 10:00", 1.0, 1), ("2", "A", 1, "2010-01-01 10:00", 1.0, None)]
    assert all(r.passed for r in quality.structural_quality(lines(good)).collect())
    copies = lines([("1", "A", 1, "2010-01-01 10:00", 1.0, 1)] * 10)
    failed = [r.check_name for r in quality.structural_quality(copies).where("not passed").collect()]
    assert failed == ["duplicate_line_rate"]
    nobody = lines([(str(i), "A", 1, "2010-01-01 10:00", 1.0, None) for i in range(5)])
    assert [r.check_name for r in quality.structural_quality(nobody).where("not passed").collect()] == ["null_customer_fraction"]
    assert [r.check_name for r in quality.structural_quality(lines([])).where("not passed").collect()] == ["empty_file"]
    short = lines(good).select("Invoice")
    with pytest.raises(ValueError, match="missing_columns"):
        quality.require_quality(quality.structural_quality(short))


def test_batch_month(lines):
    tx = lines([("1", "A", 1, "2010-01-31 23:59", 1.0, 1), ("2", "A", 1, "2010-02-01 00:00", 1.0, 1)])
    with pytest.raises(ValueError, match="1 rows"):
        quality.require_batch_month(tx, "2010-02-01")
    quality.require_batch_month(tx.limit(1), "2010-02-01")


def test_volume_check(spark, lines):
    past = lines([(f"{m}-{i}", "A", 1, f"2010-{m:02d}-05 10:00", 10.0, i) for m in range(1, 7) for i in range(10 + m % 2)])
    base = quality.monthly_baseline(quality.monthly_volume(past))
    status = lambda n: {r.metric: r.status for r in quality.volume_check(lines([(str(i), "A", 1, "2010-07-05 10:00", 10.0, i) for i in range(n)]), base).collect()}
    assert set(status(11).values()) == {"OK"}
    assert status(12)["tx_count"] == "OK" or status(12)["tx_count"] == "WARNING"
    assert set(status(100).values()) == {"ERROR"}
    flat = quality.monthly_baseline(quality.monthly_volume(past.where("month(InvoiceDate) = 1")))
    assert all(r.std is None for r in flat.collect())


def metric_pair(spark, challenger, champion):
    cols = ("roc_auc", "recall", "brier_score")
    row = {f"{s}_{c}": v for s, vs in (("challenger", challenger), ("champion", champion)) for c, v in zip(cols, vs)}
    return spark.createDataFrame([row], ", ".join(f"{k} double" for k in row))


@pytest.mark.parametrize(
    "challenger,champion,promote,failed",
    [
        ((0.752, 0.70, 0.20), (0.75, 0.80, 0.20), False, "recall"),
        ((0.755, 0.80, 0.23), (0.75, 0.80, 0.18), False, "brier_score"),
        ((0.746, 0.80, 0.18), (0.75, 0.80, 0.18), True, ""),
        ((0.70, 0.10, 0.90), (0.75, 0.80, 0.18), False, "roc_auc,recall,brier_score"),
        ((0.76, None, None), (0.75, 0.80, 0.18), True, ""),
    ],
)
def test_promotion(spark, challenger, champion, promote, failed):
    got = governance.promotion_decision(metric_pair(spark, challenger, champion), GuardrailPolicy()).first()
    assert (got.promote, got.failed_checks) == (promote, failed)
    assert got.not_evaluated == (challenger[1] is None)
    if challenger[1] is None:
        assert not got.strict_promote


def alert_run(spark, **values):
    row = dict(snapshot_date="2011-09-01", prediction_psi=0.02, max_behavioral_feature_psi=0.05, roc_auc=0.75, recall=0.84, brier_score=0.20,
               reference_roc_auc=0.75, reference_recall=0.84, reference_brier_score=0.20, model_lineage="m:1", reference_model="m:1", evaluated=True)
    row.update(values)
    kind = {str: "string", bool: "boolean"}
    return spark.createDataFrame([row], ", ".join(f"{k} {kind.get(type(v), 'double')}" if v is not None else f"{k} double" for k, v in row.items()))


def test_alerts(spark):
    rollup = lambda **v: governance.alert_rollup(governance.alert_signals(alert_run(spark, **v))).first()
    assert rollup().overall_status == "OK"
    assert rollup(prediction_psi=0.10).warning_signals == "prediction_psi"
    hot = rollup(max_behavioral_feature_psi=0.25, roc_auc=0.744)
    assert (hot.overall_status, hot.critical_signals, hot.warning_signals) == ("CRITICAL", "max_behavioral_feature_psi", "delayed_roc_auc_regression")
    other = governance.alert_signals(alert_run(spark, model_lineage="m:2", recall=0.1))
    assert {r.signal: r.status for r in other.collect()}["delayed_performance_reference"] == "NOT_COMPARABLE" and other.count() == 3
    assert governance.alert_signals(alert_run(spark, evaluated=False)).count() == 2
    assert rollup(prediction_psi=None).overall_status == "NOT_AVAILABLE"


def test_reference_metrics_prefer_the_test_cohort(spark):
    schema = "test_metrics struct<roc_auc:double,recall:double,brier_score:double>, metrics struct<roc_auc:double,recall:double,brier_score:double>"
    df = spark.createDataFrame([((0.8, None, None), (0.7, 0.7, 0.7)), ((None, None, None), (0.7, 0.7, 0.7)), (None, None)], schema)
    got = governance.resolve_reference(df).collect()
    assert [r.reference_source for r in got] == ["test_metrics", "metrics", None]
    assert [r.reference_recall for r in got] == [None, 0.7, None]


def test_behavioral_psi_fallback(spark):
    runs = spark.createDataFrame([("a", None), ("b", 0.3)], "snapshot_date string, max_behavioral_feature_psi double")
    report = spark.createDataFrame([("a", "tenure_days", 9.0), ("a", "recency", 0.2), ("b", "recency", 0.9)], "snapshot_date string, feature string, psi double")
    got = governance.behavioral_psi(runs, report, "snapshot_date")
    assert {r.snapshot_date: r.max_behavioral_feature_psi for r in got.collect()} == {"a": 0.2, "b": 0.3}


def test_shadow_comparison_takes_the_last_rows(spark):
    schema = "snapshot_date date, model_version string, prediction_role string, roc_auc double, pr_auc double, recall double, brier_score double, evaluated_at string"
    d, e = date(2020, 1, 1), date(2020, 2, 1)
    rows = [(d, "v1", None, 0.6, 0.5, 0.5, 0.2, "1"), (d, "v2", "official", 0.7, 0.5, 0.5, 0.2, "2"), (d, "v0", "shadow", 0.6, 0.4, 0.6, 0.3, "1"),
            (e, "v2", "official", 0.7, 0.5, 0.5, 0.2, "2")]
    got = delayed.shadow_comparison(spark.createDataFrame(rows, schema)).collect()
    assert [(r.official_model_version, r.shadow_model_version) for r in got] == [("v2", "v0")]
    assert got[0].roc_auc_delta_official_minus_shadow == pytest.approx(0.1)
    done = spark.createDataFrame([(d,)], "snapshot_date date")
    assert delayed.shadow_comparison(spark.createDataFrame(rows, schema), done).isEmpty()


def test_prediction_quality(spark):
    df = spark.createDataFrame(
        [(date(2020, 1, 1), 1, 0.5, 1), (date(2020, 1, 1), 1, 1.5, 1), (date(2020, 1, 1), None, 0.5, 2), (date(2020, 2, 1), 1, 0.5, 0)],
        "snapshot_date date, CustomerID long, churn_probability double, predicted_churn int",
    )
    a, b = rows_of(quality.prediction_quality(df), "snapshot_date")
    assert (a["null_ids"], a["duplicate_ids"], a["probability_out_of_range"], a["class_out_of_range"], a["passed"]) == (1, 1, 1, 1, False)
    assert b["passed"]


def test_align_features(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, b double, a double")
    assert scoring.align_features(df, ["a", "b"], ["id"]).columns == ["id", "a", "b"]
    for wrong in (["a"], ["a", "b", "c"]):
        with pytest.raises(ValueError):
            scoring.align_features(df, wrong, ["id"])
    with pytest.raises(ValueError):
        scoring.align_features(df, ["a", "b"], ["id"], exact_order=True)


def test_sample_and_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "CustomerID")
    pick = lambda d: sorted(r.CustomerID for r in scoring.reference_sample(d, 20, ["CustomerID"]).collect())
    assert pick(df.repartition(3)) == pick(df.repartition(11)) and len(pick(df)) == 20
    folds = scoring.group_folds(df.unionByName(df), 4).groupBy("CustomerID").agg(F.countDistinct("fold").alias("k"))
    assert folds.agg(F.max("k")).first()[0] == 1


def test_champion_history(spark):
    schema = "model_type string, version string, promoted_at date"
    promoted = spark.createDataFrame([("g", "v1", date(2020, 1, 1)), ("g", "v2", date(2020, 4, 1))], schema)
    when = spark.createDataFrame([(date(2019, 12, 1),), (date(2020, 3, 31),), (date(2020, 4, 1),)], "snapshot_date date")
    got = rows_of(lineage.champion_asof(when, promoted, "g"), "snapshot_date")
    assert [(r["official_version"], r["shadow_version"]) for r in got] == [("v1", None), ("v2", "v1")]


def test_latest_execution(spark):
    rows = [(date(2020, 1, 1), "20200101T1-a", 1), (date(2020, 1, 1), "20200102T1-b", 2), (date(2020, 2, 1), "20200101T1-a", 3)]
    df = spark.createDataFrame(rows, "snapshot_date date, execution_id string, CustomerID long")
    assert sorted(r.CustomerID for r in lineage.latest_execution(df).collect()) == [2, 3]


def test_maturity(spark):
    runs = spark.createDataFrame([(date(2011, m, 1),) for m in (8, 9, 10)], "as_of date")
    stored = spark.createDataFrame([(date(2011, 6, 1),)], "snapshot_date date")
    got = rows_of(delayed.matured_cohorts(runs, stored, F.lit("2011-06-01").cast("date")), "as_of")
    assert [r["reason"] for r in got] == ["not_mature", None, "no_predictions"]
