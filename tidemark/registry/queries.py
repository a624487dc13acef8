"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.numeric import risk_tier
from tidemark.functions.temporal import day_of, moment, month_start
from tidemark.operators import calendar as cal
from tidemark.operators import calibration, delayed, drift, features, governance, labels, lineage, metrics, models, quality, scoring
from tidemark.params import LABEL, SplitPlan
from tidemark.registry import frames as fr
from tidemark.session import scratch, shared_dir, written
from tidemark.sources import history, store as curated, transactions
from tidemark.streaming import ingest as streaming
from tidemark.sources.adapters import EVENT_PLAN, ORDER_PLAN, event_lines, order_lines, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LINE = ("Invoice", "StockCode", "Quantity", "InvoiceDate", "Price", "CustomerID")
SPLIT = SplitPlan()
COHORT = delayed.COHORT


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf: fr.portable(fn(spark, sf))
    return fn


def day(text: str):
    return F.lit(text).cast("date")


# --- sources and cleaning -------------------------------------------------------------------------


@query
def scan_transactions(spark, sf):
    return order_lines(spark, sf)


@query
def clean_transactions(spark, sf):
    return transactions.clean_transactions(fr.raw_feed(spark, sf))


@query
def curate_union_dedup(spark, sf):
    tx = order_lines(spark, sf)
    d = F.col("InvoiceDate")
    return transactions.curate(tx.where(d < moment("2001-05-01")), tx.where(d >= moment("2001-02-01")))


@query
def point_in_time_union(spark, sf):
    tx = order_lines(spark, sf)
    d, cut = F.col("InvoiceDate"), moment("1998-01-01")
    return transactions.point_in_time_union(tx.where(d < cut), tx.where(d >= cut), moment("2001-05-01"))


@query
def feed_overlap(spark, sf):
    tx = order_lines(spark, sf)
    d = F.col("InvoiceDate")
    return transactions.feed_overlap(tx.where(d < moment("1998-01-02")), tx.where(d >= moment("1998-01-01")))


@query
def history_schema_evolution(spark, sf):
    m = quality.monthly_volume(order_lines(spark, sf)).withColumnRenamed("month", "snapshot_date")
    cut = day("1998-05-01")
    old = m.where(F.col("snapshot_date") < cut).select("snapshot_date", "tx_count", "revenue")
    return history.evolve(old, m.where(F.col("snapshot_date") >= cut))


@query
def label_upsert(spark, sf):
    from dataclasses import replace

    tx, short = order_lines(spark, sf), replace(ORDER_PLAN, outcome=1)
    cohort = fr.predictions(spark, sf).where(F.col("prediction_role") == "official")
    early = cal.labelled_calendar(fr.order_coverage(spark, sf), short).select(
        day_of(F.col("feature_end")).alias("snapshot_date"), "outcome_start", "outcome_end"
    )
    keep = lambda w: cohort.join(F.broadcast(w.select("snapshot_date")), "snapshot_date", "left_semi")
    final = fr.labelled_windows(spark, sf)
    stored = labels.outcome_labels(keep(early), tx, short, early, "2001-01-01T00:00:00Z")
    incoming = labels.outcome_labels(keep(final), tx, ORDER_PLAN, final, "2001-09-01T00:00:00Z")
    return labels.upsert_labels(stored, incoming).drop("outcome_start")


@query
def reference_sample(spark, sf):
    rows = fr.cohort_scores(order_lines(spark, sf), fr.labelled(spark, sf))
    return scoring.reference_sample(rows, 2000, ["snapshot_date", "CustomerID"]).select(
        "snapshot_date", "CustomerID", "churn_probability"
    )


# --- quality ----------------------------------------------------------------------------------------


@query
def structural_quality(spark, sf):
    return quality.structural_quality(fr.raw_feed(spark, sf))


@query
def batch_bounds_violations(spark, sf):
    return quality.batch_bounds_violations(order_lines(spark, sf), day("2001-08-01"))


@query
def monthly_volume(spark, sf):
    return quality.monthly_volume(order_lines(spark, sf))


@query
def monthly_baseline(spark, sf):
    return quality.monthly_baseline(quality.monthly_volume(order_lines(spark, sf)))


@query
def volume_anomalies(spark, sf):
    return quality.volume_anomalies(quality.monthly_volume(order_lines(spark, sf)))


@query
def volume_check(spark, sf):
    tx, d = order_lines(spark, sf), F.col("InvoiceDate")
    before = quality.monthly_baseline(quality.monthly_volume(tx.where(d < moment("2001-07-01"))))
    return quality.volume_check(tx.where(d >= moment("2001-07-01")), before)


@query
def prediction_quality(spark, sf):
    p = fr.predictions(spark, sf)
    worse = F.when(F.col("prediction_role") == "shadow", F.col("churn_probability") * 1.5).otherwise(F.col("churn_probability"))
    return quality.prediction_quality(p.withColumn("churn_probability", worse))


# --- calendars ----------------------------------------------------------------------------------------


@query
def snapshot_calendar(spark, sf):
    return fr.scorable(spark, sf)


@query
def event_calendar(spark, sf):
    return fr.event_labelled(spark, sf)


@query
def available_snapshots(spark, sf):
    return cal.available_snapshots(cal.coverage_of(order_lines(spark, sf)), ORDER_PLAN)


@query
def step_recommendation(spark, sf):
    return cal.step_recommendation(cal.coverage_of(order_lines(spark, sf)), ORDER_PLAN, 10)


@query
def rolling_split(spark, sf):
    return cal.rolling_split(cal.labelled_calendar(cal.coverage_of(order_lines(spark, sf)), ORDER_PLAN), SPLIT)


@query
def fixed_split(spark, sf):
    return cal.fixed_split(cal.labelled_calendar(cal.coverage_of(order_lines(spark, sf)), ORDER_PLAN), SplitPlan(3, 2, 1))


@query
def forward_folds(spark, sf):
    return cal.forward_folds(cal.labelled_calendar(cal.coverage_of(order_lines(spark, sf)), ORDER_PLAN))


@query
def cadence_gates(spark, sf):
    return cal.cadence_gates(fr.month_starts(spark, sf), day("1998-06-01"), day("1998-09-01"))


@query
def retrain_readiness(spark, sf):
    """Readiness in every month with orders, with the champion of half a year before."""
    months = order_lines(spark, sf).select(month_start(F.col("InvoiceDate")).cast("timestamp_ntz").alias("coverage_end")).distinct()
    status = cal.available_snapshots(months, ORDER_PLAN)
    champion = F.when(F.col("available") > 4, F.col("available") - F.when(F.month("coverage_end") % 2 == 0, 1).otherwise(0))
    return cal.retrain_readiness(status.withColumn("champion_latest_snapshot", champion), SPLIT)


# --- features -------------------------------------------------------------------------------------------


@query
def snapshot_membership(spark, sf):
    rows = features.snapshot_membership(order_lines(spark, sf), fr.labelled(spark, sf))
    return rows.select("snapshot_no", "role", "Invoice", "StockCode", "Quantity", "InvoiceDate", "CustomerID")


@query
def feature_outcome_split(spark, sf):
    feature, outcome = features.feature_outcome_split(order_lines(spark, sf), fr.labelled(spark, sf))
    out = feature.withColumn("role", F.lit("feature")).unionByName(outcome.withColumn("role", F.lit("outcome")))
    return out.groupBy("snapshot_no", "role", "CustomerID").agg(F.count("*").alias("lines"), F.sum("Quantity").alias("quantity"))


@query
def rfm_features(spark, sf):
    return features.rfm_features(order_lines(spark, sf), fr.labelled(spark, sf))


@query
def purchase_gaps(spark, sf):
    return features.purchase_gaps(order_lines(spark, sf), fr.labelled(spark, sf))


@query
def tenure_days(spark, sf):
    return features.tenure_days(order_lines(spark, sf), fr.labelled(spark, sf))


@query
def momentum_features(spark, sf):
    return features.momentum_features(order_lines(spark, sf), fr.labelled(spark, sf))


@query
def customer_features(spark, sf):
    return features.customer_features(order_lines(spark, sf), fr.scorable(spark, sf))


@query
def training_dataset(spark, sf):
    return features.training_dataset(order_lines(spark, sf), fr.labelled(spark, sf))


@query
def event_training_dataset(spark, sf):
    return features.training_dataset(event_lines(spark, sf), fr.event_labelled(spark, sf))


@query
def scoring_dataset(spark, sf):
    calendar = cal.scoring_calendar(fr.month_starts(spark, sf), ORDER_PLAN)
    return features.scoring_dataset(order_lines(spark, sf), calendar)


@query
def windowed_scoring(spark, sf):
    """The newest two scoring dates from the lines of their windows; older lines give only first sales."""
    tx, d = order_lines(spark, sf), F.col("InvoiceDate")
    dates = fr.month_starts(spark, sf).where(F.col("as_of") >= day("2001-07-01"))
    start = moment("2001-02-01")
    return features.scoring_dataset(tx.where(d >= start), cal.scoring_calendar(dates, ORDER_PLAN), tx.where(d < start))


@query
def event_scoring_dataset(spark, sf):
    dates = read_table(spark, sf, "events").select(day_of(F.col("ts")).alias("as_of")).distinct()
    return features.scoring_dataset(event_lines(spark, sf), cal.scoring_calendar(dates, EVENT_PLAN))


@query
def purchase_interval_summary(spark, sf):
    return features.interval_summary(order_lines(spark, sf))


@query
def event_interval_summary(spark, sf):
    return features.interval_summary(event_lines(spark, sf))


@query
def outcome_labels(spark, sf):
    cohort = fr.matured_predictions(spark, sf)
    return labels.outcome_labels(cohort, order_lines(spark, sf), ORDER_PLAN, fr.labelled_windows(spark, sf)).drop("resolved_at")


@query
def split_dataset(spark, sf):
    return _split_rows(spark, sf, SPLIT)


def _split_rows(spark, sf, plan: SplitPlan) -> DataFrame:
    calendar = fr.labelled(spark, sf)
    split = cal.rolling_split(calendar, plan)
    # Only the split's windows are computed: the calendar is cut before the features.
    wanted = calendar.join(F.broadcast(split), "snapshot_no")
    # Lines before the first window only tell each customer's first sale.
    start, tx = wanted.agg(F.min("feature_start")).first()[0], order_lines(spark, sf)
    if start is None:
        start = "0001-01-01"
    since = F.col("InvoiceDate") >= moment(start)
    rows = features.training_dataset(tx.where(since), wanted.drop("split"), tx.where(~since))
    return rows.join(F.broadcast(split), "snapshot_no")


@query
def split_summary(spark, sf):
    return (
        split_dataset(spark, sf)
        .groupBy("split", "snapshot_no")
        .agg(F.count("*").alias("rows"), F.avg(LABEL).alias("label_rate"))
    )


@query
def group_folds(spark, sf):
    rows = fr.cohort_scores(order_lines(spark, sf), fr.labelled(spark, sf))
    return scoring.group_folds(rows, 3).select("snapshot_no", "CustomerID", "fold")


# --- drift --------------------------------------------------------------------------------------------


@query
def psi_single(spark, sf):
    o = read_table(spark, sf, "orders")
    side = F.when(F.col("o_orderdate") < moment("1998-01-01"), "baseline").otherwise("current")
    return drift.stability_index(o.select(side.alias("side"), F.col("o_totalprice").alias("value"), F.lit("o_totalprice").alias("feature")), ["feature"])


def _feature_report(spark, sf):
    rows = written(features.training_dataset(order_lines(spark, sf), fr.labelled(spark, sf)), "features")
    return drift.feature_drift(drift.consecutive_pairs(rows))


@query
def feature_drift(spark, sf):
    return _feature_report(spark, sf)


@query
def top_drift(spark, sf):
    return drift.top_drift(_feature_report(spark, sf))


@query
def drift_rollup(spark, sf):
    return drift.drift_rollup(_feature_report(spark, sf))


@query
def prediction_drift(spark, sf):
    rows = fr.cohort_scores(order_lines(spark, sf), fr.scorable(spark, sf))
    out = drift.prediction_drift(drift.consecutive_pairs(rows), ["pair"])
    return out.withColumn("status", drift.drift_status(F.col("prediction_psi")))


# --- scores and metrics -----------------------------------------------------------------------------------


@query
def score_projection(spark, sf):
    return fr.predictions(spark, sf).drop("run_id", "scored_at")


@query
def risk_tiers(spark, sf):
    p = (F.col("value") / 50).alias("p")
    return read_table(spark, sf, "events").select("event_id", p).withColumn("tier", risk_tier(F.col("p")))


@query
def scoring_summary(spark, sf):
    return scoring.scoring_summary(fr.predictions(spark, sf))


@query
def history_summary(spark, sf):
    raw = fr.raw_feed(spark, sf)
    return scoring.history_summary(raw, transactions.clean_transactions(raw))


def _score_rows(rows):
    return metrics.score_table(rows, COHORT, LABEL, threshold=F.col("threshold_used"))


def _scores(spark, sf):
    return _score_rows(fr.evaluated(spark, sf))


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scores(spark, sf), COHORT)


@query
def classification_metrics(spark, sf):
    return metrics.classification_metrics(_scores(spark, sf), COHORT)


@query
def probability_metrics(spark, sf):
    return metrics.probability_metrics(_scores(spark, sf), COHORT)


@query
def roc_auc(spark, sf):
    return metrics.roc_auc(_scores(spark, sf), COHORT)


@query
def average_precision(spark, sf):
    return metrics.average_precision(_scores(spark, sf), COHORT)


@query
def model_evaluation(spark, sf):
    return metrics.model_evaluation(_scores(spark, sf), COHORT)


@query
def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(metrics.outcome_rows(fr.evaluated(spark, sf), COHORT, LABEL), COHORT)


@query
def best_threshold(spark, sf):
    return metrics.best_threshold(metrics.threshold_sweep(metrics.outcome_rows(fr.evaluated(spark, sf), COHORT, LABEL), COHORT), COHORT)


@query
def calibration_deciles(spark, sf):
    return calibration.calibration_deciles(fr.evaluated(spark, sf), COHORT, LABEL)


@query
def ece(spark, sf):
    return calibration.expected_calibration_error(calibration.calibration_deciles(fr.evaluated(spark, sf), COHORT, LABEL), COHORT)


# --- delayed evaluation -----------------------------------------------------------------------------------


@query
def matured_cohorts(spark, sf):
    cohorts = fr.scorable(spark, sf).select(day_of(F.col("feature_end")).alias("snapshot_date"))
    return delayed.matured_cohorts(fr.month_starts(spark, sf), cohorts, day("1996-06-01"), ORDER_PLAN)


@query
def resolved_predictions(spark, sf):
    return fr.resolved(spark, sf).select(*COHORT, "CustomerID", "churn_probability", "predicted_churn", LABEL)


@query
def unevaluated_sets(spark, sf):
    sets = delayed.prediction_sets(fr.predictions(spark, sf))
    old = sets.where(F.col("snapshot_date") < day("1999-01-01"))
    role = F.when(F.col("prediction_role") == "shadow", F.col("prediction_role"))
    return delayed.unevaluated_sets(sets, old.withColumn("prediction_role", role))


@query
def delayed_evaluation(spark, sf):
    return delayed.delayed_evaluation(written(fr.resolved(spark, sf), "resolved"))


@query
def delayed_evaluation_stored(spark, sf):
    official = fr.resolved(spark, sf).where(F.col("prediction_role") == "official")
    return delayed.delayed_evaluation_stored(written(official, "resolved"))


@query
def resolved_rollup(spark, sf):
    return delayed.resolved_rollup(_evaluated(spark, sf))


def _evaluated(spark, sf):
    return metrics.model_evaluation(_scores(spark, sf), COHORT)


@query
def shadow_comparison(spark, sf):
    hist = _evaluated(spark, sf).withColumn("evaluated_at", F.lit("2002-01-01"))
    done = fr.month_starts(spark, sf).where(F.col("as_of") < day("1997-01-01")).select(F.col("as_of").alias("snapshot_date"))
    return delayed.shadow_comparison(hist, done)


# --- governance and lineage ---------------------------------------------------------------------------------


def _by_role(df, **prefixes):
    """One row a cohort with the metrics of each role under the role's prefix: one grouping, no self-join."""
    pick = lambda role, m: F.max(F.when(F.col("prediction_role") == role, F.col(m)))
    cols = [pick(role, m).alias(f"{prefix}{m}") for role, prefix in prefixes.items() for m in ("roc_auc", "recall", "brier_score")]
    return df.groupBy("snapshot_date").agg(*cols)


@query
def promotion_decision(spark, sf):
    return governance.promotion_decision(_by_role(_evaluated(spark, sf), official="challenger_", shadow="champion_"))


def _metadata(spark, sf):
    e = _by_role(_evaluated(spark, sf), official="t_", shadow="m_")
    even = F.year("snapshot_date") % 2 == 0
    pick = lambda p, on: F.struct(*[F.when(on, F.col(p + m)).alias(m) for m in governance.REFERENCE_METRICS])
    return e.select("snapshot_date", pick("t_", even).alias("test_metrics"), pick("m_", F.lit(True)).alias("metrics"))


@query
def reference_metrics(spark, sf):
    """Reference metrics of every cohort: the official ones as test metrics in even years, else the shadow's."""
    return governance.resolve_reference(_metadata(spark, sf)).drop("test_metrics", "metrics")


@query
def stored_metrics(spark, sf):
    """The same through metadata files: JSON records written and read back."""
    path = _folder(spark, "metadata")
    history.write_report(_metadata(spark, sf), path, "json")
    found = governance.resolve_reference(history.read_metadata(spark, path))
    return found.select("snapshot_date", "reference_source", *[f"reference_{m}" for m in governance.REFERENCE_METRICS])


@query
def behavioral_psi(spark, sf):
    """The behavioral drift of every pair: from the run's summary for even pairs, else from the drift rows."""
    report = written(_feature_report(spark, sf), "report")
    direct = F.when(F.col("pair") % 2 == 0, F.col("max_behavioral_feature_psi"))
    summary = drift.drift_rollup(report).select("pair", direct.alias("max_behavioral_feature_psi"))
    return governance.behavioral_psi(summary, report, "pair")


def _alerts(spark, sf):
    """Monitoring rows per official cohort: score drift, feature drift and delayed metrics, referenced to
    the shadow model of the same cohort; cohorts of odd years are scored by a model of other lineage."""
    # Drift and evaluation each give a small table; they meet by grouping their rows on the date.
    scored = written(fr.cohort_scores(order_lines(spark, sf), fr.labelled(spark, sf), outcome=True), "cohorts")
    psi = drift.prediction_drift(drift.consecutive_pairs(scored), ["pair"])
    roll = drift.drift_rollup(_feature_report(spark, sf)).select("pair", "max_behavioral_feature_psi")
    dates = fr.labelled(spark, sf).select(F.col("snapshot_no").alias("pair"), day_of(F.col("feature_end")).alias("snapshot_date"))
    evaluated = _by_role(metrics.model_evaluation(_score_rows(fr.with_roles(scored, LABEL)), COHORT), official="", shadow="reference_")
    facts = (
        dates.join(F.broadcast(psi.select("pair", "prediction_psi").unionByName(roll, allowMissingColumns=True)), "pair", "left")
        .drop("pair")
        .unionByName(evaluated, allowMissingColumns=True)
    )
    runs = (
        facts.groupBy("snapshot_date")
        .agg(*[F.max(c).alias(c) for c in facts.columns if c != "snapshot_date"])
        .withColumn("evaluated", F.col("recall").isNotNull())
        .withColumn("model_lineage", F.when(F.year("snapshot_date") % 2 == 1, "other:1").otherwise("v2"))
        .withColumn("reference_model", F.lit("v2"))
    )
    return governance.alert_signals(runs)


@query
def alert_signals(spark, sf):
    return _alerts(spark, sf)


@query
def alert_rollup(spark, sf):
    return governance.alert_rollup(_alerts(spark, sf))


@query
def new_ingestions(spark, sf):
    return lineage.new_ingestions(fr.month_files(spark, sf), fr.month_manifest(spark, sf))


@query
def latest_success(spark, sf):
    return lineage.latest_success(fr.month_manifest(spark, sf))


@query
def data_through_date(spark, sf):
    return lineage.data_through_date(fr.month_manifest(spark, sf))


@query
def latest_execution(spark, sf):
    p = fr.predictions(spark, sf)
    late = F.when(F.col("prediction_role") == "shadow", "T120000Z-b").otherwise("T000000Z-a")
    runs = p.withColumn("execution_id", F.concat(F.date_format("snapshot_date", "yyyyMMdd"), late))
    return lineage.latest_execution(runs).select("snapshot_date", "execution_id", "CustomerID", "churn_probability")


@query
def champion_asof(spark, sf):
    cohorts = fr.scorable(spark, sf).select(day_of(F.col("feature_end")).alias("snapshot_date"))
    return lineage.champion_asof(cohorts, fr.promotions(spark, sf), "gbt")




# --- stored tables: written to the shared folder and read back -------------------------------------------


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _csv_drop(spark, sf) -> str:
    """The order lines as a delivered CSV folder."""
    path = _folder(spark, "drop")
    with scratch(spark):
        _deliver(written(order_lines(spark, sf), "order-lines"), path)  # one join for both layouts
    return path


def _deliver(lines, path: str, again: str = "") -> None:
    """Stored lines as CSV files of two layouts; or delivered ``again``."""
    when, early = F.date_format(F.col("InvoiceDate"), transactions.CSV_TIME_FORMAT), F.col("InvoiceDate") < moment("1998-01-01")
    write = lambda df, name: df.withColumn("InvoiceDate", when).write.option("header", True).csv(f"{path}/{name}{again}")
    write(lines.where(early), "early")
    # Later files have the columns in another order, and one more.
    write(lines.where(~early).withColumn("Country", F.lit("X, Y")).select("Country", *reversed(LINE)), "late")


@query
def csv_scan(spark, sf):
    return transactions.scan_transactions(spark, _csv_drop(spark, sf)).select(*LINE)


@query
def curated_store(spark, sf):
    """Two overlapping batches merged month by month."""
    return curated.read_curated(spark, _overlapping_loads(spark, sf))


def _overlapping_loads(spark, sf) -> str:
    store, tx, d = _folder(spark, "store"), order_lines(spark, sf), F.col("InvoiceDate")
    curated.update_curated(spark, store, tx.where(d < moment("2001-05-01")))
    curated.update_curated(spark, store, tx.where(d >= moment("2001-02-01")))
    return store


@query
def compacted_store(spark, sf):
    """The same after compaction, with the replaced files gone."""
    store = _overlapping_loads(spark, sf)
    curated.compact_curated(spark, store, max_deltas=2)
    curated.drop_superseded(spark, store)
    return curated.read_curated(spark, store)


@query
def logged_volumes(spark, sf):
    """Monthly volumes from the store's log alone."""
    return curated.monthly_volumes(spark, _overlapping_loads(spark, sf))


@query
def stored_first_sales(spark, sf):
    """First sales before a day, from the state that merges keep."""
    return curated.first_sales(spark, _overlapping_loads(spark, sf), before="2000-01-01")


@query
def deduplicated_stream(spark, sf):
    """The CSV folder, delivered twice over, loaded as a stream that drops copies by its state."""
    drop, store, state = (_folder(spark, x) for x in ("drop", "store", "state"))
    quarantine = _folder(spark, "quarantine")
    load = lambda: streaming.stream_deduplicated(spark, drop, store, quarantine, state, delay="3650 days", keep_drops=False).awaitTermination()
    with scratch(spark):
        lines = written(order_lines(spark, sf), "order-lines")
        _deliver(lines, drop)
        _deliver(lines, drop, "-again")
        load()
        _deliver(lines, drop, "-later")
    load()
    return curated.read_curated(spark, store).select(*LINE)


@query
def streamed_store(spark, sf):
    """The CSV folder loaded as a stream, and loaded again without effect."""
    drop, store, state = _csv_drop(spark, sf), _folder(spark, "store"), _folder(spark, "state")
    for _ in range(2):
        streaming.stream_transactions(spark, drop, store, _folder(spark, "quarantine"), state).awaitTermination()
    return curated.read_curated(spark, store).select(*LINE)


@query
def prediction_sink(spark, sf):
    path = _folder(spark, "predictions")
    history.write_predictions(fr.predictions(spark, sf), path)
    cols = (*COHORT, "CustomerID", "churn_probability", "predicted_churn", "risk_tier")
    return history.read_history(spark, path).select(*cols)


@query
def execution_history(spark, sf):
    """Two executions of every cohort side by side; the newest is read back."""
    path, p = _folder(spark, "executions"), fr.predictions(spark, sf)
    history.write_execution(p.where(F.col("prediction_role") == "official"), path, "20020101T000000Z-a")
    history.write_execution(p.where(F.col("prediction_role") == "shadow"), path, "20020102T000000Z-b")
    return lineage.latest_execution(history.read_history(spark, path)).select(
        "snapshot_date", "execution_id", "CustomerID", "churn_probability"
    )


@query
def feature_snapshot(spark, sf):
    path = _folder(spark, "features")
    history.write_feature_snapshot(features.customer_features(order_lines(spark, sf), fr.scorable(spark, sf)), path)
    return history.read_history(spark, path)


@query
def manifest_log(spark, sf):
    path = _folder(spark, "manifest")
    history.append_manifest(fr.month_manifest(spark, sf), path)
    return history.read_manifest(spark, path).select("source_file", "sha256", "snapshot_date", "status", "raw_rows", "recorded_at")


@query
def report_sinks(spark, sf):
    """The monthly volume written as JSON, CSV and parquet, read back and stacked."""
    m, out = quality.monthly_volume(order_lines(spark, sf)), []
    for fmt in ("json", "csv", "parquet"):
        path = _folder(spark, fmt)
        history.write_report(m, path, fmt)
        reader = spark.read.schema(m.schema)
        df = (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)
        out.append(df.withColumn("format", F.lit(fmt)))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def file_inventory(spark, sf):
    """Lines and sums of line hashes of the files of a delivered folder, added up over the files."""
    path = _folder(spark, "files")
    keys = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    keys.select(F.concat_ws("|", *[c.cast("string") for c in map(F.col, keys.columns)]).alias("value")).write.text(path)
    files = history.file_inventory(spark, path, "*.txt")
    return files.agg(F.sum("lines").alias("lines"), F.sum("line_sum").cast("string").alias("line_sum"))


# --- models: no SQL restates a fit, so these are checked by their row counts and the unit tests -------------


def _split(spark, sf):
    return written(split_dataset(spark, sf), "split")


@query
def forest_importance(spark, sf):
    """Importance of the frozen random forest fitted on the rolling training snapshots."""
    rows = _split(spark, sf).where(F.col("split") == "train")
    return models.feature_importance(models.fit(models.production_candidate("random_forest")[0], rows))


@query
def logistic_scores(spark, sf):
    rows = _split(spark, sf)
    model = models.fit(models.logistic_regression(), rows.where(F.col("split") == "train"))
    return models.probabilities(model, rows.where(F.col("split") == "val"), ["snapshot_no", "CustomerID"])


@query
def boosted_scores(spark, sf):
    """Scores of the frozen boosted trees, with absent features kept visible to the trees."""
    rows = _split(spark, sf)
    model = models.fit(models.production_candidate("gradient_boosting")[0], rows.where(F.col("split") == "train"))
    return models.probabilities(model, rows.where(F.col("split") == "val"), ["snapshot_no", "CustomerID"])


@query
def forward_validation(spark, sf):
    rows = _split(spark, sf).where(F.col("split") == "train")
    folds = models.forward_validation(models.production_candidate("random_forest")[0], rows)
    return spark.createDataFrame(
        [(",".join(map(str, f["train_snapshots"])), f["validation_snapshot"], f["roc_auc"]) for f in folds],
        "train_snapshots string, validation_snapshot int, roc_auc double",
    )


@query
def grid_search(spark, sf):
    """The whole grid of the forest, by mean ROC-AUC over three forward folds: four training snapshots of six labelled ones."""
    panel = _split_rows(spark, sf, SplitPlan(train=4, val=1, test=1)).where(F.col("split") == "train")
    return models.tune("random_forest", written(panel, "panel"), parallelism=8)[2]


@query
def model_comparison(spark, sf):
    """A forest and a logistic challenger on the validation cohort, each at its own best threshold."""
    rows = _split(spark, sf)
    train, val = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "val")
    parts = [
        models.probabilities(models.fit(p, train), val, ["CustomerID", LABEL]).withColumn("model", F.lit(name))
        for name, p in (("forest", models.production_candidate("random_forest")[0]), ("logistic", models.logistic_regression()))
    ]
    scored = written(parts[0].unionByName(parts[1]), "scored")
    best = metrics.best_threshold(metrics.threshold_sweep(metrics.score_table(scored, ["model"], LABEL), ["model"]), ["model"])
    scores = metrics.score_table(scored.join(F.broadcast(best), "model"), ["model"], LABEL, threshold=F.col("best_threshold"))
    return metrics.model_evaluation(scores, ["model"])
