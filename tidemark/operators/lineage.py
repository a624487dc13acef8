"""Which file, execution and model version counts: manifests, reruns and champion history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def new_ingestions(incoming: DataFrame, manifest: DataFrame) -> DataFrame:
    """Incoming files without a successful load of the same content for the same snapshot."""
    keys = ["sha256", "snapshot_date"]
    done = manifest.where(F.col("status") == "SUCCESS").select(*keys).distinct()
    return incoming.join(done, keys, "left_anti")


def latest_success(manifest: DataFrame) -> DataFrame:
    """The newest successful record per content and snapshot."""
    rest = [c for c in manifest.columns if c not in ("sha256", "snapshot_date")]
    return (
        manifest.where(F.col("status") == "SUCCESS")
        .groupBy("sha256", "snapshot_date")
        .agg(F.max_by(F.struct(*rest), "recorded_at").alias("r"))
        .select("sha256", "snapshot_date", "r.*")
    )


def data_through_date(manifest: DataFrame) -> DataFrame:
    """The newest successfully loaded snapshot date: the coverage boundary. NULL when none."""
    return manifest.where(F.col("status") == "SUCCESS").agg(F.max("snapshot_date").alias("data_through_date"))


def latest_execution(history: DataFrame, cohort: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """All rows of the newest execution per cohort. Execution ids begin with a UTC timestamp.

    The winners are one row per cohort, found by a combining aggregate, and go back as a broadcast.
    """
    newest = history.groupBy(*cohort).agg(F.max("execution_id").alias("execution_id"))
    return history.join(F.broadcast(newest), [*cohort, "execution_id"], "left_semi")


def champion_spans(promotions: DataFrame) -> DataFrame:
    """Each champion with the version it replaced and the time the next one took over.

    ``promotions`` has ``model_type, version, promoted_at``: one row per promotion of a model type.
    """
    w = Window.partitionBy("model_type").orderBy("promoted_at", "version")
    return (
        promotions.withColumn("replaced_version", F.lag("version").over(w))
        .withColumn("replaced_at", F.lead("promoted_at").over(w))
    )


def champion_asof(cohorts: DataFrame, promotions: DataFrame, model_type: str) -> DataFrame:
    """Official and shadow version of each cohort: the champion at its date and the one before it.

    Promotions and cohorts are planning tables (a few rows per month of history); they are laid on one
    time line, a promotion before the cohort of its day.
    """
    spans = champion_spans(promotions).where(F.col("model_type") == model_type)
    line = spans.select(
        F.col("promoted_at").cast("date").alias("at"), F.lit(0).alias("kind"), F.struct("version", "replaced_version").alias("champion")
    ).unionByName(
        cohorts.select(F.col("snapshot_date").cast("date").alias("at"), F.lit(1).alias("kind")), allowMissingColumns=True
    )
    sofar = Window.partitionBy(F.lit(model_type)).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    official, replaced = F.col("champion.version"), F.col("champion.replaced_version")
    return (
        line.withColumn("champion", F.last("champion", ignorenulls=True).over(sofar))
        .where((F.col("kind") == 1) & F.col("champion").isNotNull())
        .select(
            F.col("at").alias("snapshot_date"),
            F.lit(model_type).alias("model_type"),
            official.alias("official_version"),
            F.when(replaced != official, replaced).alias("shadow_version"),
        )
    )
