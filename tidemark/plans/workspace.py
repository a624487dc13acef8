"""Locations of the stored tables, all under one shared root."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.lineage import champion_spans
from tidemark.sources import history
from tidemark.sources.store import first_sales, read_curated


@dataclass(frozen=True)
class Workspace:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def curated(self, spark: SparkSession, since=None, before=None) -> DataFrame:
        return read_curated(spark, self.path("curated"), since, before)

    def feature_inputs(self, spark: SparkSession, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Lines from the first window of ``calendar`` on, and the first sales before it as lines: all that features need of those.

        First sales come from the store's state, so no month before the window is read.
        """
        start = calendar.agg(F.min("feature_start")).first()[0]
        sales = first_sales(spark, self.path("curated"), before=start)
        return self.curated(spark, since=start), sales.select("CustomerID", F.col("first_sale").alias("InvoiceDate"), F.lit(1.0).alias("Quantity"))

    def manifest(self, spark: SparkSession) -> DataFrame:
        return history.read_manifest(spark, self.path("manifest"))

    def table(self, spark: SparkSession, name: str) -> DataFrame | None:
        df = history.read_history(spark, self.path(name))
        # As a partition column a version made of digits would come back as a number.
        return df if df is None or "model_version" not in df.columns else df.withColumn("model_version", F.col("model_version").cast("string"))

    def champion(self, spark: SparkSession, model_type: str, as_of: str | None = None):
        """Version row of the champion at ``as_of`` (default: now) with the version it replaced, or None."""
        versions = self.table(spark, "versions")
        if versions is None:
            return None
        promoted = versions.where((F.col("model_type") == model_type) & F.col("promoted_at").isNotNull())
        spans = champion_spans(promoted.withColumnRenamed("replaced_version", "declared_replaced"))
        if as_of is not None:
            at = F.lit(as_of).cast("date")
            spans = spans.where((F.col("promoted_at") <= at) & (F.col("replaced_at").isNull() | (F.col("replaced_at") > at)))
        return spans.orderBy(F.desc("promoted_at"), F.desc("version")).first()
