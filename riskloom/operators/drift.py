"""Population stability against a stored baseline.

A baseline is made once (with a model, or for a first year) and kept: the decile edges of each feature and the rows
per bin. Histograms over the same edges add up, so those of months or files are merged instead of counted again, and the stability
index of a new month needs that month's rows and the baseline only.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: panel columns watched by default
PANEL_FEATURES = ("utilization", "dpd", "outstanding_balance")


def _long(rows: DataFrame, features: tuple[str, ...], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, feature, value): a row per feature with a value, rounded to 6 places."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.round(F.col(f).cast("double"), 6).alias("value")) for f in features])
    return rows.select(*keys, F.explode(pairs).alias("x")).select(*keys, "x.feature", "x.value").where(F.col("value").isNotNull())


@dataclass
class Baseline:
    """``edges``: (feature, edges); ``counts``: (feature, bin, n). Both have a few rows per feature."""

    features: tuple[str, ...]
    edges: DataFrame
    counts: DataFrame

    def histogram(self, rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
        """(keys, feature, bin, n) of ``rows`` over the baseline's edges (bin: edges below the value)."""
        binned = _long(rows, self.features, keys).join(F.broadcast(self.edges), "feature").withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))))
        return binned.groupBy(*keys, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))

    def psi(self, counts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
        """(keys, feature, psi) of histograms against the baseline; bins empty on either side are left out, as in ``monitoring.psi``."""
        e = self.counts.select("feature", "bin", (F.col("n") / F.sum("n").over(Window.partitionBy("feature"))).alias("_e"))      # a row per bin
        a = counts.select(*keys, "feature", "bin", (F.col("n") / F.sum("n").over(Window.partitionBy(*keys, "feature"))).alias("_a"))
        both = a.join(F.broadcast(e), ["feature", "bin"])
        return both.groupBy(*keys, "feature").agg(F.round(F.sum((F.col("_a") - F.col("_e")) * F.ln(F.col("_a") / F.col("_e"))), 4).alias("psi"))

    def save(self, path: str) -> str:
        """Write the baseline under ``path`` (overwrite)."""
        self.edges.coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")
        self.counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")
        return path


def load_baseline(spark: SparkSession, path: str) -> Baseline:
    edges = spark.read.parquet(f"{path}/edges")
    return Baseline(tuple(sorted(r["feature"] for r in edges.select("feature").collect())), edges, spark.read.parquet(f"{path}/counts"))    # a name per feature


def make_baseline(rows: DataFrame, features: tuple[str, ...] = PANEL_FEATURES, n_bins: int = 10) -> Baseline:
    """Decile edges (exact, interpolated) and counts of ``rows``; values are counted first, so a task merges one entry per distinct value."""
    values = _long(rows, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    edges = values.groupBy("feature").agg(F.percentile("value", [i / n_bins for i in range(1, n_bins)], F.col("n")).alias("edges"))
    counts = values.join(F.broadcast(edges), "feature").groupBy("feature", F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("bin")).agg(F.sum("n").alias("n"))
    return Baseline(tuple(features), edges, counts)


def merge_histograms(*parts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The sum of histograms over the same edges."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy(*keys, "feature", "bin").agg(F.sum("n").alias("n"))
