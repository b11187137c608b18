"""Watchlist extraction (latest servicing view + trailing behaviour)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequence import top_k_per_key


def _latest_and_trailing(panel: DataFrame, months: int = 6) -> DataFrame:
    """One window pass: latest row per loan plus aggregates of its last ``months`` rows."""
    last = top_k_per_key(panel.select("loan_id", "snapshot_month", "dpd", "dpd_bucket", "ifrs9_stage",
                                      "outstanding_balance"),
                         "loan_id", [F.desc("snapshot_month")], months, "_rn")
    latest = F.col("_rn") == 1
    return last.groupBy("loan_id").agg(
        F.max(F.when(latest, F.col("dpd"))).alias("dpd"),
        F.max(F.when(latest, F.col("dpd_bucket"))).alias("dpd_bucket"),
        F.max(F.when(latest, F.col("ifrs9_stage"))).alias("ifrs9_stage"),
        F.max(F.when(latest, F.col("outstanding_balance"))).alias("outstanding_balance"),
        F.count_if(F.col("dpd") > 0).alias("months_delinquent_6m"),
        F.max("dpd").alias("max_dpd_6m"))


# fixed values (must match the reference query): watch score =
#   0.45 PD + 0.25 min(max DPD 6m / 90, 1) + 0.20 (stage - 1) / 2 + 0.10 min(months delinquent / 6, 1)
# entry: stage >= 2, PD >= 0.15 or DPD >= 30; top 50 by expected loss at risk


def watchlist(panel: DataFrame, loans: DataFrame, ecl: DataFrame, k: int = 50,
              rank_by: str = "expected_loss_at_risk") -> DataFrame:
    """q8a: top-k loans by PD x LGD x balance among elevated-risk accounts.

    Entry: latest stage >= 2, PD >= 0.15 or max DPD over the last 6
    observations >= 30. ``rank_by`` may be ``watch_score`` instead.
    """
    lt = _latest_and_trailing(panel)
    j = lt.join(loans.select("loan_id", "sector", "region"), "loan_id") \
        .join(ecl.select("loan_id", "pd_12m", "lgd"), "loan_id")
    j = j.filter((F.col("ifrs9_stage") >= 2) | (F.col("pd_12m") >= 0.15) | (F.col("max_dpd_6m") >= 30))
    pd_d = F.col("pd_12m").cast("double")
    score = (F.lit(0.45) * pd_d
             + F.lit(0.25) * F.least(F.col("max_dpd_6m") / F.lit(90.0), F.lit(1.0))
             + F.lit(0.20) * (F.col("ifrs9_stage") - 1) / F.lit(2.0)
             + F.lit(0.10) * F.least(F.col("months_delinquent_6m") / F.lit(6.0), F.lit(1.0)))
    out = j.select(
        F.col("loan_id").cast("long"), "sector", "region", "dpd_bucket", F.col("ifrs9_stage").cast("long"),
        F.col("months_delinquent_6m").cast("long"), F.col("max_dpd_6m").cast("long"),
        F.round("pd_12m", 4).cast("double").alias("pd_12m"),
        F.round(F.col("pd_12m") * F.col("lgd") * F.col("outstanding_balance"), 2).cast("double")
        .alias("expected_loss_at_risk"),
        F.round(score, 4).alias("watch_score"))
    return out.orderBy(F.desc(rank_by), F.asc("loan_id")).limit(k)


def watch_rollup(panel: DataFrame, loans: DataFrame, ecl: DataFrame) -> DataFrame:
    """q8b: watchlist count and loss at risk by sector and region with ROLLUP subtotals.

    Entry here uses the latest DPD (>= 30), not the 6-month maximum.
    """
    latest = top_k_per_key(panel.select("loan_id", "snapshot_month", "ifrs9_stage", "dpd", "outstanding_balance"),
                           "loan_id", [F.desc("snapshot_month")], 1, "_rn").drop("_rn", "snapshot_month")
    j = latest.join(loans.select("loan_id", "sector", "region"), "loan_id") \
        .join(ecl.select("loan_id", "pd_12m", "lgd"), "loan_id") \
        .filter((F.col("ifrs9_stage") >= 2) | (F.col("pd_12m") >= 0.15) | (F.col("dpd") >= 30)) \
        .withColumn("_eltr", F.col("pd_12m") * F.col("lgd") * F.col("outstanding_balance"))
    g = j.rollup("sector", "region").agg(F.count(F.lit(1)).alias("watchlist_accounts"),
                                         F.sum("_eltr").alias("_sum"))
    return g.select("sector", "region", F.col("watchlist_accounts").cast("long"),
                    F.round("_sum", 2).cast("double").alias("expected_loss_at_risk")) \
        .orderBy(F.asc_nulls_last("sector"), F.asc_nulls_last("region"))
