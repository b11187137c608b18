"""Exposure concentration and allowance (ECL) aggregation over ``fact_ecl``.

Ratios to a grand total use a one-row aggregate crossed in by broadcast
(never an un-keyed window over loan rows); global top-k is ``orderBy.limit``
(TakeOrderedAndProject: a per-partition top-k, then a merge of k rows each).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..functions.columns import hhi, ratio_round
from .scalars import scalar_row


def _d(c) -> F.Column:
    return F.col(c).cast("double")


def sector_exposure(ecl: DataFrame) -> DataFrame:
    """q6a: EAD, share of EAD, ECL and rank by sector."""
    g = ecl.groupBy("sector").agg(F.count(F.lit(1)).alias("loans"), F.sum("ead").alias("total_ead"),
                                  F.sum("ecl_weighted").alias("total_ecl"))
    everything = Window.partitionBy()  # over one row per sector
    return g.select(
        "sector", F.col("loans").cast("long"), _d("total_ead").alias("total_ead"),
        F.round(_d("total_ead") / F.sum(_d("total_ead")).over(everything), 4).alias("exposure_share"),
        _d("total_ecl").alias("total_ecl"),
        F.rank().over(Window.orderBy(F.desc("total_ead"))).cast("long").alias("exposure_rank"),
    ).orderBy(F.desc("total_ead"), "sector")


def hhi_by_dimension(ecl: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """q6b: Herfindahl index of EAD by sector and by region, with a flag.

    One scan: each loan row is unpivoted into (sector, x) and (region, x),
    grouped once, then the HHI aggregate runs over the group sums.
    """
    legs = ecl.select("ead", F.explode(F.array(
        F.struct(F.lit("sector").alias("dimension"), F.col("sector").alias("grp")),
        F.struct(F.lit("region").alias("dimension"), F.col("region").alias("grp")))).alias("leg"))
    groups = legs.groupBy(F.col("leg.dimension").alias("dimension"), F.col("leg.grp").alias("grp")) \
        .agg(F.sum("ead").alias("grp_ead"))
    h = groups.groupBy("dimension").agg(hhi("grp_ead").alias("_hhi"))
    flag = F.when(F.col("_hhi") > cfg.hhi_high, F.lit("Highly concentrated")) \
        .when(F.col("_hhi") > cfg.hhi_moderate, F.lit("Moderately concentrated")).otherwise(F.lit("Diversified"))
    return h.select("dimension", F.round("_hhi", 4).alias("hhi"), flag.alias("concentration_flag")).orderBy("dimension")


def _top_share(ecl: DataFrame, value: str, k: int, share_name: str, cum_name: str) -> DataFrame:
    top = ecl.orderBy(F.desc(value), F.asc("loan_id")).limit(k)
    ranked = top.withColumn("_total", scalar_row(ecl.agg(F.sum(value).alias("t")))["t"]) \
        .withColumn("_share", _d(value) / F.when(F.col("_total") != 0, _d("_total")))
    order = Window.orderBy(F.desc(value), F.asc("loan_id"))  # over k rows
    return ranked.withColumn("rank", F.row_number().over(order).cast("long")) \
        .withColumn(share_name, F.round("_share", 4)) \
        .withColumn(cum_name, F.round(F.sum("_share").over(order.rowsBetween(Window.unboundedPreceding, 0)), 4))


def single_name(ecl: DataFrame, k: int = 10) -> DataFrame:
    """q6c: top-k exposures with share and cumulative share of total EAD."""
    r = _top_share(ecl, "ead", k, "exposure_share", "cumulative_share")
    return r.select("rank", F.col("loan_id").cast("long"), "sector", "region", F.col("ifrs9_stage").cast("long"),
                    _d("ead").alias("ead"), "exposure_share", "cumulative_share",
                    F.round(_d("ecl_weighted"), 2).alias("ecl_weighted")).orderBy("rank")


def stage_coverage(ecl: DataFrame) -> DataFrame:
    """q7c: loans, EAD, ECL, coverage and mean 12-month PD per stage."""
    g = ecl.groupBy("ifrs9_stage").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("ead").alias("total_ead"), F.sum("ecl_weighted").alias("total_ecl"),
        F.sum((F.col("pd_12m") * 1000000).cast("long")).alias("_pd_micro"))
    cov = _d("total_ecl") / F.when(F.col("total_ead") != 0, _d("total_ead"))
    return g.select(
        F.col("ifrs9_stage").cast("long"), F.col("loans").cast("long"), _d("total_ead").alias("total_ead"),
        _d("total_ecl").alias("total_ecl"), F.round(cov, 4).alias("coverage_ratio"),
        ratio_round("_pd_micro", F.col("loans") * 1000000, 4).alias("avg_pd_12m"),
    ).orderBy("ifrs9_stage")


def allowance(ecl: DataFrame) -> DataFrame:
    """q9a: headline allowance, coverage and scenario totals (one row)."""
    g = ecl.agg(F.count(F.lit(1)).alias("loans"), F.sum("ead").alias("total_ead"),
                F.sum("ecl_weighted").alias("weighted_ecl"), F.sum("ecl_base").alias("ecl_base"),
                F.sum("ecl_downside").alias("ecl_downside"), F.sum("ecl_severe").alias("ecl_severe"))
    cov = _d("weighted_ecl") / F.when(F.col("total_ead") != 0, _d("total_ead"))
    return g.select(F.col("loans").cast("long"), _d("total_ead").alias("total_ead"),
                    _d("weighted_ecl").alias("weighted_ecl"), F.round(cov, 4).alias("coverage_ratio"),
                    _d("ecl_base").alias("ecl_base"), _d("ecl_downside").alias("ecl_downside"),
                    _d("ecl_severe").alias("ecl_severe"))


def stage_sector(ecl: DataFrame) -> DataFrame:
    """q9b: stage x sector detail plus per-stage subtotals (GROUPING SETS).

    Subtotal rows are labelled by ``grouping(sector)``, not by a NULL test.
    """
    g = ecl.groupingSets([["ifrs9_stage", "sector"], ["ifrs9_stage"]], "ifrs9_stage", "sector").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("ead").alias("total_ead"),
        F.sum("ecl_weighted").alias("total_ecl"), F.grouping("sector").alias("_sub"))
    cov = _d("total_ecl") / F.when(F.col("total_ead") != 0, _d("total_ead"))
    return g.select(
        F.col("ifrs9_stage").cast("long"),
        F.when(F.col("_sub") == 1, F.lit("ALL SECTORS")).otherwise(F.col("sector")).alias("sector"),
        F.col("loans").cast("long"), _d("total_ead").alias("total_ead"), _d("total_ecl").alias("total_ecl"),
        F.round(cov, 4).alias("coverage_ratio"), "_sub",
    ).orderBy("ifrs9_stage", F.desc("_sub"), "sector").drop("_sub")


def reconcile(ecl: DataFrame, scenarios: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """q9c: rebuild the weighted ECL from scenario weights; report the difference.

    Decimal arithmetic throughout, so the difference is exact.
    """
    names = ("base", "downside", "severe")
    t = ecl.agg(F.sum("ecl_base").alias("base"), F.sum("ecl_downside").alias("downside"),
                F.sum("ecl_severe").alias("severe"), F.sum("ecl_weighted").alias("stored"))
    weights = scenarios.agg(*[F.max(F.when(F.col("scenario") == n, F.col("weight"))).alias(n) for n in names])
    j = t.withColumn("_w", scalar_row(weights))  # one scalar subquery, read three times
    recomputed = F.col("_w.base") * F.col("base") + F.col("_w.downside") * F.col("downside") \
        + F.col("_w.severe") * F.col("severe")
    return j.select(
        F.round("base", 2).cast("double").alias("ecl_base"),
        F.round("downside", 2).cast("double").alias("ecl_downside"),
        F.round("severe", 2).cast("double").alias("ecl_severe"),
        F.round(recomputed, 2).cast("double").alias("recomputed_weighted"),
        F.round("stored", 2).cast("double").alias("stored_weighted"),
        F.round(F.abs(recomputed - F.col("stored")), 2).cast("double").alias("reconciliation_diff"))


def top_ecl(ecl: DataFrame, k: int = 20) -> DataFrame:
    """q9d: top-k ECL contributors with share and cumulative share of the allowance."""
    r = _top_share(ecl, "ecl_weighted", k, "ecl_share", "cumulative_ecl_share")
    return r.select("rank", F.col("loan_id").cast("long"), "sector", "region", F.col("ifrs9_stage").cast("long"),
                    _d("ead").alias("ead"), F.round(_d("ecl_weighted"), 2).alias("ecl_weighted"),
                    "ecl_share", "cumulative_ecl_share").orderBy("rank")
