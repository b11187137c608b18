"""Loan-level portfolio: behavioural summary, exposure and scorecards.

``behaviour_12m`` turns the long loan-month panel into one row per loan
(the 12-month features the models use); ``build_portfolio`` adds the loan
attributes, EAD and the fixed-coefficient PD / LGD scorecards.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LGD_SECTOR_BASE, PD_INTERCEPT, PD_SECTOR_ADDON
from ..functions.columns import clip, round_cents, sigmoid
from .sequence import top_k_per_key


def _sector_map(values: dict) -> Column:
    s = F.col("sector")
    expr = None
    for k, v in values.items():
        expr = F.when(s == k, F.lit(v)) if expr is None else expr.when(s == k, F.lit(v))
    return expr.otherwise(F.lit(0.0))


def behaviour_12m(panel: DataFrame, dpd_col: str = "dpd", ages: DataFrame | None = None) -> DataFrame:
    """Per-loan summary of the last 12 observations.

    loan_id, as_of_date, loan_age_months (all observations), max_dpd_12m,
    avg_dpd_12m, missed_payments_12m (DPD > 5), avg/max_utilization_12m,
    utilization_trend (mean of last 3 minus mean of first 3, fraction),
    current_dpd and utilization (latest observation). With ``ages`` (loan_id,
    loan_age_months) the panel need only hold each loan's last 12 observations.
    """
    base = panel.select("loan_id", "snapshot_month", F.col(dpd_col).alias("_dpd"),
                        F.col("utilization").cast("double").alias("_util"))
    last12 = top_k_per_key(base, "loan_id", [F.desc("snapshot_month")], 12, "_rd")
    # at most 12 rows per loan here: a bounded window on the same partitioning
    last12 = last12.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("loan_id")))
    summary = last12.groupBy("loan_id").agg(
        F.max("snapshot_month").alias("as_of_date"),
        F.max("_dpd").cast("int").alias("max_dpd_12m"),
        F.round(F.avg("_dpd"), 3).alias("avg_dpd_12m"),
        F.sum(F.when(F.col("_dpd") > 5, 1).otherwise(0)).cast("int").alias("missed_payments_12m"),
        F.round(F.avg("_util"), 2).alias("avg_utilization_12m"),
        F.round(F.max("_util"), 2).alias("max_utilization_12m"),
        F.round((F.avg(F.when(F.col("_rd") <= 3, F.col("_util")))
                 - F.avg(F.when(F.col("_rd") >= F.col("_k") - 2, F.col("_util")))) / F.lit(100.0), 4)
        .alias("utilization_trend"),
        F.max(F.when(F.col("_rd") == 1, F.col("_dpd"))).cast("int").alias("current_dpd"),
        F.max(F.when(F.col("_rd") == 1, F.col("_util"))).alias("utilization"),
    )
    if ages is None:
        ages = base.groupBy("loan_id").agg(F.count(F.lit(1)).cast("int").alias("loan_age_months"))
    return summary.join(ages, "loan_id")


# --- fixed values (must match the reference model): EAD, PD and LGD scorecards ----
# EAD   = amount x clip(1 - age/term, 0.15, 1) x (0.85 + 0.15 utilisation/100)
# logit = -3.2 + 2.4 (680 - score)/50 + 0.9 (dti - 36)/10 + 1.1 (ltv - 72)/12
#         + 0.8 (1.35 - dscr)/0.35 + 0.5 utilisation/100 + 0.04 missed + 0.015 max DPD
#         + sector add-on (config.PD_SECTOR_ADDON)
# LGD   = clip(sector base + 0.35 (ltv - 72)/100 - 0.10 (dscr - 1.35), 0.02, 0.95)
# The expressions below state these numbers in this order.
# -----------------------------------------------------------------------------------

def ead_projection(amount="loan_amount", age="loan_age_months", term="term_months",
                   util="utilization") -> Column:
    """EAD = amount x clip(1 - age/term, 0.15, 1) x (0.85 + 0.15 util/100), to cents."""
    amort = clip(F.lit(1.0) - F.col(age) / F.col(term), 0.15, 1.0)
    draw = F.lit(0.85) + F.lit(0.15) * F.col(util) / F.lit(100.0)
    return round_cents(F.col(amount) * amort * draw)


def pd_logit() -> Column:
    """Fixed-coefficient PD scorecard (log-odds) over portfolio columns."""
    return (F.lit(PD_INTERCEPT)
            + F.lit(2.4) * ((F.lit(680) - F.col("credit_score")) / F.lit(50.0))
            + F.lit(0.9) * ((F.col("dti") - F.lit(36.0)) / F.lit(10.0))
            + F.lit(1.1) * ((F.col("ltv") - F.lit(72.0)) / F.lit(12.0))
            + F.lit(0.8) * ((F.lit(1.35) - F.col("dscr")) / F.lit(0.35))
            + F.lit(0.5) * (F.col("utilization") / F.lit(100.0))
            + F.lit(0.04) * F.col("missed_payments_12m")
            + F.lit(0.015) * F.col("max_dpd_12m")
            + _sector_map(PD_SECTOR_ADDON))


def scorecard_pd() -> Column:
    """12-month PD of the scorecard, rounded to 6 places."""
    return F.round(sigmoid(pd_logit()), 6)


def lgd_mean() -> Column:
    return clip(_sector_map(LGD_SECTOR_BASE)
                + F.lit(0.35) * ((F.col("ltv") - F.lit(72.0)) / F.lit(100.0))
                - F.lit(0.10) * (F.col("dscr") - F.lit(1.35)), 0.02, 0.95)


def scorecard_lgd() -> Column:
    """LGD of the scorecard, rounded to 6 places."""
    return F.round(lgd_mean(), 6)


def build_portfolio(dim_loan: DataFrame, panel: DataFrame, ages: DataFrame | None = None) -> DataFrame:
    """One row per loan with observations (loans without any are dropped).

    ``default_flag`` draws from a loan-id hash against the scorecard PD, so
    the models have a signal; realised ``lgd`` is the scorecard LGD plus an
    id-based offset, NULL unless defaulted.
    """
    beh = behaviour_12m(panel, "dpd_raw" if "dpd_raw" in panel.columns else "dpd", ages)
    loans = dim_loan.select(
        "loan_id", "sector", "region", "credit_score",
        F.col("dti").cast("double").alias("dti"),
        F.col("ltv_orig").cast("double").alias("ltv"),
        F.col("dscr").cast("double").alias("dscr"),
        F.col("loan_amount").cast("double").alias("loan_amount"),
        F.col("interest_rate").cast("double").alias("interest_rate"),
        "term_months")
    j = loans.join(beh, "loan_id")
    j = j.withColumn("ead", ead_projection())
    j = j.withColumn("true_pd", scorecard_pd())
    u = (F.col("loan_id") * 7919 % 10007) / F.lit(10007.0)
    j = j.withColumn("default_flag", (u < F.col("true_pd")).cast("int"))
    offset = ((F.col("loan_id") * 31 % 101) - 50) / F.lit(1000.0)
    j = j.withColumn("lgd", F.when(F.col("default_flag") == 1,
                                   F.round(clip(lgd_mean() + offset, 0.01, 0.99), 6)))
    return j.select("loan_id", "sector", "region", "credit_score", "dti", "ltv", "dscr", "loan_amount",
                    "interest_rate", "term_months", "loan_age_months", "utilization",
                    "avg_utilization_12m", "max_utilization_12m", "utilization_trend",
                    "missed_payments_12m", "max_dpd_12m", "avg_dpd_12m", "current_dpd",
                    "ead", "true_pd", "default_flag", "lgd", "as_of_date")
