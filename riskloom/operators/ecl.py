"""Scenario-weighted expected credit loss (IFRS 9 staging).

ECL = effective PD x LGD x EAD x discount, per scenario, blended by the
scenario weights. Everything is one wide ``select`` over the loan rows (no
loop over rows, no fan-out), so the whole chain is a single codegen stage
after the joins on ``loan_id``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, RiskConfig
from ..functions.columns import (assign_stage, clip, discount_factor, effective_pd, lifetime_pd, money,
                                 ratio_round)
from .portfolio import scorecard_lgd

MONEY = T.DecimalType(14, 2)
PROB = T.DecimalType(9, 6)


def ecl_columns(base: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Add stage, discount, per-scenario and weighted ECL to rows that carry
    ``pd_hat``, ``lgd_hat``, ``ead``, ``current_dpd`` and ``default_flag``.

    Money columns are rounded to cents (DECIMAL(14,2)) so that sums are exact.
    """
    pd12 = F.col("pd_hat")
    df = base.withColumn("stage", assign_stage(pd12, "current_dpd", "default_flag", cfg)) \
        .withColumn("discount_factor", discount_factor("stage", cfg))
    weighted = None
    for name, weight, pd_mult, lgd_mult, *_ in cfg.scenarios:
        pd_s = clip(pd12 * F.lit(float(pd_mult)), 0.0, 1.0)
        eff = effective_pd("stage", pd_s, lifetime_pd(pd_s, cfg.lifetime_horizon_years))
        lgd_s = clip(F.col("lgd_hat") * F.lit(float(lgd_mult)), 0.0, 1.0)
        raw = eff * lgd_s * F.col("ead") * F.col("discount_factor")
        df = df.withColumn(f"_raw_{name}", raw)
        term = F.col(f"_raw_{name}") * F.lit(float(weight))
        weighted = term if weighted is None else weighted + term
    df = df.withColumn("_raw_weighted", weighted)
    for name in cfg.scenario_names:
        df = df.withColumn(f"ecl_{name}", money(F.col(f"_raw_{name}")))
    df = df.withColumn("ecl_weighted", money(F.col("_raw_weighted")))
    df = df.withColumn("pd_lifetime", F.round(lifetime_pd(pd12, cfg.lifetime_horizon_years), 6))
    df = df.withColumn("effective_pd_base", F.round(effective_pd("stage", pd12, F.col("pd_lifetime")), 6))
    df = df.withColumn("coverage_ratio", F.round(F.try_divide(F.col("_raw_weighted"),
                                                              F.when(F.col("ead") != 0, F.col("ead"))), 6))
    return df.drop(*[c for c in df.columns if c.startswith("_raw_")])


def compute_ecl(portfolio: DataFrame, pd_hat: DataFrame, lgd_hat: DataFrame,
                cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Loan-level ECL: portfolio joined to the two score frames on loan_id.

    Loans missing a score are dropped, as in an inner merge (see the
    ``v6_data_quality`` unscored count).
    """
    base = (portfolio.select("loan_id", "sector", "region", "ead", "current_dpd", "default_flag")
            .join(pd_hat.select("loan_id", "pd_hat"), "loan_id")
            .join(lgd_hat.select("loan_id", "lgd_hat"), "loan_id"))
    return ecl_columns(base, cfg)


def scorecard_loan_level(portfolio: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Loan-level ECL with the scorecard PD/LGD (no joins: same rows)."""
    base = portfolio.select("loan_id", "sector", "region", "ead", "current_dpd", "default_flag",
                            "as_of_date", F.col("true_pd").alias("pd_hat"), scorecard_lgd().alias("lgd_hat"))
    return ecl_columns(base, cfg)


def to_fact_ecl(loan_level: DataFrame, as_of=None) -> DataFrame:
    """Mart adapter: loan-level ECL output -> ``fact_ecl`` columns and types."""
    as_of_col = F.col("as_of_date") if as_of is None else F.lit(as_of).cast("date")
    return loan_level.select(
        F.col("loan_id").cast("long"),
        as_of_col.alias("as_of_date"),
        "sector", "region",
        F.col("ead").cast(MONEY).alias("ead"),
        F.col("pd_hat").cast(PROB).alias("pd_12m"),
        F.col("pd_lifetime").cast(PROB).alias("pd_lifetime"),
        F.col("lgd_hat").cast(PROB).alias("lgd"),
        F.col("current_dpd").cast("int"),
        F.col("stage").cast("int").alias("ifrs9_stage"),
        "ecl_base", "ecl_downside", "ecl_severe", "ecl_weighted",
        F.col("coverage_ratio").cast(PROB).alias("coverage_ratio"),
    )


def fact_ecl_from_portfolio(portfolio: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    return to_fact_ecl(scorecard_loan_level(portfolio, cfg))


# --- aggregations -----------------------------------------------------------

def ecl_by_stage(loan_level: DataFrame) -> DataFrame:
    """e5: count, EAD, ECL, mean effective PD, mean LGD, coverage per stage."""
    g = loan_level.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum(F.col("ead").cast(MONEY)).alias("ead"),
        F.sum("ecl_weighted").alias("ecl"),
        F.sum(F.round(F.col("effective_pd_base") * 1000000.0).cast("long")).alias("_pd_micro"),
        F.sum(F.round(F.col("lgd_hat") * 1000000.0).cast("long")).alias("_lgd_micro"))
    return g.select(
        F.col("stage").cast("long").alias("stage"),
        F.col("n_loans").cast("long"),
        F.col("ead").cast("double"),
        F.col("ecl").cast("double"),
        ratio_round("_pd_micro", F.col("n_loans") * 1000000, 6).alias("avg_pd"),
        ratio_round("_lgd_micro", F.col("n_loans") * 1000000, 6).alias("avg_lgd"),
        F.round(F.try_divide(F.col("ecl").cast("double"), F.col("ead").cast("double")), 6).alias("coverage_ratio"))


def ecl_by_scenario(loan_level: DataFrame, scenarios: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """e6: scenario, weight, total ECL (one aggregate, unpivoted, joined to the 3-row table)."""
    names = cfg.scenario_names
    totals = loan_level.agg(*[F.sum(f"ecl_{n}").alias(n) for n in names])
    stack = "stack({}, {}) as (scenario, ecl)".format(
        len(names), ", ".join(f"'{n}', `{n}`" for n in names))
    long = totals.selectExpr(stack)
    return long.join(F.broadcast(scenarios.select("scenario", "weight")), "scenario").select(
        "scenario", F.col("weight").cast("double").alias("weight"), F.col("ecl").cast("double").alias("ecl"))


def ecl_portfolio(loan_level: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """e7: one row of totals, coverage (0 when EAD is 0), scenario totals, stage counts."""
    g = loan_level.agg(
        F.sum(F.col("ead").cast(MONEY)).alias("total_ead"),
        F.sum("ecl_weighted").alias("weighted_ecl"),
        *[F.sum(f"ecl_{n}").alias(f"ecl_{n}") for n in cfg.scenario_names],
        *[F.count_if(F.col("stage") == s).alias(f"n_stage{s}") for s in (1, 2, 3)])
    cov = F.when(F.col("total_ead") != 0, F.col("weighted_ecl").cast("double") / F.col("total_ead").cast("double")) \
        .otherwise(F.lit(0.0))
    return g.select(
        F.col("total_ead").cast("double"), F.col("weighted_ecl").cast("double"),
        F.round(cov, 6).alias("coverage_ratio"),
        *[F.col(f"ecl_{n}").cast("double") for n in cfg.scenario_names],
        *[F.col(f"n_stage{s}").cast("long") for s in (1, 2, 3)])
