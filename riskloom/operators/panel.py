"""Loan-month panel analytics: vintages, roll rates, cohorts, losses,
utilisation and stage migration.

Inputs are the mart tables: ``panel`` = fact_loan_monthly, ``loans`` =
dim_loan. Every function returns a DataFrame with explicitly typed,
named columns, ordered as the report reads.

Plan notes
- Per-loan "previous observation" uses ``with_prior`` (lag window, hot
  keys split off); per-loan "ever" flags use a per-loan aggregate joined
  back instead of a running window; top-k per loan relies on the partial
  WindowGroupLimit.
- Windows without partition keys only run over already aggregated rows
  (a few per month, bucket or vintage).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..functions.columns import bucket_severity, is_90plus, ratio_round, score_band, vintage_label
from .sequence import hot_keys, top_k_per_key, with_prior


def _vintages(loans: DataFrame) -> DataFrame:
    return loans.select("loan_id", vintage_label("origination_date").alias("vintage"))


def _d(c) -> F.Column:
    return F.col(c).cast("double")


# --- 1. vintage curves ---------------------------------------------------------

def vintage_90plus(panel: DataFrame, loans: DataFrame) -> DataFrame:
    """q1a: 90+ rate by origination quarter and months on book."""
    m = panel.select("loan_id", "months_on_book", is_90plus("dpd", "dpd_bucket").alias("_bad"))
    g = m.join(_vintages(loans), "loan_id").groupBy("vintage", "months_on_book").agg(
        F.count(F.lit(1)).alias("loans_observed"), F.sum("_bad").alias("loans_90plus"))
    return g.select(
        "vintage", F.col("months_on_book").cast("long"), F.col("loans_observed").cast("long"),
        F.col("loans_90plus").cast("long"),
        ratio_round("loans_90plus", "loans_observed", 4).alias("rate_90plus"),
    ).orderBy("vintage", "months_on_book")


def cumulative_bad(panel: DataFrame, loans: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """q1b: share of a cohort that has ever been 90+ by each age.

    One scan of the panel in loan and age order carries a flag from the loan's first bad age on, and counts a loan at the first
    of its rows of an age. With hot loans the flag is ``age >= first bad age``, a per-loan aggregate joined back,
    and loans are counted distinct.
    """
    m = panel.select("loan_id", "months_on_book", is_90plus("dpd", "dpd_bucket").alias("_bad"))
    if hot_keys(m, "loan_id", cfg) is None:
        by_age = Window.partitionBy("loan_id").orderBy("months_on_book")       # ties in age share the flag (RANGE)
        first = ~F.lag("months_on_book").over(by_age).eqNullSafe(F.col("months_on_book")) | (F.row_number().over(by_age) == 1)
        flagged = m.select("loan_id", "months_on_book", F.max("_bad").over(by_age).alias("_ever"), first.cast("int").alias("_first"))
        cohort = F.sum("_first")
    else:
        first_bad = m.groupBy("loan_id").agg(
            F.min(F.when(F.col("_bad") == 1, F.col("months_on_book"))).alias("_first_bad"))
        flagged = m.join(first_bad, "loan_id").withColumn(
            "_ever", F.when(F.col("months_on_book") >= F.col("_first_bad"), 1).otherwise(0))
        cohort = F.countDistinct("loan_id")
    g = flagged.join(_vintages(loans), "loan_id").groupBy("vintage", "months_on_book").agg(
        cohort.alias("cohort_size"), F.sum("_ever").alias("_ever_n"), F.count(F.lit(1)).alias("_n"))
    return g.select(
        "vintage", F.col("months_on_book").cast("long"), F.col("cohort_size").cast("long"),
        ratio_round("_ever_n", "_n", 4).alias("cumulative_bad_rate"),
    ).orderBy("vintage", "months_on_book")


# --- 2. roll rates ---------------------------------------------------------------

def _gap(calendar: bool, months: int = 1):
    return months if calendar else None


def roll_matrix(panel: DataFrame, cfg: RiskConfig = DEFAULT, calendar: bool = False) -> DataFrame:
    """q2a: bucket-to-bucket transition counts and rates.

    "Last month" is the prior observation (as the reference); with
    ``calendar=True`` only observations exactly one month apart count.
    """
    t = with_prior(panel.select("loan_id", "snapshot_month", "dpd_bucket"), "loan_id", "snapshot_month",
                   {"dpd_bucket": "from_bucket"}, cfg, _gap(calendar))
    g = t.filter(F.col("from_bucket").isNotNull()).groupBy("from_bucket", F.col("dpd_bucket").alias("to_bucket")) \
        .agg(F.count(F.lit(1)).alias("n_loans"))
    row_total = F.sum("n_loans").over(Window.partitionBy("from_bucket"))
    return g.select(
        "from_bucket", "to_bucket", F.col("n_loans").cast("long"),
        ratio_round(F.col("n_loans"), row_total, 4).alias("roll_rate"),
    ).orderBy(bucket_severity("from_bucket"), bucket_severity("to_bucket"))


def forward_cure(panel: DataFrame, cfg: RiskConfig = DEFAULT, calendar: bool = False) -> DataFrame:
    """q2b: monthly forward-roll and cure rates of last month's delinquent loans."""
    sev = panel.select("loan_id", "snapshot_month", bucket_severity("dpd_bucket").alias("to_sev"))
    t = with_prior(sev, "loan_id", "snapshot_month", {"to_sev": "from_sev"}, cfg, _gap(calendar))
    t = t.filter(F.col("from_sev").isNotNull() & F.col("from_sev").between(1, 4))
    g = t.groupBy("snapshot_month").agg(
        F.count(F.lit(1)).alias("delinquent_loans"),
        F.count_if(F.col("to_sev") > F.col("from_sev")).alias("_fwd"),
        F.count_if(F.col("to_sev") < F.col("from_sev")).alias("_cure"))
    return g.select(
        "snapshot_month", F.col("delinquent_loans").cast("long"),
        ratio_round("_fwd", "delinquent_loans", 4).alias("forward_roll_rate"),
        ratio_round("_cure", "delinquent_loans", 4).alias("cure_rate"),
    ).orderBy("snapshot_month")


# --- 3. cohort default rates -----------------------------------------------------

def _loan_defaulted(panel: DataFrame) -> DataFrame:
    return panel.groupBy("loan_id").agg(F.max(is_90plus("dpd", "dpd_bucket")).alias("defaulted"))


def cohort_default(panel: DataFrame, loans: DataFrame) -> DataFrame:
    """q3a: default rate (ever 90+ or charged off) by vintage and score band."""
    ld = loans.select("loan_id", "origination_date", "credit_score").join(_loan_defaulted(panel), "loan_id")
    g = ld.groupBy(vintage_label("origination_date").alias("vintage"),
                   score_band("credit_score").alias("score_band")).agg(
        F.count(F.lit(1)).alias("loans"), F.sum("defaulted").alias("defaults"))
    return g.select(
        "vintage", "score_band", F.col("loans").cast("long"), F.col("defaults").cast("long"),
        ratio_round("defaults", "loans", 4).alias("default_rate"),
    ).orderBy("vintage", "score_band")


def sector_default_index(panel: DataFrame, loans: DataFrame, weighted: bool = False) -> DataFrame:
    """q3b: default rate by sector, the book rate and each sector's index.

    The book rate is the unweighted mean of sector rates (as the reference
    computes it); ``weighted=True`` uses total defaults / total loans.
    """
    ld = loans.select("loan_id", "sector").join(_loan_defaulted(panel), "loan_id")
    g = ld.groupBy("sector").agg(F.count(F.lit(1)).alias("loans"), F.sum("defaulted").alias("defaults"))
    rate = F.col("defaults") / F.col("loans")
    everything = Window.partitionBy()  # over the handful of sector rows only
    book = (F.sum("defaults").over(everything) / F.sum("loans").over(everything)) if weighted \
        else F.avg(rate).over(everything)
    g = g.withColumn("_rate", rate).withColumn("_book", book)
    return g.select(
        "sector", F.col("loans").cast("long"), F.col("defaults").cast("long"),
        ratio_round("defaults", "loans", 4).alias("default_rate"),
        F.round("_book", 4).alias("portfolio_default_rate"),
        F.round(F.try_divide(F.col("_rate"), F.when(F.col("_book") != 0, F.col("_book"))), 2).alias("default_rate_index"),
    ).orderBy(F.desc("default_rate"), "sector")


# --- 4. charge-offs and losses ---------------------------------------------------

def net_charge_off(panel: DataFrame) -> DataFrame:
    """q4a: monthly gross charge-off, recoveries, net, ending balance, annualised NCO rate."""
    g = panel.groupBy("snapshot_month").agg(
        F.sum("charge_off_amount").alias("gross_charge_off"),
        F.sum("recovery_amount").alias("recoveries"),
        F.sum(F.col("charge_off_amount") - F.col("recovery_amount")).alias("net_charge_off"),
        F.sum("outstanding_balance").alias("ending_balance"))
    rate = F.lit(12.0) * _d("net_charge_off") / F.when(F.col("ending_balance") != 0, _d("ending_balance"))
    return g.select(
        "snapshot_month", _d("gross_charge_off").alias("gross_charge_off"), _d("recoveries").alias("recoveries"),
        _d("net_charge_off").alias("net_charge_off"), _d("ending_balance").alias("ending_balance"),
        F.round(rate, 4).alias("annualised_nco_rate"),
    ).orderBy("snapshot_month")


def loss_curve(panel: DataFrame, loans: DataFrame) -> DataFrame:
    """q4b: cumulative net loss by vintage and age over the vintage's booked balance.

    One aggregate gives both the monthly net loss and the age-0 balance;
    vintages without an age-0 row are dropped (the reference's inner join).
    """
    m = panel.select("loan_id", "months_on_book", "outstanding_balance", "charge_off_amount", "recovery_amount")
    g = m.join(_vintages(loans), "loan_id").groupBy("vintage", "months_on_book").agg(
        F.sum(F.col("charge_off_amount") - F.col("recovery_amount")).alias("net_loss"),
        F.sum(F.when(F.col("months_on_book") == 0, F.col("outstanding_balance"))).alias("_booked_part"))
    per_vintage = Window.partitionBy("vintage")  # one row per age of the vintage
    g = g.withColumn("_booked", F.sum("_booked_part").over(per_vintage)) \
        .withColumn("cumulative_net_loss", F.sum("net_loss").over(per_vintage.orderBy("months_on_book"))) \
        .filter(F.col("_booked").isNotNull())
    rate = _d("cumulative_net_loss") / F.when(F.col("_booked") != 0, _d("_booked"))
    return g.select(
        "vintage", F.col("months_on_book").cast("long"), _d("net_loss").alias("net_loss"),
        _d("cumulative_net_loss").alias("cumulative_net_loss"), F.round(rate, 4).alias("cumulative_loss_rate"),
    ).orderBy("vintage", "months_on_book")


def realised_lgd(panel: DataFrame, loans: DataFrame) -> DataFrame:
    """q4c: 1 - recoveries / charged-off exposure, by sector."""
    co = panel.filter(F.col("is_charged_off") == 1).select("loan_id", "charge_off_amount", "recovery_amount")
    g = co.join(loans.select("loan_id", "sector"), "loan_id").groupBy("sector").agg(
        F.count(F.lit(1)).alias("charge_off_events"),
        F.sum("charge_off_amount").alias("charged_off_exposure"),
        F.sum("recovery_amount").alias("recoveries"))
    lgd = F.lit(1.0) - _d("recoveries") / F.when(F.col("charged_off_exposure") != 0, _d("charged_off_exposure"))
    return g.select(
        "sector", F.col("charge_off_events").cast("long"), _d("charged_off_exposure").alias("charged_off_exposure"),
        _d("recoveries").alias("recoveries"), F.round(lgd, 4).alias("realised_lgd"),
    ).orderBy(F.desc("realised_lgd"), "sector")


# --- 5. utilisation ----------------------------------------------------------------

def utilization_trend(panel: DataFrame) -> DataFrame:
    """q5a: monthly mean utilisation, share >= 80, 3-month moving mean of the monthly mean."""
    u = panel.filter(F.col("utilization").isNotNull())
    g = u.groupBy("snapshot_month").agg(
        F.sum((F.col("utilization") * 100).cast("long")).alias("_cents"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("utilization") >= 80).alias("_high"))
    g = g.withColumn("_avg", _d("_cents") / (F.col("_n") * 100))
    moving = Window.orderBy("snapshot_month").rowsBetween(-2, 0)  # over the monthly rows only
    return g.select(
        "snapshot_month",
        ratio_round("_cents", F.col("_n") * 100, 2).alias("avg_utilization"),
        ratio_round("_high", "_n", 4).alias("pct_util_over_80"),
        F.round(F.avg("_avg").over(moving), 2).alias("util_3m_moving_avg"),
    ).orderBy("snapshot_month")


def utilization_jump(panel: DataFrame, loans: DataFrame, calendar: bool = False) -> DataFrame:
    """q5b: loans whose utilisation rose >= 10 points over the last 3 observations.

    Top-4 observations per loan (partial group limit before the shuffle),
    then one conditional aggregate instead of a self join of rank 1 and 4.
    With ``calendar=True`` the 4th-latest observation must be exactly three
    months before the latest.
    """
    u = panel.filter(F.col("utilization").isNotNull()).select("loan_id", "snapshot_month", "utilization")
    last4 = top_k_per_key(u, "loan_id", [F.desc("snapshot_month")], 4, "_rn")
    g = last4.groupBy("loan_id").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("utilization"))).alias("_now"),
        F.max(F.when(F.col("_rn") == 4, F.col("utilization"))).alias("_ago"),
        F.max(F.when(F.col("_rn") == 1, F.col("snapshot_month"))).alias("_m_now"),
        F.max(F.when(F.col("_rn") == 4, F.col("snapshot_month"))).alias("_m_ago"))
    g = g.filter(F.col("_ago").isNotNull())
    if calendar:
        g = g.filter(F.add_months(F.col("_m_ago"), 3) == F.col("_m_now"))
    g = g.withColumn("_delta", F.col("_now") - F.col("_ago")).filter(F.col("_delta") >= 10)
    j = g.join(loans.select("loan_id", "sector", "region"), "loan_id")
    flag = F.when(F.col("_delta") >= 20, F.lit("RISING_FAST")).when(F.col("_delta") >= 10, F.lit("RISING")) \
        .otherwise(F.lit("STABLE"))
    return j.select(
        F.col("loan_id").cast("long"), "sector", "region",
        F.round(_d("_ago"), 2).alias("util_3m_ago"), F.round(_d("_now"), 2).alias("util_now"),
        F.round(_d("_delta"), 2).alias("util_delta_3m"), flag.alias("util_trend_flag"),
    ).orderBy(F.desc("util_delta_3m"), "loan_id")


# --- 7. stage migration ------------------------------------------------------------

def _staged(panel: DataFrame, cfg: RiskConfig, calendar: bool = False) -> DataFrame:
    return with_prior(panel.select("loan_id", "snapshot_month", "ifrs9_stage", "outstanding_balance"),
                      "loan_id", "snapshot_month", {"ifrs9_stage": "prev_stage"}, cfg, _gap(calendar))


def stage_matrix(panel: DataFrame, cfg: RiskConfig = DEFAULT, calendar: bool = False) -> DataFrame:
    """q7a: stage transition counts, rates and balance moved."""
    s = _staged(panel, cfg, calendar).filter(F.col("prev_stage").isNotNull())
    g = s.groupBy(F.col("prev_stage").alias("from_stage"), F.col("ifrs9_stage").alias("to_stage")).agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum("outstanding_balance").alias("exposure_moved"))
    row_total = F.sum("n_loans").over(Window.partitionBy("from_stage"))
    return g.select(
        F.col("from_stage").cast("long"), F.col("to_stage").cast("long"), F.col("n_loans").cast("long"),
        ratio_round(F.col("n_loans"), row_total, 4).alias("transition_rate"),
        _d("exposure_moved").alias("exposure_moved"),
    ).orderBy("from_stage", "to_stage")


def stage_drift(panel: DataFrame, cfg: RiskConfig = DEFAULT, calendar: bool = False) -> DataFrame:
    """q7b: moves into and out of each stage; always stages 1, 2, 3.

    Each move is unpivoted into (to-stage, in) and (from-stage, out) and
    counted in one aggregate, then joined to the 3-row stage list.
    """
    moves = _staged(panel, cfg, calendar).filter(F.col("prev_stage").isNotNull() & (F.col("prev_stage") != F.col("ifrs9_stage")))
    legs = moves.select(F.explode(F.array(
        F.struct(F.col("ifrs9_stage").alias("stage"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        F.struct(F.col("prev_stage").alias("stage"), F.lit(0).alias("i"), F.lit(1).alias("o")))).alias("leg"))
    flows = legs.groupBy(F.col("leg.stage").alias("stage")).agg(
        F.sum("leg.i").alias("moved_in"), F.sum("leg.o").alias("moved_out"))
    stages = panel.sparkSession.createDataFrame([(1,), (2,), (3,)], "stage int")
    j = stages.join(flows, "stage", "left")
    mi, mo = F.coalesce(F.col("moved_in"), F.lit(0)), F.coalesce(F.col("moved_out"), F.lit(0))
    return j.select(F.col("stage").cast("long"), mi.cast("long").alias("moved_in"),
                    mo.cast("long").alias("moved_out"), (mi - mo).cast("long").alias("net_flow")).orderBy("stage")
