"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Queries of a session share one written mart per ``sf_dir``: the first one
derives and writes it (``mart_store.materialize_tpch``), the others scan its
tables. ``use_mart`` swaps in another mart (one from files, or a lazy plan);
``forget_marts`` drops them, as after source files have been rewritten.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import ecl as ecl_ops
from ..operators import drift, exposure, metrics, monitoring, panel, stress, watchlist
from ..operators import models as _models
from ..operators.portfolio import behaviour_12m, scorecard_lgd
from ..operators.score_index import build_index
from ..session import checkpoint_dir
from ..sources.mart_store import materialize_tpch
from ..sources.tpch_mart import Mart, fact_loan_monthly
from .summary import summary_rows

_MARTS: dict[tuple, Mart] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # remote session
        app = id(spark)
    return (app, sf_dir.rstrip("/"))


def get_mart(spark: SparkSession, sf_dir: str) -> Mart:
    k = _key(spark, sf_dir)
    if k not in _MARTS:
        _MARTS[k] = materialize_tpch(spark, sf_dir, DEFAULT)
    return _MARTS[k]


def use_mart(spark: SparkSession, sf_dir: str, mart: Mart) -> None:
    _MARTS[_key(spark, sf_dir)] = mart


def forget_marts() -> None:
    _MARTS.clear()


def _p(fn):
    return lambda spark, d: fn(get_mart(spark, d).fact_loan_monthly)


def _pc(fn):
    """Panel queries that look for hot loans unless the mart's cfg knows that there are none."""
    return lambda spark, d: fn(get_mart(spark, d).fact_loan_monthly, get_mart(spark, d).cfg)


def _pl(fn):
    return lambda spark, d: fn(get_mart(spark, d).fact_loan_monthly, get_mart(spark, d).dim_loan)


def _recent(fn, k, used=False):
    """Queries over each loan's last k observations: the panel without older periods."""
    return lambda spark, d: fn(fact_loan_monthly(get_mart(spark, d).recent(k, used)), get_mart(spark, d))


def _e(fn):
    return lambda spark, d: fn(get_mart(spark, d).fact_ecl)


def _reconcile(spark, d):
    m = get_mart(spark, d)
    return exposure.reconcile(m.fact_ecl, m.dim_scenario)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q1a_vintage_90plus": _pl(panel.vintage_90plus),
    "q1b_cumulative_bad": lambda spark, d: panel.cumulative_bad(get_mart(spark, d).fact_loan_monthly, get_mart(spark, d).dim_loan, get_mart(spark, d).cfg),
    "q2a_roll_matrix": _pc(panel.roll_matrix),
    "q2b_forward_cure": _pc(panel.forward_cure),
    "q3a_cohort_default": _pl(panel.cohort_default),
    "q3b_sector_index": _pl(panel.sector_default_index),
    "q4a_nco": _p(panel.net_charge_off),
    "q4b_loss_curve": _pl(panel.loss_curve),
    "q4c_realised_lgd": _pl(panel.realised_lgd),
    "q5a_util_trend": _p(panel.utilization_trend),
    "q5b_util_jump": _recent(lambda p, m: panel.utilization_jump(p, m.dim_loan), 4, used=True),
    "q6a_sector_exposure": _e(exposure.sector_exposure),
    "q6b_hhi": _e(exposure.hhi_by_dimension),
    "q6c_single_name": _e(exposure.single_name),
    "q7a_stage_matrix": _pc(panel.stage_matrix),
    "q7b_stage_drift": _pc(panel.stage_drift),
    "q7c_stage_coverage": _e(exposure.stage_coverage),
    "q8a_watchlist": _recent(lambda p, m: watchlist.watchlist(p, m.dim_loan, m.fact_ecl), 6),
    "q8b_watch_rollup": _recent(lambda p, m: watchlist.watch_rollup(p, m.dim_loan, m.fact_ecl), 1),
    "q9a_allowance": _e(exposure.allowance),
    "q9b_stage_sector": _e(exposure.stage_sector),
    "q9c_reconcile": _reconcile,
    "q9d_top_ecl": _e(exposure.top_ecl),
}


# --- loan-level features, ECL engine, stress --------------------------------------


def _book(spark, d):
    return get_mart(spark, d).portfolio


def _loan_level(spark, d):
    return ecl_ops.scorecard_loan_level(_book(spark, d))


def _stress_base(spark, d):
    """Scorecard scores live on the same rows as the book: a projection, no joins."""
    return _book(spark, d).select("loan_id", "sector", "region", "ead", F.col("true_pd").alias("pd_hat"),
                                  scorecard_lgd().alias("lgd_hat"))


def pd_score_table(spark, d):
    """PD scorecard scores with the default label and a train/test split."""
    return _book(spark, d).select("loan_id", F.col("true_pd").alias("score"),
                                  F.col("default_flag").alias("label"), monitoring.hash_split().alias("split"))


def _test_scores(spark, d):
    return pd_score_table(spark, d).filter(F.col("split") == "test")


def _lgd_pred(spark, d):
    b = _book(spark, d)
    return b.filter(F.col("default_flag") == 1).filter(monitoring.hash_split() == "test").select(
        "loan_id", "sector", F.col("lgd").alias("actual"), scorecard_lgd().alias("predicted"))


def score_index(spark, d):
    """The stored index of the PD scorecard's scores (built once per mart)."""
    indexes = get_mart(spark, d).score_indexes
    if "pd_scorecard" not in indexes:
        indexes["pd_scorecard"] = build_index(pd_score_table(spark, d))
    return indexes["pd_scorecard"]


def _panel_drift(spark, d):
    """Stability of panel features in every month after the first year, against that year's stored histograms."""
    m = get_mart(spark, d)
    if "panel" not in m.baselines:
        first = m.fact_loan_monthly.agg(F.min("snapshot_month")).first()[0]        # one date
        base = drift.make_baseline(m.between_months(first, F.add_months(F.lit(first), 11)))
        path = base.save(f"{checkpoint_dir(spark).rstrip('/')}/riskloom-baseline-{uuid.uuid4().hex[:12]}")
        m.baselines["panel"] = (first, drift.load_baseline(spark, path))
    first, base = m.baselines["panel"]
    later = m.fact_loan_monthly.where(F.col("snapshot_month") > F.add_months(F.lit(first), 11))
    return base.psi(base.histogram(later, ("snapshot_month",)), ("snapshot_month",)).select("snapshot_month", "feature", "psi").orderBy("snapshot_month", "feature")


def _ews_target(spark, d):
    b = _book(spark, d)
    ev = ((F.col("current_dpd") >= 30) | (F.col("default_flag") == 1)).cast("long")
    return b.agg(F.count(F.lit(1)).alias("n"), F.sum(ev).alias("events")).select(
        F.col("n").cast("long"), F.col("events").cast("long"),
        metrics.ratio_round("events", "n", 6).alias("event_rate"))


def _ews_watchlist(spark, d):
    b = _book(spark, d).select("loan_id", "sector", "region", "ead", "current_dpd", "missed_payments_12m",
                               "utilization_trend", "credit_score", F.col("true_pd").alias("ews_score"))
    return metrics.top_k_watchlist(b)


def _dq(spark, d):
    m = get_mart(spark, d)
    return monitoring.data_quality(m.dim_loan, m.fact_loan_monthly, m.portfolio, m.fact_ecl)


def _lgd_scorecard(spark, d):
    return _book(spark, d).select("loan_id", "sector", "default_flag", "lgd", scorecard_lgd().alias("lgd_hat"))


def _sel(fn, *cols):
    """Projection given as SQL expression strings (no Column objects at import time)."""
    return lambda spark, d: fn(spark, d).selectExpr(*cols)


_MORE = {
    "s9_fact_ecl": lambda spark, d: get_mart(spark, d).fact_ecl,
    "s10_behaviour_12m": lambda spark, d: behaviour_12m(get_mart(spark, d).recent(12), "dpd_raw", get_mart(spark, d).loan_index),
    "s11_ead": _sel(_book, "loan_id", "loan_amount", "loan_age_months", "term_months", "utilization", "ead"),
    "s12_pd_scorecard": _sel(_book, "loan_id", "sector", "true_pd", "default_flag"),
    "s13_lgd_scorecard": _lgd_scorecard,
    "e1_lifetime_pd": _sel(_loan_level, "loan_id", "pd_hat AS pd_12m", "pd_lifetime"),
    "e2_stage": _sel(_loan_level, "loan_id", "pd_hat AS pd_12m", "current_dpd", "default_flag", "stage"),
    "e3_discount": _sel(_loan_level, "loan_id", "stage", "discount_factor"),
    "e4_ecl_loan": _sel(_loan_level, "loan_id", "sector", "region", "ead", "current_dpd", "default_flag", "pd_hat",
                        "lgd_hat", "stage", "discount_factor", "ecl_base", "ecl_downside", "ecl_severe",
                        "ecl_weighted", "effective_pd_base", "coverage_ratio"),
    "e5_ecl_by_stage": lambda spark, d: ecl_ops.ecl_by_stage(_loan_level(spark, d)),
    "e6_ecl_by_scenario": lambda spark, d: ecl_ops.ecl_by_scenario(_loan_level(spark, d),
                                                                   get_mart(spark, d).dim_scenario),
    "e7_ecl_portfolio": lambda spark, d: ecl_ops.ecl_portfolio(_loan_level(spark, d)),
    "t1_scenario_loss": lambda spark, d: stress.scenario_loss(_stress_base(spark, d), get_mart(spark, d).dim_scenario),
    "t2_concentration": lambda spark, d: stress.concentration(_stress_base(spark, d)),
    "t3_concentration_metrics": lambda spark, d: stress.concentration_metrics(stress.concentration(_stress_base(spark, d))),
    "t4_sensitivity": lambda spark, d: stress.sensitivity(_stress_base(spark, d)),
    "m6_auc_exact": lambda spark, d: score_index(spark, d).auc(),
    "m7_average_precision": lambda spark, d: score_index(spark, d).average_precision(),
    "m8_roc_points": lambda spark, d: score_index(spark, d).roc_points(),
    "m8_pr_points": lambda spark, d: score_index(spark, d).pr_points(),
    "m9_score_bands": lambda spark, d: metrics.score_bands(_test_scores(spark, d)),
    "m10_brier": lambda spark, d: metrics.brier(_test_scores(spark, d)),
    "m11_confusion": lambda spark, d: metrics.confusion(_test_scores(spark, d)),
    "m12_calibration_bins": lambda spark, d: metrics.calibration_bins(_test_scores(spark, d)),
    "m14_regression_metrics": lambda spark, d: metrics.regression_metrics(_lgd_pred(spark, d)),
    "m15_lgd_segment_errors": lambda spark, d: metrics.segment_errors(_lgd_pred(spark, d)),
    "m18_ews_target": _ews_target,
    "m20_top_decile_capture": lambda spark, d: score_index(spark, d).capture(_test_scores(spark, d)),
    "m21_ews_watchlist": _ews_watchlist,
    "v1_psi_band": lambda spark, d: score_index(spark, d).psi(),
    "v2_psi_feature": lambda spark, d: monitoring.psi_features(
        _book(spark, d).withColumn("split", monitoring.hash_split())),
    "v2_psi_months": _panel_drift,
    "v3_band_calibration": lambda spark, d: monitoring.band_calibration(metrics.score_bands(_test_scores(spark, d))),
    "v4_monitor_triggers": lambda spark, d: monitoring.monitor_triggers(score_index(spark, d).monitor_metrics()),
    "v5_hosmer_lemeshow": lambda spark, d: monitoring.hosmer_lemeshow(_test_scores(spark, d)),
    "v5b_binomial_light": lambda spark, d: monitoring.binomial_light(_test_scores(spark, d)),
    "v6_data_quality": _dq,
}


def normalized(df: DataFrame) -> DataFrame:
    """End every query with BIGINT / DOUBLE / VARCHAR / DATE columns."""
    from pyspark.sql import types as T  # noqa: N812
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _wrap(fn):
    return lambda spark, d: normalized(fn(spark, d))


QUERIES.update({k: _wrap(v) for k, v in _MORE.items()})


# --- model fits (rows-only checks; fitted once per session and table folder) ---------------

_FITS: dict[tuple, object] = {}

# keys whose callable fits a model (rows-only checks; no oracle SQL)
MODEL_KEYS = frozenset({"m3_m5_pd_models", "m17_pd_score_book", "m13_lgd_gbt", "m15_lgd_model_segment_errors",
                        "m16_permutation_importance", "m19_ews_gbt", "m21_ews_model_watchlist", "risk_batch_job"})
# the keys among them that trigger a fit (the others reuse it)
FIT_KEYS = frozenset({"m3_m5_pd_models", "m13_lgd_gbt", "m19_ews_gbt", "risk_batch_job"})


def forget_fits() -> None:
    _FITS.clear()


def _fit(kind: str, spark, d):
    k = (kind,) + _key(spark, d)
    if k not in _FITS:
        book = _book(spark, d)
        if kind == "pd":
            _FITS[k] = _models.train_pd(book, _models.FitParams())
        elif kind == "lgd":
            _FITS[k] = _models.train_lgd(book, _models.FitParams())
        elif kind == "ews":
            _FITS[k] = _models.train_ews(book, _models.FitParams())
        elif kind == "job":
            from .job import run_risk_job, written_outputs
            # reuse the three model fits when this session already made them
            have = [("pd",) + _key(spark, d), ("lgd",) + _key(spark, d), ("ews",) + _key(spark, d)]
            fitted = tuple(_FITS[h] for h in have) if all(h in _FITS for h in have) else None
            out_dir = f"{checkpoint_dir(spark).rstrip('/')}/risk-job-{uuid.uuid4().hex[:12]}"
            run_risk_job(spark, d, out_dir, _models.FitParams(), mart=get_mart(spark, d), fitted=fitted)
            _FITS[k] = written_outputs(spark, out_dir)
    return _FITS[k]


def _split_counts(spark, d):
    b = monitoring.exact_stratified_split(_book(spark, d).select("loan_id", "default_flag"), "default_flag")
    return b.groupBy("split", F.col("default_flag").alias("label")).agg(F.count(F.lit(1)).alias("n_loans")) \
        .orderBy("split", "label")


def _summary(spark, d):
    """The summary's tables on the fixed scorecards (those of fitted models are outputs of the batch job)."""
    q = QUERIES
    return summary_rows({"score_bands": q["m9_score_bands"](spark, d), "lgd_segment_errors": q["m15_lgd_segment_errors"](spark, d), "ecl_by_stage": q["e5_ecl_by_stage"](spark, d),
                         "ecl_by_scenario": q["e6_ecl_by_scenario"](spark, d), "stress_scenarios": q["t1_scenario_loss"](spark, d),
                         "stress_sensitivity": q["t4_sensitivity"](spark, d), "watchlist_top10": q["m21_ews_watchlist"](spark, d).where("rank <= 10")})


def _split_models(spark, d):
    """The test and train rows of the three fits: number and sum of ids per stratum."""
    b = _book(spark, d).select("loan_id", "default_flag", _models.ews_target().alias("ews_target"))
    parts = []
    for model, rows, stratum in (("pd", b, "default_flag"), ("lgd", b.filter(F.col("default_flag") == 1), "default_flag"), ("ews", b, "ews_target")):
        s = monitoring.exact_stratified_split(rows.select("loan_id", F.col(stratum).alias("stratum")), "stratum")
        parts.append(s.select(F.lit(model).alias("model"), "stratum", "split", "loan_id"))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("model", "stratum", "split").agg(F.count(F.lit(1)).alias("n_loans"), F.sum("loan_id").alias("id_sum")).orderBy("model", "stratum", "split")


QUERIES.update({k: _wrap(v) for k, v in {
    "m1_split": _split_counts,
    "m1_split_models": _split_models,
    "summary_tables": _summary,
    "m3_m5_pd_models": lambda spark, d: _fit("pd", spark, d).metrics,
    "m17_pd_score_book": lambda spark, d: _fit("pd", spark, d).scored,
    "m13_lgd_gbt": lambda spark, d: _fit("lgd", spark, d).metrics,
    "m15_lgd_model_segment_errors": lambda spark, d: _fit("lgd", spark, d).segment_errors,
    "m16_permutation_importance": lambda spark, d: _fit("lgd", spark, d).importance,
    "m19_ews_gbt": lambda spark, d: _fit("ews", spark, d).metrics,
    "m21_ews_model_watchlist": lambda spark, d: _fit("ews", spark, d).watchlist,
    "risk_batch_job": lambda spark, d: _fit("job", spark, d),
}.items()})
