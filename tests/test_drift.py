"""Stored baselines, merged histograms and months against them."""
import datetime as dt
import tempfile

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import drift
from riskloom.operators.panel import cumulative_bad
from riskloom.config import RiskConfig
from tests.test_mart_layout import _mart
from riskloom.sources.mart_store import materialize


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _np_psi(base, now):
    edges = np.quantile(base, np.arange(1, 10) / 10)
    e, a = (np.bincount(np.searchsorted(edges, v, side="left"), minlength=10) / len(v) for v in (base, now))
    both = (e > 0) & (a > 0)
    return round(float(((a - e) * np.log(np.where(both, a, 1) / np.where(both, e, 1)))[both].sum()), 4)


def test_month_against_a_saved_baseline(spark):
    mart = materialize(_mart(spark), buckets=2, rows_per_file=40)
    year = mart.between_months(dt.date(2019, 1, 1), dt.date(2019, 12, 1))
    base = drift.load_baseline(spark, drift.make_baseline(year).save(tempfile.mkdtemp(prefix="riskloom-base-")))
    month = mart.between_months(dt.date(2021, 5, 1), dt.date(2021, 5, 1))
    counts = base.histogram(month)
    assert "PartitionFilters: [isnotnull(period" in counts._jdf.queryExecution().executedPlan().toString()
    want = {f: _np_psi(*(np.array([float(r[0]) for r in rows.where(F.col(f).isNotNull()).select(f).collect()]) for rows in (year, month))) for f in drift.PANEL_FEATURES if month.where(F.col(f).isNotNull()).count()}
    assert {r["feature"]: r["psi"] for r in base.psi(counts).collect()} == want and want


def test_histograms_merge(spark):
    mart = _mart(spark)
    panel = mart.fact_loan_monthly
    base = drift.make_baseline(panel.where("months_on_book < 12"))
    parts = [base.histogram(panel.where(F.col("months_on_book") % 3 == k)) for k in range(3)]
    assert _rows(drift.merge_histograms(*parts).select("feature", "bin", "n")) == _rows(base.histogram(panel).select("feature", "bin", "n"))
    # a baseline against itself has drifted nowhere; an empty month has no index
    assert {r["psi"] for r in base.psi(base.counts).collect()} == {0.0}
    assert base.psi(base.histogram(panel.limit(0))).count() == 0


def test_cumulative_bad_reads_the_panel_once(spark):
    mart = materialize(_mart(spark), buckets=2)
    one = cumulative_bad(mart.fact_loan_monthly, mart.dim_loan, mart.cfg)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "Exchange hashpartitioning(loan_id" not in plan     # panel and loans
    repeated = mart.fact_loan_monthly.unionByName(mart.fact_loan_monthly.where("loan_id % 3 = 0"))       # repeated months
    hot = RiskConfig(hot_key_rows=10)
    for rows in (mart.fact_loan_monthly, repeated):
        assert _rows(cumulative_bad(rows, mart.dim_loan, mart.cfg)) == _rows(cumulative_bad(rows, mart.dim_loan, hot))
