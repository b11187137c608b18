"""The written panel: periods and buckets at once, run-time pruning, indexes."""
import datetime
import os

import pytest
from pyspark.sql import functions as F

from riskloom.config import RiskConfig
from riskloom.operators.panel import net_charge_off, roll_matrix, utilization_jump
from riskloom.operators.portfolio import behaviour_12m
from riskloom.operators.watchlist import watch_rollup, watchlist
from riskloom.plans.registry import QUERIES
from riskloom.schemas import DIM_LOAN, FACT_LOAN_MONTHLY
from riskloom.sources.mart_store import materialize
from riskloom.sources.tpch_mart import Mart, scenario_frame
from tests.conftest import SF001

MONTHS, LOANS, BUCKETS = 48, 60, 4


def _mart(spark, cfg=RiskConfig(), hot=0) -> Mart:
    """Loans that report until the last month (some closed earlier), without utilisation in some months; ``hot`` more rows of loan 1."""
    rows = spark.range(LOANS).select(F.col("id").alias("loan_id"), F.explode(F.sequence(F.lit(0), F.lit(MONTHS - 1))).alias("m"))
    rows = rows.where((F.col("loan_id") % 20 != 7) | (F.col("m") < MONTHS - 4))
    if hot:
        rows = rows.unionByName(spark.range(hot).select(F.lit(1).cast("long").alias("loan_id"), (F.col("id") % MONTHS).cast("int").alias("m")))
    dpd = ((F.col("loan_id") * 7 + F.col("m") * 5) % 97).cast("int")
    values = {
        "snapshot_month": F.add_months(F.lit(datetime.date(2019, 1, 1)), F.col("m")), "months_on_book": F.col("m"), "outstanding_balance": 1000 + F.col("m"),
        "scheduled_payment": F.lit(10), "dpd": dpd, "dpd_bucket": F.when(dpd < 30, "Current").when(dpd < 60, "30-59").when(dpd < 90, "60-89").otherwise("90+"),
        "utilization": F.when(F.col("m") % 3 != 2, (F.col("loan_id") * 13 + F.col("m") * 29) % 100), "ifrs9_stage": F.when(dpd >= 90, 3).when(dpd >= 30, 2).otherwise(1),
        "is_charged_off": F.lit(0), "charge_off_amount": F.col("m"), "recovery_amount": F.lit(0), "loan_id": F.col("loan_id")}
    panel = rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in FACT_LOAN_MONTHLY.fields]).withColumn("dpd_raw", F.col("dpd"))
    loan = {"loan_id": F.col("id"), "origination_date": F.lit(datetime.date(2019, 1, 1)), "sector": F.element_at(F.array(F.lit("Industrial"), F.lit("Residential")), (F.col("id") % 2 + 1).cast("int")),
            "region": F.lit("R"), "credit_score": 520 + F.col("id"), "dti": F.lit(30), "ltv_orig": F.lit(70), "dscr": F.lit(1.2), "loan_amount": F.lit(1000), "interest_rate": F.lit(5), "term_months": F.lit(120)}
    loans = spark.range(LOANS).select(*[loan[f.name].cast(f.dataType).alias(f.name) for f in DIM_LOAN.fields])
    return Mart(dim_loan=loans, fact_loan_monthly=panel.drop("dpd_raw"), panel_raw=panel, dim_scenario=scenario_frame(spark, cfg), cfg=cfg)


@pytest.fixture(scope="module")
def lazy(spark):
    return _mart(spark)


@pytest.fixture(scope="module")
def written(spark, lazy):
    return materialize(lazy, buckets=BUCKETS, rows_per_file=40)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_file_count_is_bounded(written, lazy, spark):
    periods = written.periods.count()
    assert periods == MONTHS // 3     # 2,700 rows at 40 a file and 4 buckets: quarters
    assert len(written.panel_raw.inputFiles()) <= periods * BUCKETS
    one = materialize(lazy, buckets=BUCKETS, max_files=BUCKETS)
    assert one.periods.count() == 1 and len(one.panel_raw.inputFiles()) <= BUCKETS


def test_recent_reads_few_periods(written):
    got = written.recent(6).select("period").distinct().count()
    closed_early = 4      # loans closed 4 months before the end reach 10 months back
    assert got <= (6 + closed_early) // 3 + 2 < written.periods.count()
    assert written.recent(4, used=True).select("period").distinct().count() < written.periods.count()


def test_last_k_results_are_those_of_the_whole_panel(written, lazy):
    from riskloom.sources.tpch_mart import fact_loan_monthly as twelve
    for k, used, fn in ((6, False, lambda p, m: watchlist(p, m.dim_loan, written.fact_ecl)), (1, False, lambda p, m: watch_rollup(p, m.dim_loan, written.fact_ecl)),
                        (4, True, lambda p, m: utilization_jump(p, m.dim_loan))):
        assert _rows(fn(twelve(written.recent(k, used)), written)) == _rows(fn(lazy.fact_loan_monthly, lazy))
    assert _rows(behaviour_12m(written.recent(12), "dpd_raw", written.loan_index)) == _rows(behaviour_12m(lazy.panel_raw, "dpd_raw"))
    assert _rows(written.portfolio) == _rows(lazy.portfolio)


def test_plans_prune_at_run_time_and_keep_the_buckets(written, spark):
    from riskloom.operators.panel import utilization_jump as jump
    plans = [_plan(watchlist(written.recent(6), written.dim_loan, written.fact_ecl)), _plan(jump(written.recent(4, True), written.dim_loan)),
             _plan(behaviour_12m(written.recent(12), "dpd_raw", written.loan_index))]
    plans += [_plan(QUERIES[q](spark, SF001)) for q in ("q8a_watchlist", "q5b_util_jump", "s10_behaviour_12m")]
    for text in plans:
        assert "dynamicpruningexpression(period" in text and "Exchange hashpartitioning(loan_id" not in text
    assert "Exchange hashpartitioning(loan_id" not in _plan(roll_matrix(written.fact_loan_monthly, written.cfg))


def test_month_filter_reads_its_periods(written, lazy):
    first, last = datetime.date(2020, 2, 1), datetime.date(2020, 6, 1)
    got = written.between_months(first, last)
    want = lazy.fact_loan_monthly.where(F.col("snapshot_month").between(F.lit(first), F.lit(last)))
    assert _rows(got) == _rows(want) and got.count() > 0
    assert "PartitionFilters: [isnotnull(period" in _plan(got)
    assert _rows(net_charge_off(got)) == _rows(net_charge_off(want))
    assert _rows(lazy.between_months(first, last)) == _rows(want)


def test_hot_loan_keeps_the_periods_without_buckets(spark):
    cfg = RiskConfig(hot_key_rows=500)
    hot = _mart(spark, cfg, hot=2000)
    mart = materialize(hot, buckets=BUCKETS, rows_per_file=40)
    assert mart.periods is None and mart.cfg.hot_key_rows == 500
    assert any("period=" in os.path.dirname(f) for f in mart.panel_raw.inputFiles())
    assert _rows(mart.recent(6)) == _rows(mart.panel_raw)
    assert _rows(net_charge_off(mart.fact_loan_monthly)) == _rows(net_charge_off(hot.fact_loan_monthly))


def test_empty_panel(spark, lazy):
    empty = Mart(dim_loan=lazy.dim_loan, fact_loan_monthly=lazy.fact_loan_monthly.limit(0), panel_raw=lazy.panel_raw.limit(0), dim_scenario=lazy.dim_scenario, cfg=lazy.cfg)
    mart = materialize(empty, buckets=2)
    assert mart.recent(6).count() == 0 and mart.portfolio.count() == 0


def test_buckets_follow_the_rows(spark, mart, monkeypatch):
    """Without a given number a bucket holds a bounded number of rows, each table has one file per bucket (and period), and the rows are the same."""
    from riskloom.sources import mart_store
    monkeypatch.setattr(mart_store, "BUCKET_ROWS", 500)
    many = mart_store.materialize_tpch(spark, SF001)
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    n = -(-lines // 500)
    assert n > 8
    for name in ("panel_raw", "portfolio", "fact_ecl"):
        got, want = getattr(many, name), getattr(mart, name)
        cols = [c for c in want.columns if c != "period"]
        assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)
        buckets = [os.path.basename(f).split("_")[1].split(".")[0] for f in got.inputFiles()]
        assert max(map(int, buckets)) >= 8 and len(buckets) <= n * (1 if name != "panel_raw" else got.select("period").distinct().count())
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
