"""ECL engine on hand-made loans (identities of the reference tests)."""
import pytest
from pyspark.sql import functions as F

from riskloom.config import SCENARIOS
from riskloom.operators import ecl as E


def _book(spark, rows):
    return spark.createDataFrame(rows, "loan_id long, sector string, region string, ead double, current_dpd int, "
                                       "default_flag int")


def _scores(spark, ids, pd, lgd):
    return (spark.createDataFrame([(i, pd) for i in ids], "loan_id long, pd_hat double"),
            spark.createDataFrame([(i, lgd) for i in ids], "loan_id long, lgd_hat double"))


def test_single_stage1_loan(spark):
    book = _book(spark, [(1, "Residential", "Denver Metro", 100_000.0, 0, 0)])
    pd_hat, lgd_hat = _scores(spark, [1], 0.05, 0.40)
    row = E.compute_ecl(book, pd_hat, lgd_hat).first()
    assert row["stage"] == 1
    assert float(row["ecl_base"]) == pytest.approx(0.05 * 0.40 * 100_000.0 / 1.08, abs=0.005)
    assert float(row["ecl_base"]) == pytest.approx(1851.85, abs=0.005)


def test_stage3_uses_full_pd(spark):
    book = _book(spark, [(1, "Office CRE", "National", 100_000.0, 120, 1)])
    pd_hat, lgd_hat = _scores(spark, [1], 0.05, 0.50)
    row = E.compute_ecl(book, pd_hat, lgd_hat).first()
    assert row["stage"] == 3
    assert float(row["ecl_base"]) == pytest.approx(0.50 * 100_000.0 / 1.08 ** 2.5, abs=0.005)
    assert float(row["ecl_base"]) == pytest.approx(41248.73, abs=0.01)


def test_weighted_is_convex_blend(spark):
    ids = list(range(50))
    book = _book(spark, [(i, "Residential", "Denver Metro", 100_000.0, 0, 0) for i in ids])
    pd_hat, lgd_hat = _scores(spark, ids, 0.05, 0.40)
    ll = E.compute_ecl(book, pd_hat, lgd_hat)
    p = E.ecl_portfolio(ll).first()
    manual = sum(p[f"ecl_{n}"] * w for n, w, *_ in SCENARIOS)
    assert p["weighted_ecl"] == pytest.approx(manual, abs=0.01 * 50)
    assert p["ecl_base"] <= p["weighted_ecl"] <= p["ecl_severe"]
    assert (p["n_stage1"], p["n_stage2"], p["n_stage3"]) == (50, 0, 0)


def test_unscored_loans_are_dropped(spark):
    book = _book(spark, [(1, "Residential", "Denver Metro", 1000.0, 0, 0), (2, "Residential", "Denver Metro", 1.0, 0, 0)])
    pd_hat, lgd_hat = _scores(spark, [1], 0.05, 0.40)
    assert E.compute_ecl(book, pd_hat, lgd_hat).count() == 1


def test_by_stage_and_scenario(spark):
    book = _book(spark, [(1, "Residential", "Denver Metro", 1000.0, 0, 0), (2, "Retail CRE", "National", 2000.0, 95, 0)])
    pd_hat, lgd_hat = _scores(spark, [1, 2], 0.05, 0.40)
    ll = E.compute_ecl(book, pd_hat, lgd_hat)
    st = {r["stage"]: r for r in E.ecl_by_stage(ll).collect()}
    assert set(st) == {1, 3} and st[3]["avg_pd"] == 1.0
    sc = E.ecl_by_scenario(ll, __import__("riskloom.sources.tpch_mart", fromlist=["x"]).scenario_frame(spark))
    vals = {r["scenario"]: r["ecl"] for r in sc.collect()}
    assert vals["base"] < vals["downside"] < vals["severe"]


def test_zero_ead_has_null_coverage(spark):
    book = _book(spark, [(1, "Residential", "Denver Metro", 0.0, 0, 0)])
    pd_hat, lgd_hat = _scores(spark, [1], 0.05, 0.40)
    assert E.compute_ecl(book, pd_hat, lgd_hat).select(F.col("coverage_ratio")).first()[0] is None
