"""The mart spec reproduces the blueprint's own measured figures (sf0.01)."""
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ecl as E
from riskloom.operators import stress as S
from riskloom.operators.metrics import band_of
from riskloom.plans.registry import get_mart

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mart01(spark):
    return get_mart(spark, SF01)


def test_stage_counts_and_scenario_ecl(mart01):
    ll = E.scorecard_loan_level(mart01.portfolio)
    p = E.ecl_portfolio(ll).first()
    assert (p["n_stage1"], p["n_stage2"], p["n_stage3"]) == (6117, 3271, 5355)
    assert p["ecl_base"] == pytest.approx(424_556_058.33, abs=0.005)
    assert p["ecl_downside"] == pytest.approx(530_603_835.94, abs=0.005)
    assert p["ecl_severe"] == pytest.approx(664_617_545.18, abs=0.005)


def test_sector_hhi(mart01):
    b = mart01.portfolio.select("loan_id", "sector", "region", "ead", F.lit(0.1).alias("pd_hat"),
                                F.lit(0.4).alias("lgd_hat"))
    m = S.concentration_metrics(S.concentration(b)).first()
    assert m["sector_hhi"] == 0.200152


def test_pd_bands_whole_book(mart01):
    rows = mart01.portfolio.groupBy(band_of("true_pd").alias("band")).agg(
        F.round(F.avg("true_pd"), 4).alias("pd"), F.round(F.avg("default_flag"), 4).alias("obs")).collect()
    got = {r["band"][0]: (r["pd"], r["obs"]) for r in rows}
    assert got == {"A": (0.0043, 0.0051), "B": (0.0515, 0.0453), "C": (0.1119, 0.1055),
                   "D": (0.2149, 0.2213), "E": (0.8109, 0.8145)}
