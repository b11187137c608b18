"""Column functions on hand-made rows (lifetime PD, stages, discount, HHI, bands)."""
import pytest
from pyspark.sql import functions as F

from riskloom.config import DEFAULT, SCENARIOS
from riskloom.functions import columns as C


def _vals(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_lifetime_pd_bounded_and_monotone(spark):
    pds = [0.0, 0.05, 0.2, 0.5, 1.0]
    life = _vals(spark, [(p,) for p in pds], "p double", C.lifetime_pd("p", 5))
    assert all(lv >= p - 1e-12 for lv, p in zip(life, pds))
    assert all(0.0 <= lv <= 1.0 for lv in life)
    assert life[0] == pytest.approx(0.0) and life[-1] == pytest.approx(1.0)


def test_lifetime_pd_formula(spark):
    assert _vals(spark, [(0.1,)], "p double", C.lifetime_pd("p", 5))[0] == pytest.approx(1 - 0.9 ** 5)


def test_stage_assignment(spark):
    rows = [(0.01, 0, 0), (0.20, 0, 0), (0.01, 45, 0), (0.01, 120, 0)]
    assert _vals(spark, rows, "p double, dpd int, flag int", C.assign_stage("p", "dpd", "flag")) == [1, 2, 2, 3]


def test_default_flag_forces_stage3(spark):
    assert _vals(spark, [(0.01, 0, 1)], "p double, dpd int, flag int", C.assign_stage("p", "dpd", "flag")) == [3]


def test_discount_factor(spark):
    got = _vals(spark, [(1,), (2,), (3,)], "s int", C.discount_factor("s"))
    assert got == pytest.approx([1 / 1.08, 1 / 1.08 ** 2.5, 1 / 1.08 ** 2.5])


@pytest.mark.parametrize("xs,expected", [([25, 25, 25, 25], 0.25), ([100], 1.0), ([0, 0], 0.0)])
def test_hhi(spark, xs, expected):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    assert df.agg(C.hhi("x")).first()[0] == pytest.approx(expected)


def test_effective_pd(spark):
    rows = [(1, 0.1, 0.4), (2, 0.1, 0.4), (3, 0.1, 0.4)]
    assert _vals(spark, rows, "s int, p double, l double", C.effective_pd("s", "p", "l")) == [0.1, 0.4, 1.0]


def test_score_band_and_severity(spark):
    bands = _vals(spark, [(800,), (700,), (650,), (520,)], "s int", C.score_band("s"))
    assert [b[:2] for b in bands] == ["1.", "2.", "3.", "4."]
    sev = _vals(spark, [(b,) for b in ["Current", "1-29", "30-59", "60-89", "90+", "ChargedOff"]], "b string",
                C.bucket_severity("b"))
    assert sev == [0, 1, 2, 3, 4, 5]


def test_is_90plus(spark):
    rows = [(0, "Current"), (95, "90+"), (999, "ChargedOff"), (45, "30-59")]
    assert _vals(spark, rows, "d int, b string", C.is_90plus("d", "b")) == [0, 1, 1, 0]


def test_ratio_round_is_exact_half_up(spark):
    # 1/128 = 0.0078125 is a tie at 6 places: half-up gives 0.007813
    rows = [(1, 128), (3, 8), (2, 3), (0, 5), (1, 0)]
    got = _vals(spark, rows, "n long, d long", C.ratio_round("n", "d", 6))
    assert got == [0.007813, 0.375, 0.666667, 0.0, None]


def test_vintage_label(spark):
    import datetime as dt
    assert _vals(spark, [(dt.date(2023, 5, 1),)], "d date", C.vintage_label("d")) == ["2023-Q2"]


def test_scenario_weights_sum_to_one():
    assert sum(s[1] for s in SCENARIOS) == pytest.approx(1.0)
    assert DEFAULT.scenario_names == ("base", "downside", "severe")


def test_clip_keeps_null(spark):
    assert _vals(spark, [(None,), (2.0,), (-1.0,)], "x double", C.clip(F.col("x"), 0.0, 1.0)) == [None, 1.0, 0.0]


def test_auc_and_ap_match_separate_passes(spark):
    from riskloom.operators import metrics as M
    rows = [(i, (i * 37 % 101) / 100.0, int((i * 53) % 7 < 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "loan_id long, score double, label int")
    both = M.auc_and_ap(df).first()
    assert both["roc_auc"] == M.auc_exact(df).first()["roc_auc"]
    assert both["pr_auc"] == M.average_precision(df).first()["pr_auc"]
