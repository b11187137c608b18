"""Property-based checks of the column functions and loan-level invariants."""
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.functions import columns as C
from riskloom.operators.ecl import scorecard_loan_level


def _half_up(n: int, d: int, digits: int) -> float:
    q = Fraction(n, d) * 10 ** digits
    return float(int(q + Fraction(1, 2))) / 10 ** digits


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 6)), min_size=1, max_size=40),
       st.integers(0, 6))
def test_ratio_round_matches_exact_fraction(spark, pairs, digits):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(C.ratio_round("n", "d", digits)).collect()]
    assert got == [_half_up(n, d, digits) for n, d in pairs]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0.0, 1.0, allow_nan=False), min_size=2, max_size=30))
def test_lifetime_pd_is_monotone_and_above_12m(spark, pds):
    rows = sorted(set(pds))
    df = spark.createDataFrame([(p,) for p in rows], "p double")
    life = [r[0] for r in df.orderBy("p").select(C.lifetime_pd("p", 5)).collect()]
    assert all(b >= a - 1e-15 for a, b in zip(life, life[1:]))
    assert all(lv >= p - 1e-12 and 0.0 <= lv <= 1.0 for lv, p in zip(life, rows))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1, allow_nan=False), st.integers(0, 200), st.integers(0, 1)),
                min_size=1, max_size=30))
def test_stage_is_monotone_in_dpd(spark, rows):
    df = spark.createDataFrame(rows, "p double, dpd int, flag int")
    out = df.select("p", "dpd", "flag", C.assign_stage("p", "dpd", "flag").alias("s")).collect()
    for r in out:
        if r["flag"] == 1 or r["dpd"] >= 90:
            assert r["s"] == 3
        elif r["p"] >= 0.15 or r["dpd"] >= 30:
            assert r["s"] == 2
        else:
            assert r["s"] == 1


def test_loan_ecl_ordering(mart):
    ll = scorecard_loan_level(mart.portfolio)
    bad = ll.filter((F.col("ecl_base") > F.col("ecl_weighted") + 0.01) |
                    (F.col("ecl_weighted") > F.col("ecl_severe") + 0.01)).count()
    assert bad == 0
    assert ll.filter((F.col("stage") == 3) & (F.col("effective_pd_base") != 1.0)).count() == 0
