"""Measures read from the stored score index equal those from the scores."""
import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics, monitoring
from riskloom.operators import score_index as si
from riskloom.plans.registry import QUERIES
from tests.conftest import SF001


def _scored(spark, n=900, step=40):
    return spark.range(n).select(F.col("id").alias("loan_id"), (F.col("id") * 37 % step / F.lit(float(step))).alias("score"),
                                 ((F.col("id") * 7919 % 100) < (F.col("id") * 37 % step) * 2).cast("int").alias("label"),
                                 F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"))


@pytest.mark.parametrize("n,step", [(900, 40), (900, 4), (30, 7), (2500, 997)])
def test_measures(spark, n, step, monkeypatch):
    scored = _scored(spark, n, step)
    test = scored.where("split = 'test'")
    ix = si.build_index(scored)
    pairs = [(ix.auc(), metrics.auc_exact(test)), (ix.average_precision(), metrics.average_precision(test)), (ix.roc_points(), metrics.roc_points(test)),
             (ix.pr_points(), metrics.pr_points(test)), (ix.brier(), metrics.brier(test)), (ix.psi(), monitoring.psi_band(scored))]
    for got, want in pairs:
        assert got.columns == want.columns and got.collect() == want.collect(), got.columns
    one = ix.monitor_metrics().first()
    assert (one["roc_auc"], one["brier"], one["psi"]) == (ix.auc().first()[0], ix.brier().first()[0], ix.psi().first()[0])
    for fraction in (0.1, 0.37, 1.0):
        want = metrics.top_fraction_capture(test, fraction).collect()
        assert ix.capture(test, fraction).collect() == want
        with monkeypatch.context() as m:
            m.setattr(si, "TIED", 0)        # many tied rows: ranked by value ranges
            assert ix.capture(test, fraction).collect() == want


def test_empty_set(spark):
    ix = si.build_index(_scored(spark).limit(0))
    assert ix.auc().first()[0] is None and ix.capture(_scored(spark).limit(0)).first()["captured"] == 0
    assert ix.roc_points().count() == 1


def test_one_class(spark):
    ix = si.build_index(_scored(spark, 60, 1))
    assert ix.auc().first()[0] is None and ix.average_precision().first()[0] is None and ix.brier().first()[0] == 0.0
    assert ix.monitor_metrics().first()["roc_auc"] is None


def test_measures_read_the_index_only(spark):
    for q in ("v4_monitor_triggers", "m6_auc_exact", "m7_average_precision", "m8_roc_points", "m8_pr_points"):
        df = QUERIES[q](spark, SF001)
        files = df.inputFiles()
        assert files and all("/score-index-" in f or "/score-bands-" in f for f in files), q
        assert df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") < 4, q
