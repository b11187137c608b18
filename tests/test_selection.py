"""Exact selection by counts: ties, nulls, several rounds, no sort or shuffle of rows."""
import pytest
from pyspark.sql import functions as F

from riskloom.operators import monitoring
from riskloom.operators.selection import digits_of, mark_smallest


def _expected(rows, k):
    groups, out = {}, {}
    for s, v, i in rows:
        groups.setdefault(s, []).append((v, i))
    for s, vs in groups.items():
        for at, (v, i) in enumerate(sorted(vs)):
            out[s, i] = at < k(len(vs))
    return out


@pytest.mark.parametrize("spread", [1, 3, 1 << 20, 1 << 40])
def test_equals_sorting(spark, spread):
    rows = [(("a", "b", None)[i % 7 % 3], (i * 7919 % 1009 - 500) * spread, i) for i in range(700)]
    df = spark.createDataFrame(rows, "s string, v long, i long")
    for k in (lambda n: F.floor(n * 0.3 + 0.5), lambda n: F.lit(1), lambda n: F.lit(0), lambda n: n):
        got = mark_smallest(df, "s", digits_of(F.col("v")) + digits_of(F.col("i")), k, "top")
        want = {(r["s"]): r["n"] for r in df.groupBy("s").agg(k(F.count(F.lit(1))).alias("n")).collect()}
        assert {(r["s"], r["i"]): r["top"] for r in got.collect()} == {
            key: val for s in want for key, val in _expected([r for r in rows if r[0] == s], lambda n, s=s: want[s]).items()}


def test_extremes_order(spark):
    ends = [-(1 << 63), -1, 0, 1, (1 << 63) - 1]
    df = spark.createDataFrame([(1, v) for v in ends], "s int, v long")
    for k in range(6):
        got = mark_smallest(df, "s", digits_of(F.col("v")), lambda n, k=k: F.lit(k), "top")
        assert sorted(r["v"] for r in got.where("top").collect()) == ends[:k]


def test_rows_of_one_key_stay_together(spark):
    df = spark.createDataFrame([(0, 5)] * 4 + [(0, 9)] * 6, "y int, loan_id long")
    s = monitoring.exact_stratified_split(df, "y")
    assert {r["loan_id"]: r["n"] for r in s.groupBy("loan_id").agg(F.countDistinct("split").alias("n")).collect()} == {5: 1, 9: 1}
    assert monitoring.exact_stratified_split(df.limit(0), "y").count() == 0


def test_no_row_is_moved(spark):
    df = spark.range(5000).select(F.col("id").alias("loan_id"), (F.col("id") % 3).alias("y"))
    plan = monitoring.exact_stratified_split(df, "y")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning" not in plan and "Sort" not in plan


def test_split_does_not_depend_on_the_layout(spark):
    df = spark.range(3000).select((F.col("id") * 31).alias("loan_id"), (F.col("id") % 11 == 0).cast("int").alias("y"))
    a = monitoring.exact_stratified_split(df, "y").where("split = 'test'").select("loan_id", "y")
    b = monitoring.exact_stratified_split(df.repartition(7, "y"), "y").where("split = 'test'").select("loan_id", "y")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    assert {r["y"]: r["count"] for r in a.groupBy("y").count().collect()} == {0: 818, 1: 82}
