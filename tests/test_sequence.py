"""Skew-safe per-key operators: the hot-key path must equal the plain window."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.config import RiskConfig
from riskloom.operators.ranking import prefix_sums
from riskloom.operators.sequence import range_index, row_index, with_prior


def _data(spark):
    rows = [(1, m, m * 10) for m in range(40)] + [(k, m, k + m) for k in range(2, 12) for m in range(3)]
    return spark.createDataFrame(rows, "k long, m int, v long")


def test_row_index_hot_path_matches_window(spark):
    df = _data(spark)
    hot_cfg = RiskConfig(hot_key_rows=10)  # key 1 (40 rows) is hot
    got = sorted(tuple(r) for r in row_index(df, "k", ["m"], "idx", hot_cfg).select("k", "m", "idx").collect())
    w = Window.partitionBy("k").orderBy("m")
    exp = sorted(tuple(r) for r in df.select("k", "m", (F.row_number().over(w) - 1).alias("idx")).collect())
    assert got == exp


def test_with_prior_hot_path_matches_lag(spark):
    df = _data(spark)
    hot_cfg = RiskConfig(hot_key_rows=10)
    got = sorted(tuple(r) for r in with_prior(df, "k", "m", {"v": "prev_v"}, hot_cfg).select("k", "m", "prev_v").collect())
    w = Window.partitionBy("k").orderBy("m")
    exp = sorted(tuple(r) for r in df.select("k", "m", F.lag("v").over(w).alias("prev_v")).collect())
    assert got == exp


def test_global_range_index(spark):
    df = spark.range(0, 500).select(((F.col("id") * 7919) % 500).alias("x"))
    got = range_index(df, None, ["x"], "i", num_partitions=7).collect()
    assert all(r["i"] == r["x"] for r in got)


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "s long, one long, odd long")
    out = {r["s"]: (r["one_cum"], r["odd_cum"]) for r in prefix_sums(df, "s", ["one", "odd"], num_partitions=5).collect()}
    assert out[0] == (1, 0) and out[199] == (200, 100) and out[100] == (101, 50)


def test_hot_panel_is_written_unbucketed(spark, seed):
    from riskloom.sources.mart_store import _checked
    assert _checked(seed.panel_raw, "loan_id", RiskConfig()) == (RiskConfig(hot_key_rows=None), True)
    assert _checked(seed.panel_raw, "loan_id", RiskConfig(hot_key_rows=3)) == (RiskConfig(hot_key_rows=3), False)  # loan 2 has 4 rows


def test_with_prior_repeated_months(spark):
    """A hot key with repeated months: rows are ordered by month, then by their other columns."""
    rows = [(1, m % 4, m * 7 % 13, str(m)) for m in range(40)] + [(2, 1, 5, "a"), (2, 1, 3, "b"), (2, 2, 9, "c")]
    df = spark.createDataFrame(rows, "k long, m int, v long, w string")
    want = []
    for k in (1, 2):
        mine = sorted(r for r in rows if r[0] == k)
        want += [(*r, p[2] if p else None) for r, p in zip(mine, [None, *mine])]
    for cfg in (RiskConfig(hot_key_rows=10), RiskConfig(hot_key_rows=None)):
        got = [tuple(r) for r in with_prior(df.repartition(7), "k", "m", {"v": "prev"}, cfg).select("k", "m", "v", "w", "prev").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_adapter_hot_path_gives_identical_panel(spark):
    """Orders with more than 4 lines are forced onto the range-partitioned path."""
    from riskloom.sources.tpch_mart import mart_from_tpch
    from tests.conftest import SF001
    normal = mart_from_tpch(spark, SF001).fact_loan_monthly
    forced = mart_from_tpch(spark, SF001, RiskConfig(hot_key_rows=4)).fact_loan_monthly
    cols = ["loan_id", "snapshot_month", "months_on_book", "dpd", "outstanding_balance"]
    a = sorted(tuple(r) for r in normal.select(*cols).collect())
    b = sorted(tuple(r) for r in forced.select(*cols).collect())
    assert a == b and len(a) > 0


def test_panel_queries_hot_path_match(spark, mart):
    from riskloom.operators.panel import roll_matrix, stage_matrix, forward_cure
    hot = RiskConfig(hot_key_rows=3)
    p = mart.fact_loan_monthly
    for fn in (roll_matrix, stage_matrix, forward_cure):
        assert sorted(fn(p).collect()) == sorted(fn(p, hot).collect()), fn.__name__


def test_hot_keys_among_shared_hashes(spark, monkeypatch):
    """Rows are counted per hash first; keys that only share a hash with others are not hot."""
    from riskloom.operators import sequence
    rows = spark.createDataFrame([(k,) for k in range(50) for _ in range(3)] + [(7,)] * 10 + [(None,)] * 20, "k long")
    for hashes in (1, 4, 1 << 18):
        monkeypatch.setattr(sequence, "HASHES", hashes)
        hot, n = sequence.hot_keys(rows, "k", RiskConfig(hot_key_rows=9))
        assert n == 2 and {r["k"] for r in hot.collect()} == {7, None}
        assert sequence.hot_keys(rows, "k", RiskConfig(hot_key_rows=20)) is None
