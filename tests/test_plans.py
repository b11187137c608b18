"""Plan properties: no Python evaluation in any registered (non-model) query plan."""
import contextlib
import io

import pytest

import __spark_entry__ as se
from riskloom.plans import registry
from tests.conftest import SF001

MODEL_KEYS = registry.MODEL_KEYS


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _simple_plan(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().splitlines()


_OK_BELOW_SINGLE = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject",
                    "GlobalLimit", "LocalLimit", "CollectLimit")
_RAW = ("FileScan", "Scan ", "Exchange", "Join", "InMemoryTableScan")


def _single_partition_inputs_are_aggregated(lines: list[str]) -> list[str]:
    """Every Exchange SinglePartition (un-keyed window, global aggregate, global
    sort) must be fed by an aggregate or a top-k, never by raw rows."""
    bad = []
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" not in ln:
            continue
        for child in lines[i + 1:]:  # the next line is always the first child
            if any(k in child for k in _OK_BELOW_SINGLE):
                break
            if any(k in child for k in _RAW):
                bad.append(ln.strip()[:120])
                break
    return bad


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - MODEL_KEYS))
def test_plan_properties(spark, name):
    df = se.queries()[name](spark, SF001)
    lines = _simple_plan(df)
    text = "\n".join(lines)
    for marker in ("EvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow"):
        assert marker not in text, f"{name}: {marker}"
    assert _single_partition_inputs_are_aggregated(lines) == [], name


def test_lag_on_bucketed_panel_needs_no_shuffle(spark):
    from riskloom.operators.panel import roll_matrix
    from riskloom.sources.mart_store import materialize_tpch
    m = materialize_tpch(spark, SF001)
    text = _plan(roll_matrix(m.fact_loan_monthly))
    # the only exchanges: bucket-pair aggregate, window over its rows, final sort
    assert text.count("Exchange hashpartitioning(loan_id") == 0


def test_single_partition_check_flags_raw_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    raw = spark.read.parquet(f"{SF001}/lineitem.parquet")
    bad = raw.withColumn("share", F.col("l_quantity") / F.sum("l_quantity").over(Window.partitionBy()))
    assert _single_partition_inputs_are_aggregated(_simple_plan(bad)) != []
    good = raw.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("q")) \
        .withColumn("share", F.col("q") / F.sum("q").over(Window.partitionBy()))
    assert _single_partition_inputs_are_aggregated(_simple_plan(good)) == []
