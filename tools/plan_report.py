"""Physical-plan summary of every registered query on the materialised mart.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts, per query: shuffle exchanges, broadcast exchanges, windows, sorts,
whole-stage-codegen stages, Python evaluation nodes and scans (with whether
the scan is bucketed). Model keys are skipped (their plans are MLlib jobs).
"""
from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from riskloom.plans import registry  # noqa: E402
from riskloom.session import local_session  # noqa: E402
from riskloom.sources.mart_store import materialize_tpch  # noqa: E402

MODEL_KEYS = registry.MODEL_KEYS


def plan_text(df) -> str:
    # the executed (final adaptive) plan: run into the no-op sink, then read the plan
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def summarize(text: str) -> dict:
    lines = text.splitlines()

    def count(pat):
        return sum(1 for ln in lines if re.search(pat, ln))
    return {
        "shuffle": count(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "broadcast": count(r"BroadcastExchange"),
        "window": count(r"\bWindow\b"),
        "group_limit": count(r"WindowGroupLimit"),
        "codegen": count(r"WholeStageCodegen|^\*\(\d+\)"),
        "python": count(r"EvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas"),
        "scans": count(r"FileScan|Scan parquet|Scan ExistingRDD|LocalTableScan"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    registry.use_mart(spark, sf_dir, materialize_tpch(spark, sf_dir))
    print("# Physical plans on the materialised mart\n")
    print(f"Generated by `tools/plan_report.py` at `{sf_dir}` (final adaptive plans). "
          "`shuffle` counts shuffle exchanges (hash / range / single), `broadcast` broadcast exchanges.\n")
    print("| query | shuffle | broadcast | window | group limit | python | scans |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in registry.QUERIES.items():
        if name in MODEL_KEYS:
            continue
        s = summarize(plan_text(fn(spark, sf_dir)))
        print(f"| {name} | {s['shuffle']} | {s['broadcast']} | {s['window']} | {s['group_limit']} | "
              f"{s['python']} | {s['scans']} |")


if __name__ == "__main__":
    main()
