"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

The loan mart is derived from the driver tables and written once as
loan_id-bucketed tables (timed as ``mart_build``); each query then runs
against it, timed as the warm median of 3 runs into the no-op sink (the
whole result is computed, nothing is collected). Keys that fit a model are
timed once, fit included. ``flagship_from_raw``
times the flagship query end to end from the raw tables, no mart.
Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.plans import registry  # noqa: E402
from riskloom.session import local_session  # noqa: E402
from riskloom.sources.mart_store import materialize_tpch  # noqa: E402
from riskloom.sources.tpch_mart import mart_from_tpch  # noqa: E402


WARMUP = ("q9a_allowance", "q4a_nco", "m10_brier")
# keys whose callable fits a model: the fit is included in their timing; later
# keys of the same model reuse that fit and time the scoring only
FIT_KEYS = registry.FIT_KEYS


def _run(make) -> float:
    """Seconds to build the plan (with the jobs that building runs) and to compute the whole result."""
    t = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def headline_results(spark, sf_dir: str, names: list[str]) -> dict:
    out: dict = {}
    picks = {
        "m3_m5_pd_models": lambda rows: {r["model"]: {k: r[k] for k in ("roc_auc", "pr_auc", "brier")} for r in rows},
        "m13_lgd_gbt": lambda rows: {k: rows[0][k] for k in ("mae", "rmse", "r2", "mean_actual", "mean_predicted")},
        "m19_ews_gbt": lambda rows: rows[0].asDict(),
        "e7_ecl_portfolio": lambda rows: rows[0].asDict(),
        "t3_concentration_metrics": lambda rows: rows[0].asDict(),
        "t1_scenario_loss": lambda rows: {r["scenario"]: {"expected_loss": r["expected_loss"],
                                                           "loss_rate": r["loss_rate"]} for r in rows},
    }
    for name, shape in picks.items():
        if name not in names:
            continue
        try:
            out[name] = shape(registry.QUERIES[name](spark, sf_dir).collect())  # a few rows each
        except Exception as exc:
            out[name] = f"{type(exc).__name__}"
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, max(8, cpus * 2), app="riskloom-bench")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")

    t = time.perf_counter()
    mart = materialize_tpch(spark, sf_dir)
    mart_build = time.perf_counter() - t
    registry.use_mart(spark, sf_dir, mart)

    names = [n for n in registry.QUERIES if not only or n in only]
    for name in WARMUP:  # JIT and planner warm-up, untimed
        _run(lambda: registry.QUERIES[name](spark, sf_dir))

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = registry.QUERIES[name]
        try:
            if name in FIT_KEYS:
                # a model fit is part of the query: fit once, from scratch, timed once
                registry.forget_fits()
                times[name] = round(_run(lambda: fn(spark, sf_dir)), 4)
                continue
            runs = [_run(lambda: fn(spark, sf_dir)) for _ in range(repeats)]
            times[name] = round(statistics.median(runs), 4)
        except Exception as exc:  # record and go on: one failure must not hide the rest
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    results = headline_results(spark, sf_dir, names)

    registry.use_mart(spark, sf_dir, mart_from_tpch(spark, sf_dir))  # a lazy plan over the raw tables
    flagship = registry.QUERIES["q9b_stage_sector"]
    _run(lambda: flagship(spark, sf_dir))  # warm
    raw = _run(lambda: flagship(spark, sf_dir))

    total = sum(v for v in times.values() if v is not None)
    print(json.dumps({
        "metric": "sum_of_query_medians_on_materialized_mart",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "mart_build": round(mart_build, 3),
        "flagship_from_raw": round(raw, 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
        "errors": errors,
        "results": results,
    }))


if __name__ == "__main__":
    main()
