"""The tables behind the written summary, as one long table: (section, item, measure, value).

A section is a small report table; its rows are named by one column and its numbers become rows. The batch job's
fitted results and the fixed scorecards give the same form, so a run can be compared with another one by a join.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: section -> (column that names its rows, its numbers), in the order of the report
SECTIONS = {
    "score_bands": ("band", ("n_loans", "pct_of_book", "avg_predicted_pd", "actual_default_rate")),
    "lgd_segment_errors": ("sector", ("n", "mean_actual_lgd", "mean_pred_lgd", "mae")),
    "lgd_top_drivers": ("feature", ("importance",)),
    "ecl_by_stage": ("stage", ("n_loans", "ead", "ecl", "avg_pd", "avg_lgd", "coverage_ratio")),
    "ecl_by_scenario": ("scenario", ("weight", "ecl")),
    "stress_scenarios": ("scenario", ("expected_loss", "loss_rate", "avg_stressed_pd", "avg_stressed_lgd", "loss_increase_vs_base")),
    "stress_sensitivity": ("shock", ("expected_loss", "delta_vs_base", "pct_change")),
    "watchlist_top10": ("loan_id", ("rank", "ews_score", "ead", "expected_loss_at_risk")),
}


def summary_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The long form of those of ``SECTIONS`` that are in ``tables``; a null number keeps its row."""
    parts = []
    for section, (name, numbers) in SECTIONS.items():
        if section in tables:
            cells = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias("value")) for n in numbers])
            parts.append(tables[section].select(F.lit(section).alias("section"), F.col(name).cast("string").alias("item"), F.explode(cells).alias("c"))
                         .select("section", "item", "c.measure", "c.value"))
    return reduce(DataFrame.unionByName, parts).orderBy("section", "item", "measure")


def summary_sql(bodies: dict[str, str]) -> str:
    """The same in SQL over the queries of the sections (each a SELECT, or a list of further CTEs and a SELECT)."""
    selects = []
    for section, (name, numbers) in SECTIONS.items():
        if section in bodies:
            body = bodies[section].strip()
            body = f"WITH {body[1:]}" if body.startswith(",") else body
            for n in numbers:
                selects.append(f"SELECT '{section}' AS section, CAST({name} AS VARCHAR) AS item, '{n}' AS measure, CAST({n} AS DOUBLE) AS value FROM ({body}) s_{section}")
    return "SELECT * FROM (" + "\nUNION ALL ".join(selects) + ") rows ORDER BY section, item, measure"
