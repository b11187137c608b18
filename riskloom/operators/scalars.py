"""One-row aggregates as scalar subqueries (instead of cross joins).

A grand total, a set of quantile edges or a metric row is one aggregate
row; ``scalar_row`` turns it into a struct-valued scalar subquery that any
row can reference, and ``one_row`` lays several such rows side by side.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_row(one: DataFrame) -> Column:
    """The single row of ``one`` (a global aggregate) as a struct scalar subquery."""
    return one.select(F.struct(*one.columns).alias("_row")).scalar()


def one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side combination of one-row DataFrames (column names must differ)."""
    spark = frames[0].sparkSession
    parts = [scalar_row(f).alias(f"_r{i}") for i, f in enumerate(frames)]
    base = spark.range(1).select(*parts)
    return base.select(*[F.col(f"_r{i}.{c}").alias(c) for i, f in enumerate(frames) for c in f.columns])
