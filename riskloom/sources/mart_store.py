"""Materialise the loan mart as tables bucketed by ``loan_id``.

All mart tables share the same bucket count on ``loan_id``, so the panel,
loan, portfolio and ECL tables join and window per loan without a shuffle.
The panel is bucketed only when no loan is hot: a bucketed scan reads each
bucket in one task and AQE cannot split it; with a hot loan the panel is written plain, so per-loan plans
shuffle and the skew handling (AQE skew join, hot-key split) can divide it. The
check is made once, over the key column of the source; where no loan is hot the mart's ``cfg`` says so
(``hot_key_rows`` None) and its queries don't look again.
Files live under the session's shared checkpoint folder (external tables),
so the lineage back to the raw tables is cut and survives executor loss.

The panel is also partitioned by ``period``, a run of whole months, so that a filter on the month reads only its
folders while per-loan plans keep their buckets. A period is as short (``PERIOD_MONTHS``) as the file
count allows: at most ``max_files`` files, and ``rows_per_file`` rows in one on average. Beside it go two small indexes: ``periods``
(for each period the least place from its loan's end that a row in it has, over all rows and over those with a utilisation) and
``loan_index`` (observations per loan). "The last k observations of each loan" is then a semi join with the
periods that hold any, which prunes partitions at run time (``Mart.recent``).
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..operators.sequence import hot_keys
from ..session import checkpoint_dir
from .tpch_mart import Mart, dim_loan, fact_loan_monthly, panel_raw, read_table, scenario_frame


#: months a period may span, shortest first
PERIOD_MONTHS = (1, 3, 12, 24, 60)
#: panel rows a bucket holds on average, at most, where no number of buckets is given (a bucket is sorted by one task)
BUCKET_ROWS = 250_000
#: rank beyond which the period index doesn't tell places apart
DEEP = 1_000_000


def month_number(month: Column) -> Column:
    """Months since year 0."""
    return F.year(month) * 12 + F.month(month) - 1


def period_width(rows: DataFrame, month: Column, buckets: int, max_files: int, rows_per_file: int) -> int:
    """Months per period: the shortest of ``PERIOD_MONTHS`` that keeps periods x buckets within both bounds (0: no periods)."""
    seen = rows.agg(F.count(F.lit(1)), F.min(month_number(month)), F.max(month_number(month))).first()  # one row
    if seen[1] is None:
        return 0
    allowed = min(max_files, seen[0] // rows_per_file) // buckets
    for width in PERIOD_MONTHS:
        if seen[2] // width - seen[1] // width + 1 <= allowed:
            return width
    return 0


def with_period(panel: DataFrame, width: int) -> DataFrame:
    """``panel`` with the first month number of each row's period (one period for all rows if ``width`` is 0)."""
    number = month_number(F.col("snapshot_month"))
    return panel.withColumn("period", (number - number % width).cast("int") if width else F.lit(0))


def period_index(panel: DataFrame) -> DataFrame:
    """(period, rows, depth, depth_util): the least rank from its loan's end of a row in the period (null ``depth_util``: no utilisation there)."""
    late = Window.partitionBy("loan_id").orderBy(F.desc("snapshot_month"))
    # repeated months may come in any order: rank() gives all of them the first place
    month = F.desc(month_number(F.col("snapshot_month")))
    used = F.count_if(F.col("utilization").isNotNull()).over(Window.partitionBy("loan_id").orderBy(month).rangeBetween(Window.unboundedPreceding, -1)) + 1
    ranked = panel.select("period", F.rank().over(late).alias("place"), F.when(F.col("utilization").isNotNull(), used).alias("place_util"))
    return ranked.groupBy("period").agg(F.count(F.lit(1)).alias("rows"), F.least(F.min("place"), F.lit(DEEP)).alias("depth"), F.min("place_util").alias("depth_util"))


def _save(spark: SparkSession, df: DataFrame, base: str, tag: str, name: str, buckets: int,
          sort_cols: list[str], bucketed: bool = True, partition_by: str | None = None) -> DataFrame:
    path = f"{base}/{name}"
    if not bucketed:
        if partition_by:     # a period in few files, a large one in several tasks
            df.repartitionByRange(partition_by, *sort_cols).write.mode("overwrite").partitionBy(partition_by).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    table = f"riskloom_{name}_{tag}"
    # one task per bucket, so that a table has one file per bucket (and partition)
    writer = df.repartition(buckets, "loan_id").write.mode("overwrite").format("parquet").bucketBy(buckets, "loan_id").sortBy(*sort_cols)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with whole_buckets(spark):
        writer.option("path", path).saveAsTable(table)
    return spark.table(table)


@contextmanager
def whole_buckets(spark: SparkSession):
    """Bucketed tables are read a bucket in a task, also where no join or aggregate needs it: a table derived
    row by row from a bucketed one is then written bucket by bucket, not with a file per input split and bucket."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bucket_count(spark: SparkSession, rows: DataFrame) -> int:
    """Buckets for a panel of ``rows``: the session's shuffle partitions, more where a bucket would hold above ``BUCKET_ROWS`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET_ROWS))


def _checked(rows: DataFrame, key: str, cfg: RiskConfig) -> tuple[RiskConfig, bool]:
    """(cfg, whether no key of ``rows`` is hot); the cfg remembers that."""
    if hot_keys(rows.select(key), key, cfg) is not None:
        return cfg, False
    return replace(cfg, hot_key_rows=None), True


def _write(spark: SparkSession, loans: DataFrame, panel_of: Callable[[DataFrame], DataFrame], scenarios: DataFrame, cfg: RiskConfig, bucketed: bool, n: int,
           width_of: Callable[[int], int], book: DataFrame | None = None, ecl: DataFrame | None = None) -> Mart:
    """Write the four tables and the panel's indexes, each built from the ones already written where it isn't given."""
    tag = uuid.uuid4().hex[:10]
    base = f"{checkpoint_dir(spark).rstrip('/')}/riskloom-mart-{tag}"
    dim = _save(spark, loans, base, tag, "dim_loan", n, ["loan_id"])
    panel = _save(spark, with_period(panel_of(dim), width_of(n)), base, tag, "panel", n, ["loan_id", "snapshot_month"], bucketed=bucketed, partition_by="period")
    staged = Mart(dim_loan=dim, fact_loan_monthly=fact_loan_monthly(panel), panel_raw=panel, dim_scenario=scenarios, _portfolio=book, _fact_ecl=ecl, cfg=cfg)
    if bucketed:    # with a hot loan there is no index, and every reader takes the whole panel
        staged.periods = _save(spark, period_index(panel).coalesce(1), base, tag, "periods", n, [], bucketed=False)
        staged.loan_index = _save(spark, panel.groupBy("loan_id").agg(F.count(F.lit(1)).cast("int").alias("loan_age_months")), base, tag, "loan_index", n, ["loan_id"])
    staged._portfolio = _save(spark, staged.portfolio, base, tag, "portfolio", n, ["loan_id"])
    staged._fact_ecl = _save(spark, staged.fact_ecl, base, tag, "fact_ecl", n, ["loan_id"])
    return staged


def materialize(mart: Mart, buckets: int | None = None, max_files: int = 100_000, rows_per_file: int = 4000) -> Mart:
    """Write dim_loan, the panel, the portfolio and fact_ecl once; return a Mart over them."""
    cfg, bucketed = _checked(mart.panel_raw, "loan_id", mart.cfg)
    panel = mart.panel_raw.drop("period")
    spark = mart.dim_loan.sparkSession
    return _write(spark, mart.dim_loan, lambda dim: panel, mart.dim_scenario, cfg, bucketed, buckets or bucket_count(spark, panel),
                  lambda n: period_width(panel, F.col("snapshot_month"), n, max_files, rows_per_file), mart._portfolio, mart._fact_ecl)


def materialize_tpch(spark: SparkSession, sf_dir: str, cfg: RiskConfig = DEFAULT, buckets: int | None = None,
                     max_files: int = 100_000, rows_per_file: int = 4000) -> Mart:
    """Derive and write the mart from the driver tables, each table built from the
    ones already written (the panel joins the written, bucketed ``dim_loan``)."""
    lines = read_table(spark, sf_dir, "lineitem")
    cfg, bucketed = _checked(lines, "l_orderkey", cfg)
    n = buckets or bucket_count(spark, lines)
    # above the session's shuffle partitions the rows are dealt to the buckets from the start
    dealt = n if bucketed and n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None
    # ship dates span the origination months and some more: near enough to choose a period by
    return _write(spark, dim_loan(spark, sf_dir, dealt), lambda dim: panel_raw(spark, sf_dir, dim, cfg, dealt), scenario_frame(spark, cfg), cfg, bucketed, n,
                  lambda n: period_width(lines, F.col("l_shipdate"), n, max_files, rows_per_file))
