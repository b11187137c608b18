"""A loan mart from its own files: ``dim_loan``, ``fact_loan_monthly``, ``fact_ecl`` and ``dim_scenario``.

Tables lie in folders of these names under one base folder, as parquet or
as CSV with a header. ``save_mart`` writes them so, the panel partitioned by
``snapshot_month``: a filter on the month reads only its folders.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..operators.portfolio import build_portfolio, scorecard_lgd
from .io import read_mart_csv, read_mart_parquet
from .tpch_mart import Mart

MART_TABLES = ("dim_loan", "fact_loan_monthly", "fact_ecl", "dim_scenario")


def save_mart(mart: Mart, out_dir: str) -> str:
    """Write the four mart tables under ``out_dir`` (overwrite); returns the folder."""
    base = out_dir.rstrip("/")
    panel = mart.fact_loan_monthly.repartitionByRange("snapshot_month", "loan_id")  # a month's rows in few files, a large month in several tasks
    panel.write.mode("overwrite").partitionBy("snapshot_month").parquet(f"{base}/fact_loan_monthly")
    for name in ("dim_loan", "fact_ecl", "dim_scenario"):
        getattr(mart, name).write.mode("overwrite").parquet(f"{base}/{name}")
    return base


def observed_book(loans: DataFrame, panel: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The loan-level portfolio with outcomes as the panel records them.

    ``default_flag`` is 1 for a loan that was ever charged off or at the
    default DPD; ``lgd`` is (charge-off - recovery) / charge-off of a loan with charge-offs, clipped to
    [0, 1], the scorecard's for a defaulted loan without, else NULL. A charged-off month counts with the default
    DPD, since its coded DPD is not a number of days.
    """
    days = F.when(F.col("is_charged_off") == 1, F.lit(cfg.stage3_dpd_threshold)).otherwise(F.col("dpd")).cast("int")
    raw = panel.withColumn("dpd_raw", days)
    seen = raw.groupBy("loan_id").agg(
        F.max((F.col("dpd_raw") >= cfg.stage3_dpd_threshold).cast("int")).alias("_default"),
        F.sum("charge_off_amount").cast("double").alias("_co"), F.sum("recovery_amount").cast("double").alias("_rec"))
    book = build_portfolio(loans, raw)
    loss = F.least(F.greatest((F.col("_co") - F.col("_rec")) / F.col("_co"), F.lit(0.0)), F.lit(1.0))
    lgd = F.when(F.col("_default") == 1, F.when(F.col("_co") > 0, F.round(loss, 6)).otherwise(scorecard_lgd()))
    return book.join(seen, "loan_id").withColumn("default_flag", F.col("_default")).withColumn("lgd", lgd).select(*book.columns)


def mart_from_files(spark: SparkSession, base_dir: str, fmt: str = "parquet", cfg: RiskConfig = DEFAULT) -> Mart:
    """The mart over files under ``base_dir`` (``fmt`` parquet or csv), with the book derived by ``observed_book``."""
    read = {"parquet": read_mart_parquet, "csv": read_mart_csv}[fmt]
    t = {name: read(spark, name, f"{base_dir.rstrip('/')}/{name}") for name in MART_TABLES}
    panel = t["fact_loan_monthly"]
    return Mart(dim_loan=t["dim_loan"], fact_loan_monthly=panel, panel_raw=panel, dim_scenario=t["dim_scenario"],
                _portfolio=observed_book(t["dim_loan"], panel, cfg), _fact_ecl=t["fact_ecl"], cfg=cfg)
