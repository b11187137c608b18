"""File sources and sinks: CSV bulk load of mart tables, table and metrics sinks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DIM_LOAN, DIM_SCENARIO, FACT_ECL, FACT_LOAN_MONTHLY

MART_SCHEMAS = {"dim_loan": DIM_LOAN, "fact_loan_monthly": FACT_LOAN_MONTHLY, "fact_ecl": FACT_ECL,
                "dim_scenario": DIM_SCENARIO}


def read_mart_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Bulk-load a mart table from CSV with a header, the declared schema and fail-fast parsing."""
    return (spark.read.schema(MART_SCHEMAS[table]).option("header", True).option("mode", "FAILFAST")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


def read_mart_parquet(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Read a mart table written as parquet with its declared columns and types (nothing is inferred; other columns are not read)."""
    schema = MART_SCHEMAS[table]
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def save_table(df: DataFrame, out_dir: str, name: str, fmt: str = "parquet",
               partition_by: list[str] | None = None) -> str:
    """Write a result table (overwrite) under ``out_dir/name``; returns the path."""
    path = f"{out_dir.rstrip('/')}/{name}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def save_metrics(metrics: DataFrame, out_dir: str, name: str) -> str:
    """Write a one-row metrics DataFrame as JSON (one file)."""
    path = f"{out_dir.rstrip('/')}/{name}"
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path
