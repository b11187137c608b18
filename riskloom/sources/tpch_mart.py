"""Loan mart derived from the TPC-H-like driver tables.

orders (+ customer, nation, region) become ``dim_loan``; each lineitem
becomes one loan-month of ``fact_loan_monthly``. All values are integer or
two-decimal arithmetic so every engine derives identical rows. The mapping
is ours (documented in the README); it exists so that the mart queries can
run over data that grows with the scale factor.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, RiskConfig
from ..functions.columns import idiv
from ..operators.sequence import row_index

# fixed mapping of the adapter: market segment -> sector, priority -> term
SEGMENT_SECTOR = (
    ("HOUSEHOLD", "Residential"),
    ("BUILDING", "Multifamily"),
    ("FURNITURE", "Retail CRE"),
    ("AUTOMOBILE", "Office CRE"),
    ("MACHINERY", "Industrial"),
)
PRIORITY_TERM = (
    ("1-URGENT", 60),
    ("2-HIGH", 120),
    ("3-MEDIUM", 180),
    ("4-NOT SPECIFIED", 240),
    ("5-LOW", 360),
)
SMALL_DIM_ROWS = 10_000  # nation/region are fixed-size by the TPC-H spec; checked anyway


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def _cents_to_money(cents: Column) -> Column:
    """Exact DECIMAL(14,2) from integer cents."""
    return (cents.cast(T.DecimalType(18, 0)) * F.lit(Decimal("0.01"))).cast(T.DecimalType(14, 2))


def _checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def dim_loan(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The loans; with ``partitions`` the join with the customers has that many tasks instead of the session's shuffle partitions."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    if partitions:
        o = o.repartition(partitions, "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = _checked_broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"),
                             SMALL_DIM_ROWS)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey)
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    score = F.lit(520) + F.floor((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0) * F.lit(300.0))
    k = F.col("o_orderkey")
    return j.select(
        k.alias("loan_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("origination_date"),
        _case(F.col("c_mktsegment"), SEGMENT_SECTOR).alias("sector"),
        F.col("r_name").alias("region"),
        F.least(F.greatest(score, F.lit(520)), F.lit(820)).cast("int").alias("credit_score"),
        (F.lit(5) + F.col("o_custkey") % 71).cast(T.DecimalType(6, 2)).alias("dti"),
        (F.lit(30) + (k * 7) % 81).cast(T.DecimalType(6, 2)).alias("ltv_orig"),
        ((F.lit(40) + (k * 13) % 311).cast("double") / F.lit(100.0)).cast(T.DecimalType(6, 3)).alias("dscr"),
        F.col("o_totalprice").cast(T.DecimalType(14, 2)).alias("loan_amount"),
        ((F.lit(30) + (k * 17) % 111).cast("double") / F.lit(10.0)).cast(T.DecimalType(6, 3)).alias("interest_rate"),
        _case(F.col("o_orderpriority"), PRIORITY_TERM).cast("int").alias("term_months"),
    )


def panel_raw(spark: SparkSession, sf_dir: str, loans: DataFrame, cfg: RiskConfig = DEFAULT, partitions: int | None = None) -> DataFrame:
    """Loan-month rows with the raw DPD (before charge-off coding) kept as ``dpd_raw``; ``partitions``: of the lines by order, where no order is hot."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    if partitions:
        li = li.repartition(partitions, "l_orderkey")
    # a total order over the lines of an order; the line number alone is not unique
    li = row_index(li, "l_orderkey",
                   ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
                   "months_on_book", cfg)
    terms = loans.select("loan_id", "origination_date", "loan_amount", "term_months")
    p = li.join(terms, li.l_orderkey == terms.loan_id)
    s = (F.lit(9) * F.round(F.col("l_discount") * 100.0) + F.round(F.col("l_tax") * 100.0)).cast("int")
    dpd_raw = F.when(s <= 60, F.lit(0)).otherwise(F.lit(3) * (s - 60))
    p = p.withColumn("dpd_raw", dpd_raw.cast("int"))
    charged = (F.col("dpd_raw") >= 90) & (F.col("l_returnflag") == "R")
    p = p.withColumn("_co", charged)
    dpd = F.when(F.col("_co"), F.lit(999)).otherwise(F.col("dpd_raw"))
    bucket = (F.when(F.col("_co"), F.lit("ChargedOff"))
              .when(F.col("dpd_raw") == 0, F.lit("Current"))
              .when(F.col("dpd_raw") < 30, F.lit("1-29"))
              .when(F.col("dpd_raw") < 60, F.lit("30-59"))
              .when(F.col("dpd_raw") < 90, F.lit("60-89"))
              .otherwise(F.lit("90+")))
    balance_cents = F.when(F.col("_co"), F.lit(0).cast("long")).otherwise(
        idiv((F.col("loan_amount") * 100).cast("long") * F.greatest(F.col("term_months") - F.col("months_on_book"), F.lit(0)).cast("long"), F.col("term_months")))
    co_cents = F.when(F.col("_co"), F.round(F.col("l_extendedprice") * 100.0).cast("long")).otherwise(F.lit(0).cast("long"))
    rec_cents = idiv(F.col("co_cents") * F.col("l_quantity").cast("long"), F.lit(100))
    p = p.withColumn("co_cents", co_cents)
    out = p.select(
        F.col("loan_id"),
        F.add_months(F.col("origination_date"), F.col("months_on_book")).alias("snapshot_month"),
        F.col("months_on_book").cast("int").alias("months_on_book"),
        _cents_to_money(balance_cents).alias("outstanding_balance"),
        _cents_to_money(idiv((F.col("loan_amount") * 100).cast("long"), F.col("term_months"))).alias("scheduled_payment"),
        dpd.cast("int").alias("dpd"),
        bucket.alias("dpd_bucket"),
        (F.col("l_quantity") * 2.0).cast(T.DecimalType(6, 2)).alias("utilization"),
        F.when(dpd >= 90, F.lit(3)).when(dpd >= 30, F.lit(2)).otherwise(F.lit(1)).alias("ifrs9_stage"),
        F.col("_co").cast("int").alias("is_charged_off"),
        _cents_to_money(F.col("co_cents")).alias("charge_off_amount"),
        _cents_to_money(rec_cents).alias("recovery_amount"),
        F.col("dpd_raw"),
    )
    return out


def fact_loan_monthly(panel: DataFrame) -> DataFrame:
    """The mart's 12 columns of a raw panel."""
    from ..schemas import FACT_LOAN_MONTHLY
    return panel.select(*[f.name for f in FACT_LOAN_MONTHLY.fields])


@dataclass
class Mart:
    """The four mart tables plus the raw panel and the loan-level portfolio."""

    dim_loan: DataFrame
    fact_loan_monthly: DataFrame
    panel_raw: DataFrame
    dim_scenario: DataFrame
    _portfolio: DataFrame | None = None
    _fact_ecl: DataFrame | None = None
    cfg: RiskConfig = DEFAULT
    # indexes of a written panel (see ``mart_store``): periods with the depth of their rows, observations per loan
    periods: DataFrame | None = None
    loan_index: DataFrame | None = None
    # indexes of scored sets by name, built by the first query that reads one
    score_indexes: dict = field(default_factory=dict)
    # stored drift baselines by name
    baselines: dict = field(default_factory=dict)

    def recent(self, k: int, used: bool = False) -> DataFrame:
        """The raw panel without the periods that hold none of a loan's last ``k`` observations (``used``: of those with a utilisation).

        More rows than those k may come back, never fewer. On a written panel the periods
        to read are found at run time (a semi join on the partition column); else this is the whole panel.
        """
        if self.periods is None:
            return self.panel_raw
        near = self.periods.where(F.col("depth_util" if used else "depth") <= k).select("period")
        return self.panel_raw.join(F.broadcast(near), "period", "left_semi")   # one row per period

    def between_months(self, first, last) -> DataFrame:
        """The panel's rows with ``snapshot_month`` from ``first`` to ``last`` (dates or constant Columns), read from the periods they fall in."""
        first, last = (v if isinstance(v, Column) else F.lit(v) for v in (first, last))
        rows = self.panel_raw
        if "period" in rows.columns and self.periods is not None:
            from .mart_store import month_number
            # the period that the first month falls in starts at or before it
            starts = self.periods.where(F.col("period") <= month_number(first)).agg(F.max("period").alias("p")).scalar()
            rows = rows.where((F.col("period") >= F.coalesce(starts, F.lit(0))) & (F.col("period") <= month_number(last)))
        return fact_loan_monthly(rows.where(F.col("snapshot_month").between(first, last)))

    @property
    def portfolio(self) -> DataFrame:
        if self._portfolio is None:
            from ..operators.portfolio import build_portfolio
            self._portfolio = build_portfolio(self.dim_loan, self.recent(12), self.loan_index)
        return self._portfolio

    @property
    def fact_ecl(self) -> DataFrame:
        if self._fact_ecl is None:
            from ..operators.ecl import fact_ecl_from_portfolio
            self._fact_ecl = fact_ecl_from_portfolio(self.portfolio, self.cfg)
        return self._fact_ecl


def scenario_frame(spark: SparkSession, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """``dim_scenario`` as a 3-row DataFrame."""
    from ..schemas import DIM_SCENARIO
    rows = [(name, Decimal(str(w)), Decimal(str(pm)), Decimal(str(lm)), Decimal(str(u)), int(bps), Decimal(str(rent)))
            for name, w, pm, lm, u, bps, rent in cfg.scenarios]
    return spark.createDataFrame(rows, DIM_SCENARIO)


def mart_from_tpch(spark: SparkSession, sf_dir: str, cfg: RiskConfig = DEFAULT) -> Mart:
    loans = dim_loan(spark, sf_dir)
    raw = panel_raw(spark, sf_dir, loans, cfg)
    return Mart(dim_loan=loans, fact_loan_monthly=fact_loan_monthly(raw), panel_raw=raw,
                dim_scenario=scenario_frame(spark, cfg), cfg=cfg)
