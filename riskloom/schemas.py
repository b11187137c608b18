"""Explicit schemas of the loan mart; readers never infer."""
from __future__ import annotations

from pyspark.sql import types as T

DIM_LOAN = T.StructType([
    T.StructField("loan_id", T.LongType(), False),
    T.StructField("origination_date", T.DateType(), False),
    T.StructField("sector", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("credit_score", T.IntegerType(), True),
    T.StructField("dti", T.DecimalType(6, 2), True),
    T.StructField("ltv_orig", T.DecimalType(6, 2), True),
    T.StructField("dscr", T.DecimalType(6, 3), True),
    T.StructField("loan_amount", T.DecimalType(14, 2), False),
    T.StructField("interest_rate", T.DecimalType(6, 3), True),
    T.StructField("term_months", T.IntegerType(), False),
])

FACT_LOAN_MONTHLY = T.StructType([
    T.StructField("loan_id", T.LongType(), False),
    T.StructField("snapshot_month", T.DateType(), False),
    T.StructField("months_on_book", T.IntegerType(), False),
    T.StructField("outstanding_balance", T.DecimalType(14, 2), False),
    T.StructField("scheduled_payment", T.DecimalType(14, 2), True),
    T.StructField("dpd", T.IntegerType(), False),
    T.StructField("dpd_bucket", T.StringType(), False),
    T.StructField("utilization", T.DecimalType(6, 2), True),
    T.StructField("ifrs9_stage", T.IntegerType(), False),
    T.StructField("is_charged_off", T.IntegerType(), False),
    T.StructField("charge_off_amount", T.DecimalType(14, 2), False),
    T.StructField("recovery_amount", T.DecimalType(14, 2), False),
])

FACT_ECL = T.StructType([
    T.StructField("loan_id", T.LongType(), False),
    T.StructField("as_of_date", T.DateType(), False),
    T.StructField("sector", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("ead", T.DecimalType(14, 2), False),
    T.StructField("pd_12m", T.DecimalType(9, 6), False),
    T.StructField("pd_lifetime", T.DecimalType(9, 6), False),
    T.StructField("lgd", T.DecimalType(9, 6), False),
    T.StructField("current_dpd", T.IntegerType(), False),
    T.StructField("ifrs9_stage", T.IntegerType(), False),
    T.StructField("ecl_base", T.DecimalType(14, 2), False),
    T.StructField("ecl_downside", T.DecimalType(14, 2), False),
    T.StructField("ecl_severe", T.DecimalType(14, 2), False),
    T.StructField("ecl_weighted", T.DecimalType(14, 2), False),
    T.StructField("coverage_ratio", T.DecimalType(9, 6), True),
])

DIM_SCENARIO = T.StructType([
    T.StructField("scenario", T.StringType(), False),
    T.StructField("weight", T.DecimalType(4, 2), False),
    T.StructField("pd_multiplier", T.DecimalType(4, 2), False),
    T.StructField("lgd_multiplier", T.DecimalType(4, 2), False),
    T.StructField("unemployment", T.DecimalType(4, 1), False),
    T.StructField("rate_shock_bps", T.IntegerType(), False),
    T.StructField("rent_shock_pct", T.DecimalType(4, 2), False),
])

# one row per loan: attributes, 12-month behaviour, exposure and outcomes
PORTFOLIO = T.StructType([
    T.StructField("loan_id", T.LongType(), False),
    T.StructField("sector", T.StringType(), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("credit_score", T.IntegerType(), True),
    T.StructField("dti", T.DoubleType(), True),
    T.StructField("ltv", T.DoubleType(), True),
    T.StructField("dscr", T.DoubleType(), True),
    T.StructField("loan_amount", T.DoubleType(), True),
    T.StructField("interest_rate", T.DoubleType(), True),
    T.StructField("term_months", T.IntegerType(), True),
    T.StructField("loan_age_months", T.IntegerType(), True),
    T.StructField("utilization", T.DoubleType(), True),
    T.StructField("avg_utilization_12m", T.DoubleType(), True),
    T.StructField("max_utilization_12m", T.DoubleType(), True),
    T.StructField("utilization_trend", T.DoubleType(), True),
    T.StructField("missed_payments_12m", T.IntegerType(), True),
    T.StructField("max_dpd_12m", T.IntegerType(), True),
    T.StructField("avg_dpd_12m", T.DoubleType(), True),
    T.StructField("current_dpd", T.IntegerType(), True),
    T.StructField("ead", T.DoubleType(), True),
    T.StructField("true_pd", T.DoubleType(), True),
    T.StructField("default_flag", T.IntegerType(), True),
    T.StructField("lgd", T.DoubleType(), True),
])
