"""The two-loan illustrative seed of the mart (inline rows), test data.

The ECL rows of the original seed lack ``ifrs9_stage``; stages 1 and 3 are
supplied here. Its stored ``ecl_weighted`` does not equal the scenario blend,
which makes it the "break detected" case of the reconciliation query.
"""
from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import SparkSession

from riskloom.schemas import DIM_LOAN, FACT_ECL, FACT_LOAN_MONTHLY
from riskloom.sources.tpch_mart import Mart, scenario_frame

# fixed seed rows
_LOANS = [
    (1, dt.date(2023, 1, 1), "Residential", "Denver Metro", 705, D("32.00"), D("68.00"), D("1.420"), D("320000.00"),
     D("6.500"), 360),
    (2, dt.date(2023, 4, 1), "Office CRE", "Mountain West", 640, D("44.00"), D("82.00"), D("1.050"), D("1800000.00"),
     D("7.200"), 240),
]
_MONTHS = [
    (1, dt.date(2023, 1, 1), 0, "320000", "2000", 0, "Current", "20", 1, 0, "0", "0"),
    (1, dt.date(2023, 2, 1), 1, "319000", "2000", 0, "Current", "22", 1, 0, "0", "0"),
    (1, dt.date(2023, 3, 1), 2, "318000", "2000", 15, "1-29", "25", 1, 0, "0", "0"),
    (2, dt.date(2023, 4, 1), 0, "1800000", "14000", 0, "Current", "55", 1, 0, "0", "0"),
    (2, dt.date(2023, 5, 1), 1, "1795000", "14000", 35, "30-59", "60", 2, 0, "0", "0"),
    (2, dt.date(2023, 6, 1), 2, "1790000", "14000", 95, "90+", "70", 3, 0, "0", "0"),
    (2, dt.date(2023, 7, 1), 3, "0", "14000", 999, "ChargedOff", "70", 3, 1, "1200000", "250000"),
]
_ECL = [
    (1, dt.date(2023, 3, 1), "Residential", "Denver Metro", "315000", "0.021000", "0.100600", "0.230000", 15, 1,
     "1521.45", "3193.05", "6626.30", "2830.66", "0.008986"),
    (2, dt.date(2023, 7, 1), "Office CRE", "Mountain West", "1200000", "1.000000", "1.000000", "0.520000", 999, 3,
     "624000.00", "748800.00", "904800.00", "702000.00", "0.585000"),
]


def _dec(row, schema):
    out = []
    for v, f in zip(row, schema.fields):
        out.append(D(v) if f.dataType.typeName() == "decimal" and isinstance(v, str) else v)
    return tuple(out)


def seed_mart(spark: SparkSession) -> Mart:
    loans = spark.createDataFrame(_LOANS, DIM_LOAN)
    panel = spark.createDataFrame([_dec(r, FACT_LOAN_MONTHLY) for r in _MONTHS], FACT_LOAN_MONTHLY)
    ecl = spark.createDataFrame([_dec(r, FACT_ECL) for r in _ECL], FACT_ECL)
    return Mart(dim_loan=loans, fact_loan_monthly=panel, panel_raw=panel, dim_scenario=scenario_frame(spark),
                _fact_ecl=ecl)
