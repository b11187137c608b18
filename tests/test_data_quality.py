"""Each data-quality rule counts a seeded violation, NULLs included."""
import pytest
from pyspark.sql import functions as F

from riskloom.operators.monitoring import data_quality

SEEDED = [
    ("credit_score_out_of_range", "loan", "credit_score", None), ("credit_score_out_of_range", "loan", "credit_score", 10),
    ("ltv_out_of_range", "loan", "ltv_orig", None), ("dti_out_of_range", "loan", "dti", None), ("dscr_out_of_range", "loan", "dscr", None),
    ("rate_out_of_range", "loan", "interest_rate", None), ("term_not_allowed", "loan", "term_months", None), ("dim_loan_nulls", "loan", "sector", None),
    ("ead_not_positive", "book", "ead", None), ("ead_not_positive", "book", "ead", 0), ("pd_missing_or_out_of_range", "book", "true_pd", None),
    ("default_flag_not_binary", "book", "default_flag", None), ("default_flag_not_binary", "book", "default_flag", 2), ("pd_feature_nulls", "book", "dti", None),
]


def failures(mart, loans, book):
    out = data_quality(loans, mart.fact_loan_monthly, book, mart.fact_ecl)
    return {r["rule"]: r["failures"] for r in out.collect()}


def spoil(df, column, value, where):
    return df.withColumn(column, F.when(where, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column)))


@pytest.fixture(scope="module")
def small(mart):
    return mart.dim_loan.cache(), mart.portfolio.cache()


def test_seeded_violations(mart, small):
    loans, book = small
    clean = failures(mart, loans, book)
    one = F.col("loan_id") == loans.agg(F.min("loan_id")).first()[0]
    for rule, table, column, value in SEEDED:
        found = failures(mart, spoil(loans, column, value, one) if table == "loan" else loans, spoil(book, column, value, one) if table == "book" else book)
        assert found[rule] == clean[rule] + 1, (rule, column, value)


def test_defaulted_loan_without_lgd(mart, small):
    loans, book = small
    one = F.col("loan_id") == book.where("default_flag = 1").agg(F.min("loan_id")).first()[0]
    assert failures(mart, loans, spoil(book, "lgd", None, one))["lgd_missing_or_out_of_range"] == failures(mart, loans, book)["lgd_missing_or_out_of_range"] + 1


def test_each_table_is_scanned_once(spark, mart):
    from riskloom.sources.mart_store import materialize
    written = materialize(mart, buckets=2)
    plan = data_quality(written.dim_loan, written.fact_loan_monthly, written.portfolio, written.fact_ecl)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 4
    full = data_quality(written.dim_loan, written.fact_loan_monthly, written.portfolio, written.fact_ecl)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(loan_id" not in full and "Exchange hashpartitioning(_l" not in full


def test_keys_are_counted(spark, mart, small):
    """Repeated, orphan and unscored keys: as many failures as rows seeded."""
    loans, book = small
    panel, ecl = mart.fact_loan_monthly, mart.fact_ecl
    clean = failures(mart, loans, book)
    some = [r["loan_id"] for r in loans.select("loan_id").orderBy("loan_id").limit(3).collect()]
    rows = panel.where(F.col("loan_id") == some[0]).count()
    got = {r["rule"]: r["failures"] for r in data_quality(loans.where(F.col("loan_id") != some[0]).unionByName(loans.where(F.col("loan_id") == some[1])),
                                                           panel.unionByName(panel.where(F.col("loan_id") == some[2])).unionByName(panel.limit(2).withColumn("loan_id", F.lit(None).cast("long"))),
                                                           book, ecl.where(~F.col("loan_id").isin(some))).collect()}
    assert got["panel_orphan_rows"] == clean["panel_orphan_rows"] + rows + 2
    assert got["dim_loan_duplicate_id"] == clean["dim_loan_duplicate_id"] + 1
    assert got["panel_duplicate_key"] >= clean["panel_duplicate_key"] + panel.where(F.col("loan_id") == some[2]).count()
    assert got["unscored_loans"] == clean["unscored_loans"] + book.where(F.col("loan_id").isin(some)).count()
