"""Column functions shared by the operators.

Each takes and returns ``pyspark.sql.Column`` so the expressions stay
inside whole-stage codegen. Integer powers are written as products so the
result is bit-identical across engines.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CREDIT_SCORE_BANDS, DEFAULT, DPD_BUCKETS, RiskConfig


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo: float, hi: float) -> Column:
    """Bound ``c`` to [lo, hi] (NULL stays NULL)."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def int_pow(c, n: int) -> Column:
    """c ** n for a small positive integer n, as a left-to-right product."""
    c = _col(c)
    out = c
    for _ in range(n - 1):
        out = out * c
    return out


def sigmoid(c) -> Column:
    """Logistic function 1 / (1 + exp(-x))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c)))


def lifetime_pd(pd_12m, horizon_years: int = DEFAULT.lifetime_horizon_years) -> Column:
    """Cumulative lifetime PD under a constant hazard: 1 - (1 - clip(pd))^H."""
    p = clip(pd_12m, 0.0, 1.0)
    return F.lit(1.0) - int_pow(F.lit(1.0) - p, horizon_years)


def assign_stage(pd_12m, current_dpd, default_flag, cfg: RiskConfig = DEFAULT) -> Column:
    """IFRS 9 stage: 3 if impaired (DPD >= 90 or defaulted), 2 on SICR, else 1."""
    p, dpd, flag = _col(pd_12m), _col(current_dpd), _col(default_flag)
    impaired = (dpd >= cfg.stage3_dpd_threshold) | (flag == 1)
    sicr = (p >= cfg.stage2_pd_threshold) | (dpd >= cfg.stage2_dpd_threshold)
    return F.when(impaired, F.lit(3)).when(sicr, F.lit(2)).otherwise(F.lit(1))


def effective_pd(stage, pd_12m, pd_lifetime) -> Column:
    """PD applied per stage: 12-month for 1, lifetime for 2, 1.0 for 3."""
    s = _col(stage)
    return F.when(s == 3, F.lit(1.0)).when(s == 1, _col(pd_12m)).otherwise(_col(pd_lifetime))


def discount_factor(stage, cfg: RiskConfig = DEFAULT) -> Column:
    """1 / (1 + r)^h with h = 1 year for stage 1, H/2 for lifetime stages.

    Both factors are driver-side constants, so no per-row ``pow``.
    """
    return F.when(_col(stage) == 1, F.lit(cfg.discount_factor(1))).otherwise(F.lit(cfg.discount_factor(2)))


def is_90plus(dpd, dpd_bucket) -> Column:
    """1 when the month is 90+ DPD or charged off, else 0."""
    return F.when((_col(dpd) >= 90) | _col(dpd_bucket).isin("90+", "ChargedOff"), F.lit(1)).otherwise(F.lit(0))


def bucket_severity(bucket) -> Column:
    """Severity order of a DPD bucket: Current 0 ... 90+ 4, anything else 5."""
    b = _col(bucket)
    expr = None
    for i, name in enumerate(DPD_BUCKETS[:-1]):
        expr = F.when(b == name, F.lit(i)) if expr is None else expr.when(b == name, F.lit(i))
    return expr.otherwise(F.lit(len(DPD_BUCKETS) - 1))


def vintage_label(date_col) -> Column:
    """Origination cohort label ``YYYY-Qn``."""
    d = _col(date_col)
    return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))


def score_band(credit_score) -> Column:
    """Credit-score band label of the cohort query."""
    s = _col(credit_score)
    expr = None
    for lo, label in CREDIT_SCORE_BANDS:
        if lo is None:
            return expr.otherwise(F.lit(label))
        expr = F.when(s >= lo, F.lit(label)) if expr is None else expr.when(s >= lo, F.lit(label))
    return expr


def hhi(exposure) -> Column:
    """Herfindahl index aggregate: sum(x^2) / sum(x)^2, 0 when the total <= 0.

    Use it on per-group exposures (one row per group) inside ``agg``.
    """
    x = _col(exposure).cast("double")
    total = F.sum(x)
    return F.when(total > 0, F.sum(x * x) / (total * total)).otherwise(F.lit(0.0))


def ratio_round(num, den, digits: int) -> Column:
    """round(num / den, digits) for integer counts, exact and half-up.

    Count ratios (rates of 0/1 flags, shares of counts) can land exactly on
    a rounding tie; integer arithmetic rounds those the same in every
    engine, where floating point would not. NULL when ``den`` is 0.
    """
    from pyspark.sql import types as T
    scale = 10 ** digits
    wide = T.DecimalType(38, 0)  # no overflow for sums over any realistic row count
    n, d = _col(num).cast(wide), _col(den).cast(wide)
    q = n * F.lit(2 * scale).cast(wide) + d
    return F.when(d > 0, idiv(q, d * F.lit(2).cast(wide)).cast("double") / F.lit(float(scale)))


def round_cents(x) -> Column:
    """Money rounded to cents through integer cents: round(x * 100) / 100.

    ``round(x, 2)`` on a double rounds its shortest decimal form in one
    engine and the binary value times 100 in another; products of two-place
    amounts hit exact ties often enough to differ. A half at whole-cent
    granularity is exactly representable, so rounding ``x * 100`` to an
    integer agrees everywhere.
    """
    return F.round(_col(x) * 100.0) / F.lit(100.0)


def micros(x) -> Column:
    """A 6-place value as an exact integer count of millionths."""
    return F.round(_col(x) * 1000000.0).cast("long")


def money(x) -> Column:
    """DECIMAL(14,2) of a non-negative double amount, via integer cents."""
    from decimal import Decimal
    from pyspark.sql import types as T
    cents = F.round(_col(x) * 100.0).cast("long")
    return (cents.cast(T.DecimalType(18, 0)) * F.lit(Decimal("0.01"))).cast(T.DecimalType(14, 2))


def idiv(a, b) -> Column:
    """Integral division ``a div b`` (truncates toward zero)."""
    return F.call_function("div", _col(a), _col(b))
