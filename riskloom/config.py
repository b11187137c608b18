"""Frozen risk parameters.

Fixed values that must equal the reference model for identical results: thresholds, scenario table, PD
bands, sector names, feature lists and sector coefficients. The slopes of the scorecards stand in
``operators/portfolio.py``, the watch score's weights in ``operators/watchlist.py``, and the SQL twins state what they compare
with once more.
"""
from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values (must match the reference model) -------------------------
SECTORS = ("Residential", "Multifamily", "Retail CRE", "Office CRE", "Industrial")

# scenario: (weight, pd_multiplier, lgd_multiplier, unemployment, rate_shock_bps, rent_shock_pct)
SCENARIOS = (
    ("base", 0.50, 1.00, 1.00, 4.0, 0, 0.00),
    ("downside", 0.35, 1.75, 1.20, 7.0, 150, -0.10),
    ("severe", 0.15, 3.00, 1.45, 10.0, 300, -0.25),
)

# PD score bands: label, low (inclusive), high (exclusive)
SCORE_BANDS = (
    ("A (Prime)", 0.00, 0.03),
    ("B (Near-prime)", 0.03, 0.08),
    ("C (Acceptable)", 0.08, 0.15),
    ("D (Watch)", 0.15, 0.30),
    ("E (Substandard)", 0.30, 1.01),
)

# single-factor sensitivity shocks: label, pd multiplier, lgd multiplier
SENSITIVITY_SHOCKS = (
    ("PD +25% (unemployment proxy)", 1.25, 1.00),
    ("PD +50% (unemployment proxy)", 1.50, 1.00),
    ("LGD +15% (collateral/rent proxy)", 1.00, 1.15),
    ("LGD +30% (collateral/rent proxy)", 1.00, 1.30),
    ("PD +25% & LGD +15% (rate shock)", 1.25, 1.15),
)

# delinquency buckets in severity order
DPD_BUCKETS = ("Current", "1-29", "30-59", "60-89", "90+", "ChargedOff")

# credit-score bands of the cohort query: lower bound, label
CREDIT_SCORE_BANDS = (
    (740, "1. 740+ (Prime)"),
    (680, "2. 680-739 (Near-prime)"),
    (620, "3. 620-679 (Subprime)"),
    (None, "4. <620 (Deep subprime)"),
)

# scorecard used to derive PD: intercept and coefficients, sector add-ons
PD_INTERCEPT = -3.2
PD_SECTOR_ADDON = {"Residential": -0.15, "Multifamily": -0.05, "Retail CRE": 0.25,
                   "Office CRE": 0.45, "Industrial": 0.05}
# LGD scorecard sector base
LGD_SECTOR_BASE = {"Residential": 0.20, "Multifamily": 0.28, "Retail CRE": 0.42,
                   "Office CRE": 0.50, "Industrial": 0.35}

# model feature lists
PD_FEATURES = ("credit_score", "dti", "ltv", "dscr", "loan_amount", "interest_rate",
               "term_months", "loan_age_months", "utilization", "missed_payments_12m",
               "max_dpd_12m")
PD_CATEGORICAL = ("sector", "region")
LGD_FEATURES = ("ltv", "dscr", "credit_score", "loan_amount", "interest_rate", "utilization")
LGD_CATEGORICAL = ("sector", "region")
EWS_FEATURES = ("avg_utilization_12m", "max_utilization_12m", "utilization_trend",
                "missed_payments_12m", "max_dpd_12m", "avg_dpd_12m", "current_dpd",
                "dti", "dscr", "credit_score")

# monitoring triggers (amber, red)
MONITOR_TRIGGERS = (
    ("roc_auc", "below", 0.85, 0.80),
    ("brier", "above", 0.10, 0.15),
    ("psi", "at_or_above", 0.10, 0.25),
)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskConfig:
    """All tunable assumptions in one frozen object."""

    # fixed values as above: thresholds of staging, discounting, policy, watchlist and concentration
    lifetime_horizon_years: int = 5
    stage2_pd_threshold: float = 0.15
    stage2_dpd_threshold: int = 30
    stage3_dpd_threshold: int = 90
    discount_rate: float = 0.08
    policy_threshold: float = 0.15
    watchlist_size: int = 25
    top_decile: float = 0.10
    test_share: float = 0.30
    hhi_high: float = 0.25
    hhi_moderate: float = 0.15
    scenarios: tuple = field(default=SCENARIOS)
    score_bands: tuple = field(default=SCORE_BANDS)
    # a key holding more rows than this is treated as hot by the
    # per-key sequence operators (split off and ranked in range partitions);
    # None: no key is hot (known from a check made before), so none is looked for
    hot_key_rows: int | None = 200_000
    # upper bound on the number of hot keys we are willing to broadcast
    max_broadcast_keys: int = 100_000

    @property
    def scenario_names(self) -> tuple:
        return tuple(s[0] for s in self.scenarios)

    def discount_factor(self, stage: int) -> float:
        horizon = 1.0 if stage == 1 else self.lifetime_horizon_years / 2.0
        return 1.0 / (1.0 + self.discount_rate) ** horizon


DEFAULT = RiskConfig()
