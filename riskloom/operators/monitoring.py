"""Model validation and monitoring: PSI, band calibration, triggers,
Hosmer-Lemeshow, binomial traffic light and data-quality rules."""
from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, MONITOR_TRIGGERS, PD_CATEGORICAL, PD_FEATURES, RiskConfig
from .metrics import band_of
from .selection import digits_of, mark_smallest


def hash_split(key: str = "loan_id", test_share: float = DEFAULT.test_share) -> F.Column:
    """Deterministic 'train' / 'test' label from an integer hash of the key.

    Every stratum is cut at the same hash threshold, so each keeps its share
    in expectation; the same rows land in the test set on every run.
    """
    u = ((F.col(key) % 1000003) * 1103515245 + 12345) % 2147483648
    cut = int(test_share * 100)
    return F.when(u * 100 < F.lit(cut) * 2147483648, F.lit("test")).otherwise(F.lit("train"))


def exact_stratified_split(df: DataFrame, label: str, key: str = "loan_id",
                           test_share: float = DEFAULT.test_share) -> DataFrame:
    """Add ``split`` with exactly round(test_share * n_c) test rows in each stratum c.

    The test rows of a stratum are those with the smallest (hash of the key, key), the same
    on every run; the cutting hash is found from counts (``selection.mark_smallest``), so no row is sorted or moved.
    """
    hashed = ((F.col(key) % 1000003) * 1103515245 + 12345) % 2147483648
    digits = digits_of(F.coalesce(hashed, F.lit(0)), 32) + digits_of(F.coalesce(F.col(key), F.lit(0)))
    marked = mark_smallest(df, label, digits, lambda n: F.floor(n * F.lit(float(test_share)) + F.lit(0.5)), "_test")
    return marked.withColumn("split", F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_test")


def psi(expected: DataFrame, actual: DataFrame, bucket: str, epsilon: float | None = None) -> DataFrame:
    """Population stability index between two samples bucketed by ``bucket``.

    sum((a - e) * ln(a / e)) over buckets. Default as written in the
    reference: inner join (buckets missing on either side drop out). With
    ``epsilon``, a full outer join and shares floored at ``epsilon``.
    """
    def counts(df):
        return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    return psi_shares(counts(expected), counts(actual), bucket, "_n", epsilon)


def psi_shares(expected: DataFrame, actual: DataFrame, bucket: str, n: str, epsilon: float | None = None) -> DataFrame:
    """``psi`` from two histograms: one row per bucket with ``n`` rows."""
    def shares(df, name):
        return df.select(bucket, (F.col(n) / F.sum(n).over(Window.partitionBy())).alias(name))  # few buckets
    e, a = shares(expected, "_e"), shares(actual, "_a")
    if epsilon is None:
        j = e.join(a, bucket)
        ev, av = F.col("_e"), F.col("_a")
    else:
        j = e.join(a, bucket, "full")
        ev = F.greatest(F.coalesce(F.col("_e"), F.lit(0.0)), F.lit(epsilon))
        av = F.greatest(F.coalesce(F.col("_a"), F.lit(0.0)), F.lit(epsilon))
    return j.agg(F.round(F.sum((av - ev) * F.ln(av / ev)), 4).alias("psi"))


def psi_band(scores: DataFrame, cfg: RiskConfig = DEFAULT, score: str = "score",
             epsilon: float | None = None) -> DataFrame:
    """v1: PSI of the PD-band distribution, test (current) vs train (baseline)."""
    b = scores.withColumn("_band", band_of(score, cfg))
    return psi(b.filter(F.col("split") == "train"), b.filter(F.col("split") == "test"), "_band", epsilon)


def psi_features(book: DataFrame, features=("credit_score", "ltv", "dti"), n_bins: int = 10) -> DataFrame:
    """v2: PSI per input feature on baseline (train) decile bins, test vs train."""
    long = book.select("split", F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("x")) \
        .select("split", "x.feature", "x.value")
    probs = [i / n_bins for i in range(1, n_bins)]
    # value -> count map of the exact percentile stays bounded: values rounded to 6 places
    # counted per value first, so that the percentile merges one entry per distinct value
    counts = long.filter(F.col("split") == "train").groupBy("feature", F.round("value", 6).alias("value")).agg(F.count(F.lit(1)).alias("_n"))
    edges = counts.groupBy("feature").agg(F.percentile("value", probs, F.col("_n")).alias("_edges"))
    binned = long.join(F.broadcast(edges), "feature") \
        .withColumn("bin", F.size(F.filter("_edges", lambda e: e < F.round("value", 6))))
    g = binned.groupBy("feature", "split", "bin").agg(F.count(F.lit(1)).alias("_n"))
    g = g.withColumn("_share", F.col("_n") / F.sum("_n").over(Window.partitionBy("feature", "split")))
    e = g.filter(F.col("split") == "train").select("feature", "bin", F.col("_share").alias("_e"))
    a = g.filter(F.col("split") == "test").select("feature", "bin", F.col("_share").alias("_a"))
    j = e.join(a, ["feature", "bin"])
    return j.groupBy("feature").agg(F.round(F.sum((F.col("_a") - F.col("_e")) * F.ln(F.col("_a") / F.col("_e"))), 4)
                                    .alias("psi")).orderBy("feature")


def band_calibration(bands: DataFrame, amber: float = 0.25, red: float = 0.50) -> DataFrame:
    """v3: observed / expected default rate per band with a green / amber / red status."""
    ratio = F.col("actual_default_rate") / F.when(F.col("avg_predicted_pd") > 0, F.col("avg_predicted_pd"))
    dev = F.abs(F.col("_ratio") - F.lit(1.0))
    status = F.when(F.col("_ratio").isNull(), F.lit("n/a")).when(dev > red, F.lit("red")) \
        .when(dev > amber, F.lit("amber")).otherwise(F.lit("green"))
    return bands.withColumn("_ratio", ratio).select(
        "band", "n_loans", "avg_predicted_pd", "actual_default_rate",
        F.round("_ratio", 4).alias("obs_to_exp"), status.alias("status"))


def monitor_triggers(metrics: DataFrame) -> DataFrame:
    """v4: status of each monitored metric against the amber / red triggers.

    ``metrics`` is one row with columns roc_auc, brier and psi.
    """
    spark = metrics.sparkSession
    trig = spark.createDataFrame([(m, d, float(a), float(r)) for m, d, a, r in MONITOR_TRIGGERS],
                                 "metric string, direction string, amber double, red double")
    long = metrics.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m, *_ in MONITOR_TRIGGERS
    ])).alias("x")).select("x.metric", "x.value")
    j = long.join(F.broadcast(trig), "metric")
    v, a, r = F.col("value"), F.col("amber"), F.col("red")
    below = F.when(v < r, "red").when(v < a, "amber").otherwise("green")
    above = F.when(v > r, "red").when(v > a, "amber").otherwise("green")
    at_above = F.when(v >= r, "red").when(v >= a, "amber").otherwise("green")
    status = F.when(F.col("direction") == "below", below).when(F.col("direction") == "above", above).otherwise(at_above)
    return j.select("metric", "value", "amber", "red", status.alias("status")).orderBy("metric")


def _hl_tail(stat: F.Column, dof: F.Column) -> F.Column:
    """P(chi2_k > x), NULL for k < 1.

    Even k: exp(-x/2) * sum_{i < k/2} (x/2)^i / i!. Odd k: one minus the lower
    incomplete gamma series h^a e^-h / Gamma(a+1) * sum_n h^n / ((a+1)...(a+n)) with a = k/2, h = x/2
    (all terms positive; zero to 6 places above h = 600, where e^-h would underflow).
    """
    half = stat / 2.0
    series = F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.floor(dof / 2) - 1, F.lit(0)).cast("int")), F.struct(F.lit(0.0).alias("s"), F.lit(1.0).alias("t")),
        lambda acc, i: F.struct((acc["s"] + acc["t"]).alias("s"), (acc["t"] * half / (i + 1)).alias("t")),
        lambda acc: acc["s"])
    a = dof / 2.0
    # h^a / Gamma(a + 1) as sqrt(h) / Gamma(3/2) * prod_{i = 1}^{a - 1/2} h / (i + 1/2)
    lead = F.aggregate(F.filter(F.sequence(F.lit(0), F.floor(dof / 2).cast("int")), lambda i: i > 0),
                       F.sqrt(half) * F.lit(2.0) / F.sqrt(F.lit(math.pi)), lambda acc, i: acc * half / (i + F.lit(0.5)))
    lower = F.aggregate(
        F.sequence(F.lit(1), (F.floor(half) * 3 + 60).cast("int")), F.struct(F.lit(1.0).alias("s"), F.lit(1.0).alias("t")),
        lambda acc, i: F.struct((acc["s"] + acc["t"] * half / (a + i)).alias("s"), (acc["t"] * half / (a + i)).alias("t")),
        lambda acc: acc["s"])
    odd = F.when(half > 600, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - lead * F.exp(-half) * lower))
    return F.when(dof > 0, F.when(dof % 2 == 0, F.exp(-half) * series).otherwise(odd))


def hosmer_lemeshow(scores: DataFrame, n_bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """v5: Hosmer-Lemeshow statistic over the quantile calibration bins.

    sum over bins of (O - E)^2 / (E (1 - E / n)); dof = bins - 2.
    """
    from .metrics import quantile_bin
    g = quantile_bin(scores, n_bins, score).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(score).alias("e"), F.sum(F.col(label).cast("double")).alias("o"))
    term = (F.col("o") - F.col("e")) * (F.col("o") - F.col("e")) / (F.col("e") * (F.lit(1.0) - F.col("e") / F.col("n")))
    h = g.agg(F.sum(F.when((F.col("e") > 0) & (F.col("e") < F.col("n")), term)).alias("_hl"),
              F.count(F.lit(1)).alias("_bins"))
    dof = F.col("_bins") - 2
    return h.select(F.round("_hl", 6).alias("hl_statistic"), dof.cast("long").alias("dof"),
                    F.round(_hl_tail(F.col("_hl"), dof), 6).alias("p_value"))


def binomial_light(scores: DataFrame, cfg: RiskConfig = DEFAULT, amber_z: float = 1.645, red_z: float = 2.326,
                   score: str = "score", label: str = "label") -> DataFrame:
    """v5b: one-sided z-score of observed vs expected defaults per PD band (normal approximation)."""
    from ..functions.columns import micros, ratio_round
    g = scores.groupBy(band_of(score, cfg).alias("band")).agg(
        F.count(F.lit(1)).alias("n_loans"), F.sum(score).alias("e"), F.sum(micros(score)).alias("_eu"),
        F.sum(F.col(label).cast("long")).alias("o"))
    z = (F.col("o") - F.col("e")) / F.sqrt(F.col("e") * (F.lit(1.0) - F.col("e") / F.col("n_loans")))
    g = g.withColumn("_z", F.when((F.col("e") > 0) & (F.col("e") < F.col("n_loans")), z))
    light = F.when(F.col("_z").isNull(), F.lit("n/a")).when(F.col("_z") > red_z, F.lit("red")) \
        .when(F.col("_z") > amber_z, F.lit("amber")).otherwise(F.lit("green"))
    return g.select("band", F.col("n_loans").cast("long"), ratio_round("_eu", F.lit(1000000), 4).alias("expected_defaults"),
                    F.col("o").cast("long").alias("observed_defaults"), F.round("_z", 4).alias("z_score"),
                    light.alias("traffic_light")).orderBy("band")


def _fails(rule: F.Column) -> F.Column:
    """True where a rule does not hold; a NULL value does not satisfy it."""
    return ~F.coalesce(rule, F.lit(False))


def data_quality(loans: DataFrame, panel: DataFrame, book: DataFrame, ecl: DataFrame) -> DataFrame:
    """v6: failing-row counts per rule (0 = pass).

    Each table is scanned once: loans and panel are counted per loan and met in one full join, and so are book and ECL. On
    tables bucketed by loan neither the counts nor the joins shuffle; on others Spark filters the larger
    side by a Bloom filter of the smaller where it pays.
    """
    from ..functions.columns import vintage_label
    loan_rules = {
        "credit_score_out_of_range": _fails(F.col("credit_score").between(520, 820)),
        "ltv_out_of_range": _fails(F.col("ltv_orig").between(30, 110)),
        "dti_out_of_range": _fails(F.col("dti").between(5, 75)),
        "dscr_out_of_range": _fails(F.col("dscr").between(0.4, 3.5)),
        "rate_out_of_range": _fails(F.col("interest_rate").between(3, 14)),
        "term_not_allowed": _fails(F.col("term_months").isin(60, 120, 180, 240, 360)),
        "dim_loan_nulls": F.col("sector").isNull() | F.col("region").isNull()}
    per_loan = loans.groupBy("loan_id").agg(F.count(F.lit(1)).alias("_loans"), F.min(vintage_label("origination_date")).alias("_v"),
                                            *[F.count_if(rule).alias(name) for name, rule in loan_rules.items()])
    keys = panel.groupBy("loan_id", "snapshot_month").agg(F.count(F.lit(1)).alias("_c"), F.count_if(F.col("months_on_book") == 0).alias("_z"))
    per_panel = keys.groupBy("loan_id").agg(F.sum("_c").alias("_rows"), F.sum(F.col("_c") - 1).alias("_repeats"), F.sum("_z").alias("_age0"))
    met = per_loan.withColumnRenamed("loan_id", "_l").join(per_panel, F.col("_l") == F.col("loan_id"), "full")
    known = F.col("_loans").isNotNull()
    # per vintage first: which have no month 0 is a count over a few rows
    by_vintage = met.groupBy("_v").agg(
        F.sum(F.when(known, F.col("_loans") - F.col("_l").isNotNull().cast("long"))).alias("dim_loan_duplicate_id"),
        *[F.sum(name).alias(name) for name in loan_rules], F.sum("_repeats").alias("panel_duplicate_key"),
        F.sum(F.when(~known, F.col("_rows"))).alias("panel_orphan_rows"),
        F.count_if(known & F.col("_rows").isNotNull()).alias("_met"), F.sum(F.when(known, F.col("_age0"))).alias("_zero"))
    sums = ["dim_loan_duplicate_id", *loan_rules, "panel_duplicate_key", "panel_orphan_rows"]
    dl = by_vintage.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
                        F.count_if((F.col("_met") > 0) & (F.col("_zero") == 0)).alias("vintages_without_age0"))
    book_rules = {
        "lgd_missing_or_out_of_range": (F.col("default_flag") == 1) & _fails(F.col("lgd").between(0, 1)),
        "lgd_on_performing_loan": (F.col("default_flag") == 0) & F.col("lgd").isNotNull(),
        "ead_not_positive": _fails(F.col("ead") > 0),
        "pd_missing_or_out_of_range": _fails(F.col("true_pd").between(0, 1)),
        "default_flag_not_binary": _fails(F.col("default_flag").isin(0, 1)),
        "pd_feature_nulls": reduce(or_, [F.col(c).isNull() for c in PD_FEATURES + PD_CATEGORICAL])}
    per_book = book.groupBy("loan_id").agg(F.count(F.lit(1)).alias("_rows"), F.sum("default_flag").alias("_flags"), F.count("default_flag").alias("_flagged"),
                                           *[F.count_if(rule).alias(name) for name, rule in book_rules.items()])
    scored = ecl.groupBy("loan_id").agg(F.lit(1).alias("_scored")).withColumnRenamed("loan_id", "_s")
    pf = per_book.join(scored, F.col("loan_id") == F.col("_s"), "left").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in book_rules],
        F.when(_fails((F.try_divide(F.sum("_flags"), F.sum("_flagged"))).between(0.02, 0.40)), F.lit(1)).otherwise(F.lit(0)).alias("default_rate_implausible"),
        F.coalesce(F.sum(F.when(F.col("_scored").isNull(), F.col("_rows"))), F.lit(0)).alias("unscored_loans"))
    from .scalars import one_row
    one = one_row(dl, pf)
    rules = [c for c in one.columns]
    stack = "stack({}, {}) as (rule, failures)".format(
        len(rules), ", ".join(f"'{r}', CAST(`{r}` AS BIGINT)" for r in rules))
    return one.selectExpr(stack).orderBy("rule")
