"""Model-performance measures over a score table (score, 0/1 label).

Exact measures, computed distributedly: AUC by rank-sum with ties at half,
average precision as the step-wise sum of (R_i - R_{i-1}) P_i, curve
points, Brier, confusion matrix at a policy cut, quantile calibration bins,
PD bands, top-fraction capture and top-k watchlists.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..functions.columns import micros, ratio_round, round_cents
from .ranking import prefix_sums, score_counts
from .scalars import scalar_row


def auc_exact(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC-AUC (Mann-Whitney with ties at half): one row ``roc_auc``."""
    c = score_counts(scores, score, label)
    c = prefix_sums(c, "_score", ["neg"])
    num = F.sum(F.col("pos").cast("double") * (F.col("neg_cum") - F.col("neg") + F.col("neg") * 0.5))
    return c.agg(num.alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n")).select(
        F.round(F.try_divide(F.col("_u"), F.col("_p").cast("double") * F.col("_n").cast("double")), 6).alias("roc_auc"))


def _desc_curve(scores: DataFrame, score: str, label: str) -> DataFrame:
    c = score_counts(scores, score, label)
    c = prefix_sums(c, "_score", ["pos", "neg"], descending=True)
    tot = scalar_row(c.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    return c.withColumn("_tot", tot).withColumn("_P", F.col("_tot.P")).withColumn("_N", F.col("_tot.N")).drop("_tot")


def average_precision(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Average precision (area under the step PR curve): one row ``pr_auc``."""
    c = _desc_curve(scores, score, label)
    prec = F.col("pos_cum").cast("double") / (F.col("pos_cum") + F.col("neg_cum")).cast("double")
    return c.agg(F.sum(F.try_divide(F.col("pos").cast("double"), F.col("_P").cast("double")) * prec).alias("_ap")).select(
        F.round("_ap", 6).alias("pr_auc"))


def auc_and_ap(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC-AUC and average precision from ONE descending prefix-sum pass.

    Negatives strictly below a score = N - (descending inclusive count) ;
    one row ``roc_auc``, ``pr_auc``.
    """
    c = _desc_curve(scores, score, label)
    below = F.col("_N") - F.col("neg_cum")
    u = F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") * 0.5)
    prec = F.col("pos_cum").cast("double") / (F.col("pos_cum") + F.col("neg_cum")).cast("double")
    ap = F.try_divide(F.col("pos").cast("double"), F.col("_P").cast("double")) * prec
    return c.agg(F.sum(u).alias("_u"), F.sum(ap).alias("_ap"), F.first("_P").alias("_P"), F.first("_N").alias("_N")) \
        .select(F.round(F.try_divide(F.col("_u"), F.col("_P").cast("double") * F.col("_N").cast("double")), 6).alias("roc_auc"),
                F.round("_ap", 6).alias("pr_auc"))


def anchor(c: DataFrame, **point: float) -> DataFrame:
    """The curve's starting point: no score is high enough, so the threshold is null."""
    one = c.sparkSession.range(1)
    return one.select(F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(k) for k, v in point.items()])


def roc_points(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """ROC curve: one row per distinct threshold (fpr, tpr at score >= threshold)."""
    c = _desc_curve(scores, score, label)
    return c.select(F.col("_score").alias("threshold"),
                    ratio_round("neg_cum", "_N", 6).alias("fpr"),
                    ratio_round("pos_cum", "_P", 6).alias("tpr")) \
        .unionByName(anchor(c, fpr=0.0, tpr=0.0)).orderBy(F.desc_nulls_first("threshold"))


def pr_points(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """PR curve: one row per distinct threshold (recall, precision)."""
    c = _desc_curve(scores, score, label)
    return c.select(F.col("_score").alias("threshold"),
                    ratio_round("pos_cum", "_P", 6).alias("recall"),
                    ratio_round("pos_cum", F.col("pos_cum") + F.col("neg_cum"), 6).alias("precision")) \
        .unionByName(anchor(c, recall=0.0, precision=1.0)).orderBy(F.desc_nulls_first("threshold"))


def brier(scores: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Mean squared error of the probability: one row ``brier``."""
    d = F.col(score) - F.col(label).cast("double")
    return scores.agg(F.round(F.avg(d * d), 6).alias("brier"))


def confusion(scores: DataFrame, threshold: float = DEFAULT.policy_threshold,
              score: str = "score", label: str = "label") -> DataFrame:
    """2 x 2 counts at ``score >= threshold``; empty cells kept as 0."""
    g = scores.groupBy(F.col(label).cast("long").alias("actual"),
                       (F.col(score) >= threshold).cast("long").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    grid = scores.sparkSession.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual long, predicted long")
    return grid.join(g, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_loans")) \
        .orderBy("actual", "predicted")


def calibration_bins(scores: DataFrame, n_bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """Quantile calibration: bin = number of inner quantile edges below the score
    (see ``quantile_bin``); mean predicted and observed rate per non-empty bin."""
    g = quantile_bin(scores, n_bins, score).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(micros(score)).alias("_pu"), F.sum(F.col(label).cast("long")).alias("_y"))
    return g.select(F.col("bin").cast("long"), F.col("n").cast("long"),
                    ratio_round("_pu", F.col("n") * 1000000, 6).alias("mean_predicted"),
                    ratio_round("_y", "n", 6).alias("observed_rate")).orderBy("bin")


def quantile_bin(scores: DataFrame, n_bins: int, score: str = "score") -> DataFrame:
    """Add ``bin``: the number of inner quantile edges below the score.

    Edges are exact percentiles (linear interpolation) of the score rounded
    to 6 places: the percentile aggregate keeps a value -> count map, and
    rounding bounds it at 10^6 + 1 entries whatever the row count (a no-op
    for scorecard PDs, which are already 6-place values).
    """
    probs = [i / n_bins for i in range(1, n_bins)]
    value = F.round(F.col(score), 6)
    counts = scores.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))  # one entry per value reaches the merge
    edges = scalar_row(counts.agg(F.percentile("v", probs, F.col("n")).alias("e")))["e"]
    j = scores.withColumn("_edges", edges)
    return j.withColumn("bin", F.size(F.filter("_edges", lambda e: e < value))).drop("_edges")


def band_of(score_col: str, cfg: RiskConfig = DEFAULT) -> F.Column:
    """PD band label of a score (half-open [low, high))."""
    expr = None
    for label, lo, hi in cfg.score_bands:
        cond = (F.col(score_col) >= lo) & (F.col(score_col) < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def score_bands(scores: DataFrame, cfg: RiskConfig = DEFAULT, score: str = "score", label: str = "label") -> DataFrame:
    """PD bands: loans, share of book, mean PD, observed rate (0 for empty bands)."""
    spark = scores.sparkSession
    bands = spark.createDataFrame([(b, float(lo), float(min(hi, 1.0)), i) for i, (b, lo, hi) in enumerate(cfg.score_bands)],
                                  "band string, pd_low double, pd_high double, _ord int")
    g = scores.groupBy(band_of(score, cfg).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col(score) * 1000000.0).cast("long")).alias("_pmicro"),
        F.sum(F.col(label).cast("long")).alias("_y"))
    total = scalar_row(scores.agg(F.count(F.lit(1)).alias("n")))["n"]
    j = bands.join(g, "band", "left").withColumn("_total", total)
    n = F.coalesce(F.col("n"), F.lit(0))
    return j.select(
        "band", "pd_low", "pd_high", n.cast("long").alias("n_loans"),
        F.coalesce(ratio_round(n, "_total", 6), F.lit(0.0)).alias("pct_of_book"),
        F.coalesce(ratio_round("_pmicro", n * 1000000, 6), F.lit(0.0)).alias("avg_predicted_pd"),
        F.coalesce(ratio_round("_y", n, 6), F.lit(0.0)).alias("actual_default_rate"), "_ord",
    ).orderBy("_ord").drop("_ord")


def top_fraction_capture(scores: DataFrame, fraction: float = DEFAULT.top_decile, score: str = "score",
                         label: str = "label", key: str = "loan_id") -> DataFrame:
    """Share of all events among the top ``max(1, floor(fraction * n))`` rows by score.

    Ties are broken by ``key``. Rows are counted per distinct score; the running counts
    give the score at which the top ends, and only the rows tied there are ranked by key.
    """
    base = scores.select(key, F.col(score).alias("_score"), F.col(label).cast("long").alias("_y"), F.lit(1).cast("long").alias("_one"))
    counts = base.groupBy("_score").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_y").alias("_events"))
    counts = prefix_sums(counts, "_score", ["_rows"], descending=True)
    n = scalar_row(counts.agg(F.sum("_rows").alias("n")))["n"]
    k = F.greatest(F.lit(1), F.floor(n * F.lit(float(fraction)))).cast("long")
    last = F.col("_rows_cum") - F.col("_rows")  # rows above this score
    whole = counts.withColumn("_k", k).agg(
        F.coalesce(F.sum(F.when(F.col("_rows_cum") <= F.col("_k"), F.col("_events"))), F.lit(0)).alias("above"),
        F.max(F.when((last < F.col("_k")) & (F.col("_rows_cum") > F.col("_k")), F.struct("_score", (F.col("_k") - last).alias("take")))).alias("cut"),
        F.sum("_events").alias("events"), F.sum("_rows").alias("n"))
    top = whole.first()  # one row: the cutting score, how many of its rows are in the top, totals
    captured = F.lit(top["above"])
    out = scores.sparkSession.range(1).select(
        F.lit(top["n"] or 0).cast("long").alias("n_scored"), F.lit(top["events"] or 0).cast("long").alias("events"))
    if top["cut"] is not None:
        tied = prefix_sums(base.where(F.col("_score").eqNullSafe(F.lit(top["cut"]["_score"]))).groupBy(key).agg(F.sum("_one").alias("_one"), F.sum("_y").alias("_y")), key, ["_one"])
        captured = captured + F.coalesce(scalar_row(tied.agg(F.sum(F.when(F.col("_one_cum") <= F.lit(top["cut"]["take"]), F.col("_y"))).alias("y")))["y"], F.lit(0))
    return out.withColumn("captured", captured.cast("long")).withColumn(
        "top_decile_capture_rate", ratio_round("captured", F.greatest(F.lit(1), F.col("events")), 6))


def top_k_watchlist(scored: DataFrame, k: int = DEFAULT.watchlist_size, score: str = "ews_score",
                    key: str = "loan_id") -> DataFrame:
    """Top-k rows by score (ties by key) with score x EAD as loss at risk."""
    top = scored.orderBy(F.desc(score), F.asc(key)).limit(k)
    return top.withColumn("expected_loss_at_risk", round_cents(F.col(score) * F.col("ead"))) \
        .withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.asc(key))).cast("long"))


def regression_metrics(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE, R2, means and count of a regression (one row)."""
    e = F.col(actual) - F.col(predicted)
    # means and MAE from exact sums of millionths (ties round the same everywhere)
    g = pred.agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(micros(actual) - micros(predicted))).alias("_ae"),
                 F.avg(e * e).alias("mse"), F.sum(micros(actual)).alias("_a"), F.sum(micros(predicted)).alias("_p"),
                 F.var_pop(actual).alias("_var"))
    n_u = F.col("n") * 1000000
    return g.select(F.col("n").cast("long"), ratio_round("_ae", n_u, 6).alias("mae"),
                    F.round(F.sqrt("mse"), 6).alias("rmse"),
                    F.round(F.lit(1.0) - F.col("mse") / F.col("_var"), 6).alias("r2"),
                    ratio_round("_a", n_u, 6).alias("mean_actual"), ratio_round("_p", n_u, 6).alias("mean_predicted"))


def segment_errors(pred: DataFrame, segment: str = "sector", actual: str = "actual",
                   predicted: str = "predicted") -> DataFrame:
    """Count, mean actual, mean predicted and MAE per segment, worst first."""
    g = pred.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), F.sum(micros(actual)).alias("a"),
                                  F.sum(micros(predicted)).alias("p"),
                                  F.sum(F.abs(micros(actual) - micros(predicted))).alias("m"))
    n_u = F.col("n") * 1000000
    return g.select(segment, F.col("n").cast("long"), ratio_round("a", n_u, 6).alias("mean_actual_lgd"),
                    ratio_round("p", n_u, 6).alias("mean_pred_lgd"), ratio_round("m", n_u, 6).alias("mae")) \
        .orderBy(F.desc("mae"), segment)
