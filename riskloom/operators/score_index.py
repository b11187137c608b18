"""A stored index of a scored set, from which its rank measures are read.

One row per distinct score of the test rows: positives, negatives, both running counts from the highest score down, and
the totals; beside it the rows per split and PD band. It is built once (one aggregate, one shuffle by value range) and
written; AUC (null with one class only), average precision, both curves, top-fraction capture, Brier and the drift of the bands are then
aggregates or projections of these small tables.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..functions.columns import ratio_round
from ..session import durable, write_table
from .metrics import anchor, band_of
from .monitoring import psi_shares
from .ranking import prefix_sums
from .scalars import scalar_row

#: tied rows up to this number are ranked by one top-k instead of by value ranges
TIED = 100_000


@dataclass
class ScoreIndex:
    """``scores``: (score, pos, neg, pos_cum, neg_cum, P, N); ``bands``: (split, band, n); both written."""

    scores: DataFrame
    bands: DataFrame

    def auc(self) -> DataFrame:
        """ROC-AUC with ties at half: one row ``roc_auc``."""
        below = F.col("N") - F.col("neg_cum") + F.col("neg") * 0.5
        c = self.scores.agg(F.sum(F.col("pos").cast("double") * below).alias("u"), F.max("P").alias("P"), F.max("N").alias("N"))
        return c.select(F.round(F.try_divide(F.col("u"), F.col("P").cast("double") * F.col("N").cast("double")), 6).alias("roc_auc"))

    def average_precision(self) -> DataFrame:
        """Step-wise average precision: one row ``pr_auc``."""
        prec = F.col("pos_cum").cast("double") / (F.col("pos_cum") + F.col("neg_cum")).cast("double")
        return self.scores.agg(F.round(F.sum(F.try_divide(F.col("pos").cast("double"), F.col("P").cast("double")) * prec), 6).alias("pr_auc"))

    def roc_points(self) -> DataFrame:
        """ROC curve with its anchor (0, 0)."""
        points = self.scores.select(F.col("score").alias("threshold"), ratio_round("neg_cum", "N", 6).alias("fpr"), ratio_round("pos_cum", "P", 6).alias("tpr"))
        return points.unionByName(anchor(points, fpr=0.0, tpr=0.0)).orderBy(F.desc_nulls_first("threshold"))

    def pr_points(self) -> DataFrame:
        """Precision-recall curve with its anchor (recall 0, precision 1)."""
        points = self.scores.select(F.col("score").alias("threshold"), ratio_round("pos_cum", "P", 6).alias("recall"),
                                    ratio_round("pos_cum", F.col("pos_cum") + F.col("neg_cum"), 6).alias("precision"))
        return points.unionByName(anchor(points, recall=0.0, precision=1.0)).orderBy(F.desc_nulls_first("threshold"))

    def brier(self) -> DataFrame:
        """Mean squared error of the scores: one row ``brier``."""
        s = F.col("score")
        return self.scores.agg(F.round(F.try_divide(F.sum(F.col("pos") * (1.0 - s) * (1.0 - s) + F.col("neg") * s * s), F.sum(F.col("pos") + F.col("neg"))), 6).alias("brier"))

    def psi(self) -> DataFrame:
        """Stability of the bands, test against train: one row ``psi``."""
        of = lambda split: self.bands.where(F.col("split") == split).groupBy("band").agg(F.sum("n").alias("n"))
        return psi_shares(of("train"), of("test"), "band", "n")

    def monitor_metrics(self) -> DataFrame:
        """(roc_auc, brier, psi), one row: one pass over each table."""
        s = F.col("score")
        below = F.col("N") - F.col("neg_cum") + F.col("neg") * 0.5
        c = self.scores.agg(F.sum(F.col("pos").cast("double") * below).alias("u"), F.max("P").cast("double").alias("P"), F.max("N").cast("double").alias("N"),
                            F.sum(F.col("pos") * (1.0 - s) * (1.0 - s) + F.col("neg") * s * s).alias("e"))
        return c.select(F.round(F.try_divide(F.col("u"), F.col("P") * F.col("N")), 6).alias("roc_auc"), F.round(F.try_divide(F.col("e"), F.col("P") + F.col("N")), 6).alias("brier"),
                        scalar_row(self.psi())["psi"].alias("psi"))

    def capture(self, scored: DataFrame, fraction: float = DEFAULT.top_decile, score: str = "score", label: str = "label", key: str = "loan_id") -> DataFrame:
        """Share of all events among the top ``max(1, floor(fraction * n))`` of the rows ``scored`` (the indexed ones; ties by ``key``)."""
        k = F.greatest(F.lit(1), F.floor((F.col("P") + F.col("N")) * F.lit(float(fraction)))).cast("long")
        upto, rows = F.col("pos_cum") + F.col("neg_cum"), F.col("pos") + F.col("neg")
        cut = F.when((upto - rows < k) & (upto > k), F.struct(F.col("score"), (k - upto + rows).alias("take"), rows.alias("tied")))
        top = self.scores.agg(F.coalesce(F.sum(F.when(upto <= k, F.col("pos"))), F.lit(0)).alias("above"), F.max(cut).alias("cut"),
                              F.max("P").alias("events"), F.max(F.col("P") + F.col("N")).alias("n")).first()     # one row
        captured = top["above"]
        if top["cut"] is not None:
            tied = scored.where(F.col(score).eqNullSafe(F.lit(top["cut"]["score"]))).select(key, F.col(label).cast("long").alias("y"))
            if top["cut"]["tied"] <= TIED:
                first = tied.orderBy(key).limit(top["cut"]["take"])
            else:
                one = tied.groupBy(key).agg(F.count(F.lit(1)).alias("one"), F.sum("y").alias("y"))
                first = prefix_sums(one, key, ["one"]).where(F.col("one_cum") <= top["cut"]["take"])
            captured += first.agg(F.coalesce(F.sum("y"), F.lit(0))).first()[0]
        out = scored.sparkSession.range(1).select(F.lit(top["n"] or 0).cast("long").alias("n_scored"), F.lit(top["events"] or 0).cast("long").alias("events"),
                                                  F.lit(captured).cast("long").alias("captured"))
        return out.withColumn("top_decile_capture_rate", ratio_round("captured", F.greatest(F.lit(1), F.col("events")), 6))


def build_index(scored: DataFrame, cfg: RiskConfig = DEFAULT, score: str = "score", label: str = "label", split: str = "split") -> ScoreIndex:
    """The index of ``scored`` (score, 0/1 label, split train / test)."""
    counts = durable(scored.groupBy(F.col(split).alias("split"), F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((F.lit(1) - F.col(label)).cast("long")).alias("neg")))
    running = prefix_sums(counts.where("split = 'test'").drop("split"), "score", ["pos", "neg"], descending=True)
    totals = scalar_row(counts.where("split = 'test'").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")))
    scores = running.withColumn("_t", totals).select("score", "pos", "neg", "pos_cum", "neg_cum", F.col("_t.P").alias("P"), F.col("_t.N").alias("N"))
    bands = counts.groupBy("split", band_of("score", cfg).alias("band")).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"))
    return ScoreIndex(write_table(scores, "score-index"), write_table(bands.coalesce(1), "score-bands"))
