"""A training corpus from ``documents``: toxicity, quality, SimHash near-dedup, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a DataFrame;
``run`` writes each result as Parquet in the shared folder and reads it as the next one's docs.
All but the last return the columns of ``docs``. Models are fitted on labelled rows of the
whole ``documents`` table outside the held-out fifth.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import bounded_hint, table, write_table
from riskloom.llm.packing import pack_best_fit
from riskloom.llm.quality import fit_quality, quality_scores
from riskloom.llm.simhash import simhash_groups
from riskloom.llm.toxicity import fit_toxicity, toxicity_scores

TOXICITY_THRESHOLD = 0.5
QUALITY_THRESHOLD = 0.3


def _text_key(docs: DataFrame) -> tuple[str, Column]:
    """A column name that ``docs`` doesn't have, and a 64-bit hash of the text (null and empty text are the same).

    Stages decide by text, so that a decision is a narrow row and a stage writes its documents once, as its result. Where
    two texts share a hash (a few in ten billion), neither is rejected through the other.
    """
    name = "_text_key"
    while name in docs.columns:
        name += "_"
    return name, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _without_texts(docs: DataFrame, scores: Callable[[DataFrame, str], DataFrame], reject: Column) -> DataFrame:
    """The rows of ``docs`` whose text isn't rejected: ``reject`` is a condition on ``score``."""
    name, key = _text_key(docs)
    scored = scores(docs.select(key.alias(name), F.col("text")), name)
    rejected = scored.groupBy(name).agg(F.bool_and(reject).alias("all")).where("all").select(name)
    rejected = write_table(rejected, "rejected")
    return docs.withColumn(name, key).join(bounded_hint(rejected), name, "left_anti").select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold.

    Equal texts (repeated rows, ties) have one score and one decision; a null text scores as an empty one; texts of any length are
    scored whole; ids may be null or repeated; an empty table stays empty; columns of any name are kept as they are.
    """
    model = fit_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _without_texts(docs, lambda rows, key: toxicity_scores(rows, model, id_col=key), F.col("score") >= TOXICITY_THRESHOLD)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the quality threshold.

    Equal texts (repeated rows, ties) have one score and one decision; a null text scores as an empty one; texts of any length are
    scored whole; ids may be null or repeated; an empty table stays empty; columns of any name are kept as they are.
    """
    weights = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _without_texts(docs, lambda rows, key: quality_scores(rows, weights, id_col=key), F.col("score") < QUALITY_THRESHOLD)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (nulls last), fingerprint and text hash.

    Of rows equal in id and text one stays. A row with neither id nor text is a copy of nothing and stays. Texts of any length are
    fingerprinted whole; an empty table stays empty; columns of any name are kept as they are.
    """
    name, key = _text_key(docs)
    # rows that are copies of nothing have no key, and no join finds them
    key = F.when(F.col("doc_id").isNotNull() | F.col("text").isNotNull(), key)
    rows = docs.select(key.alias("k"), "doc_id", "text").where(F.col("k").isNotNull())
    groups = simhash_groups(rows.select("k", "text"), id_col="k", shingle=3, radius=3)
    marks = groups.groupBy("k").agg(F.min("fp").alias("fp"), F.max("fp").alias("last"), F.min("component_id").alias("of"))
    marks = write_table(marks, "simhash-marks")     # one row per text
    members = rows.groupBy("k", "doc_id").agg(F.count(F.lit(1)).alias("n")).join(marks, "k")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp", "k")
    members = write_table(members.select("k", "doc_id", "n", "of", rank.alias("rank"), (F.col("fp") != F.col("last")).alias("shared")), "simhash-members")
    # members meet the first rows by their own key, not by their group, which may be large
    firsts = members.groupBy("of").agg(F.min("rank").alias("first")).select(F.col("first.k").alias("first_k"), F.col("first.doc_id").alias("first_id"))
    mine = (F.col("k") == F.col("first_k")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    placed = members.where("NOT shared").join(firsts, mine, "left").withColumn("is_first", F.col("first_k").isNotNull())
    decided = write_table(placed.where("NOT is_first OR n > 1").select(F.col("k").alias("gone_k"), F.col("doc_id").alias("gone_id"), "is_first"), "simhash-decided")
    keyed = docs.withColumn(name, key)
    same = (F.col(name) == F.col("gone_k")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    kept = keyed.join(bounded_hint(decided.where("NOT is_first")), same, "left_anti")
    twins = decided.where("is_first")
    if twins.limit(1).count():      # rows equal in id and text: one of them
        once = kept.join(bounded_hint(twins), same, "left_semi").dropDuplicates(["doc_id", name])
        kept = kept.join(bounded_hint(twins), same, "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of documents; a document's length is its number of words.

    A null or empty text has length 0; repeated rows and null ids are items of their own; ties and texts of any length go by the
    operator's rules; an empty table gives no bins.
    """
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    return pack_best_fit(docs.select("doc_id", words.alias("length")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("packing", packing_stage),
]

#: model scores and best-fit packing have no SQL form; tests compare with brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
