"""Line dedup with SQL functions only: range-partitioned line hashes and keep bitmaps per document.

Every text is cut at ``\\n``; a line's key is the line without white space
(``[\\x20\\x09-\\x0D]``) at both ends and with A-Z lower-cased, as a 128-bit hash. The hashes of a document are written
once as arrays (16 bytes a line), which all later steps read instead of the text. Lines go to
value ranges of (key, document) and are sorted by position there, so that a task streams over its runs and passes
on the first line of each key in each document; because the document is part of the range, a key with a
third of all lines is spread over many tasks. Those first lines are combined to one row per key and
task before the keys are counted, and come back as keep bitmaps.

A bitmap is compressed to its runs, as the run containers of roaring bitmaps are: ``keep_runs``
lists (start, length) of the kept stretches in order, so a document that keeps every line has one entry and one that keeps none has none.

Defined results: a null text is one empty line, as an empty text is. A document is a distinct pair
of id and text: rows equal in both count once and share one bitmap, rows with one id (or a null id) and different texts
are documents of their own. Keys shorter than ``min_chars`` are never dropped. "First" means the smallest
id (nulls first), for equal ids the smaller text hash, then the position. Texts of any length are read
whole; an empty table gives an empty result. Only the id and text columns are read, so other columns may have any name.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_hint, write_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = " \t\n\x0b\x0c\r"
SEED = "riskloom line"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` (or a lambda in it) names it."""
    return F.transform(F.array(value), use)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def lines_of(text: Column) -> Column:
    """The lines of a text in order; one empty line for a null or empty text."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(lines_of(text), lambda line: ascii_lower(F.btrim(line, F.lit(SPACE))))


def document_key(doc_id: Column, text: Column) -> list[Column]:
    """``d1``, ``d2``: a 128-bit hash of id and text (null and empty text are the same)."""
    parts = [F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("-")), F.coalesce(text, F.lit(""))]
    return [F.xxhash64(*parts).alias("d1"), F.xxhash64(F.lit(SEED), *parts).alias("d2")]


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(doc_id, d1, d2, lines), written: each line's key as a struct of two hashes, null for keys below ``min_chars`` code points."""
    hashed = F.transform(line_keys(F.col(text_col)), lambda k: F.when(
        F.char_length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(SEED), k).alias("h2"))))
    return write_table(docs.select(F.col(id_col).alias("doc_id"), *document_key(F.col(id_col), F.col(text_col)), hashed.alias("lines")), "line-hashes")


def _exploded(hashes: DataFrame) -> DataFrame:
    """One row per line with a key: (h1, h2, doc_id, d1, d2, pos)."""
    lines = hashes.select("doc_id", "d1", "d2", F.posexplode("lines").alias("pos", "k")).where(F.col("k").isNotNull())
    return lines.select("k.h1", "k.h2", "doc_id", "d1", "d2", "pos")


def first_lines(hashes: DataFrame) -> DataFrame:
    """The first line of each key in each document: one shuffle by ranges of (key, document), one sort, one streaming pass."""
    group = ["h1", "h2", "doc_id", "d1", "d2"]
    placed = _exploded(hashes).repartitionByRange(*group).sortWithinPartitions(*group, "pos")
    seen = F.row_number().over(Window.partitionBy(*group).orderBy("pos"))
    return placed.withColumn("seen", seen).where(F.col("seen") == 1).drop("seen")


def repeated_keys(hashes: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents with their first line: (h1, h2, n_docs, first struct of doc_id, d1, d2, pos), written."""
    keys = first_lines(hashes).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc_id", "d1", "d2", "pos")).alias("first"))
    return write_table(keys.where(F.col("n_docs") >= min_docs), "repeated-lines")


def _keep_runs(dropped: Column, n: Column) -> Column:
    """(start, length) runs of the positions below ``n`` that are not in the ascending array ``dropped``."""
    def runs(p: Column) -> Column:
        starts = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1) != x - 1, F.lit(True)))
        ends = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) != x + 1, F.lit(True)))
        kept = F.zip_with(F.concat(F.array(F.lit(0)), F.transform(ends, lambda e: e + 1)), F.concat(starts, F.array(n)),
                          lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
        return F.filter(kept, lambda r: r["length"] > 0)
    return _let(dropped, runs)


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """One row per document: (d1, d2, doc_id, n_lines, n_dropped, keep_runs).

    Lines whose key stands in at least ``min_docs`` documents are dropped in every document; with ``keep_first`` the first
    line of the whole table stays (``min_docs=1, keep_first=True`` drops every repeat, also within a document).
    """
    hashes = line_hashes(docs, id_col, text_col, min_chars)
    keys = repeated_keys(hashes, min_docs)
    hits = _exploded(hashes).join(bounded_hint(keys), ["h1", "h2"])      # lines are the left side, which AQE splits at a hot key
    if keep_first:
        hits = hits.where((F.col("first.d1") != F.col("d1")) | (F.col("first.d2") != F.col("d2")) | (F.col("first.pos") != F.col("pos")))
    marks = hashes.select("d1", "d2", "doc_id", F.size("lines").alias("n"), F.lit(None).cast("int").alias("pos")).unionByName(
        hits.select("d1", "d2", "doc_id", F.lit(None).cast("int").alias("n"), "pos"))
    # equal rows repeat their positions: a set
    found = marks.groupBy("d1", "d2").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.collect_set("pos").alias("dropped"))
    return found.select("d1", "d2", "doc_id", F.col("n").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
                        _keep_runs(F.sort_array("dropped"), F.col("n")).alias("keep_runs"))


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The lines of ``text`` that a bitmap keeps, joined by ``\\n`` (empty if none)."""
    return _let(lines_of(text), lambda lines: F.array_join(F.flatten(F.transform(keep_runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every row of ``docs`` with its kept lines."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *document_key(F.col(id_col), F.col(text_col)))
    return rows.join(bitmaps.drop("doc_id"), ["d1", "d2"], "left").select("doc_id", "n_lines", "n_dropped", kept_text(F.col("text"), F.col("keep_runs")).alias("text"))
