"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features of a text are hashed to 2^``bits`` places: words, word pairs, and 1- to
3-grams of word shapes (kind, capitals, digits, length class, repetition of the
word before), each weighted by its share of the text's n-grams. Fitting: the
bounded sample of labelled rows is dealt over tasks of ``shard_rows``; each runs
FTRL-proximal passes over its rows and returns its sparse weights, which are
averaged. Scoring is one pass of sparse dot products in numpy over whole texts.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, label_sample, slices
from .textscan import DIGIT, MARK, UPPER, WORD, mix, scan

FAMILIES = 5


def features(data: np.ndarray, bounds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, weight) triples of every n-gram of the texts; places repeat."""
    t = scan(data, bounds)
    n = len(bounds) - 1
    if not len(t.start):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    ends = t.start + t.size
    ups, digs = (np.concatenate(([0], np.cumsum(m[data]))) for m in (UPPER, DIGIT))
    up, dig = ups[ends] - ups[t.start], digs[ends] - digs[t.start]
    word = np.flatnonzero(t.kind == WORD)
    repeat = np.zeros(len(t.start), bool)
    repeat[word[1:]] = (t.hash[word[1:]] == t.hash[word[:-1]]) & (t.text[word[1:]] == t.text[word[:-1]])
    case = np.where(up == 0, 0, np.where(up == 1, 1, np.where(2 * up > t.size, 2, 3)))
    length = np.searchsorted([2, 4, 7, 11, 16, 25], t.size)
    shape = ((case * 7 + length) * 2 + (dig > 0)) * 2 + repeat
    shape = np.where(t.kind == MARK, t.hash, mix(shape.astype(np.uint64) + np.uint64(1 << 40)))
    with np.errstate(over="ignore"):
        pair = (t.text[1:] == t.text[:-1]).nonzero()[0]
        three = (t.text[2:] == t.text[:-2]).nonzero()[0]
        k = np.uint64(0x9E3779B97F4A7C15)
        w2 = word[1:][t.text[word[1:]] == t.text[word[:-1]]]
        w1 = word[:-1][t.text[word[1:]] == t.text[word[:-1]]]
        grams = [
            (word, t.hash[word]),
            (w1, t.hash[w1] * k + t.hash[w2]),
            (np.arange(len(t.start)), shape),
            (pair, shape[pair] * k + shape[pair + 1] + np.uint64(7)),
            (three, (shape[three] * k + shape[three + 1]) * k + shape[three + 2] + np.uint64(9)),
        ]
        text = np.concatenate([t.text[at] for at, _ in grams])
        place = np.concatenate([(mix(h ^ np.uint64(f + 1)) >> np.uint64(64 - bits)).astype(np.int64) for f, (_, h) in enumerate(grams)])
    weight = np.concatenate([(1.0 / np.maximum(np.bincount(t.text[at], minlength=n), 1))[t.text[at]] for at, _ in grams])
    return text, place, weight


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int, passes: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """FTRL-proximal weights (the last is the intercept) after ``passes`` passes over (places, weights, y)."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def solve(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(passes):
        for i, x, y in rows:
            w = solve(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return solve(np.arange(len(z)))


def _fit_shard(bits: int, passes: int, rates: tuple[float, float, float, float]):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            ys = b.column(1).to_numpy()
            for at, data, bounds in slices(b.column(0)):
                text, place, weight = features(data, bounds, bits)
                order = np.lexsort((place, text))
                cuts = np.searchsorted(text[order], np.arange(len(bounds)))
                for r in range(len(bounds) - 1):
                    o = order[cuts[r]: cuts[r + 1]]
                    i, back = np.unique(place[o], return_inverse=True)
                    x = np.bincount(back, weights=weight[o], minlength=len(i))
                    rows.append((np.append(i, 1 << bits), np.append(np.sqrt(x), 1.0), int(ys[at + r])))
        if rows:
            w = ftrl(rows, bits, passes, *rates)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at]), pa.array(np.full(len(at), len(rows)))], names=["place", "w", "rows"])
            yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([0.0]), pa.array([len(rows)])], names=["place", "w", "rows"])
    return fn


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", bits: int = 18, max_rows: int = 20_000, shard_rows: int = 2_500, passes: int = 3,
                alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-4) -> np.ndarray:
    """2^bits + 1 weights fitted on at most ``max_rows`` labelled training rows (zeros if there are none)."""
    sample, n = label_sample(docs, labels, label, max_rows)
    dealt = sample.repartition(max(1, round(n / shard_rows)), "doc_id").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("text", "y")
    parts = arrow_map(dealt, _fit_shard(bits, passes, (alpha, beta, l1, l2)), "place long, w double, rows long")
    got = parts.groupBy("place").agg(F.sum(F.col("w") * F.col("rows")).alias("w"), F.sum("rows").alias("rows")).collect()  # 2^bits + 2 rows at most
    total = sum(r["rows"] for r in got if r["place"] < 0)
    out = np.zeros((1 << bits) + 1)
    for r in got:
        if r["place"] >= 0:
            out[r["place"]] = r["w"] / total
    return out


def quality_scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) per row: probability of label 1. Null and empty texts score by the intercept.

    Repeated rows and null ids keep their rows; an empty table gives an empty result;
    other columns are ignored.
    """
    spark = docs.sparkSession
    bits = (len(weights) - 1).bit_length() - 1
    sent = spark.sparkContext.broadcast(weights)  # 2^bits + 1 doubles

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for b in batches:
            margin = np.full(b.num_rows, w[-1])
            for at, data, bounds in slices(b.column(1)):
                text, place, weight = features(data, bounds, bits)
                order = np.argsort(text * len(w) + place, kind="stable")
                key = text[order] * len(w) + place[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
                if len(first):
                    x = np.sqrt(np.add.reduceat(weight[order], first))
                    margin[at: at + len(bounds) - 1] += np.bincount(text[order][first], weights=x * w[place[order][first]], minlength=len(bounds) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, fn, "id long, score double").withColumnRenamed("id", id_col)
