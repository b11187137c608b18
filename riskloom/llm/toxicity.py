"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words (a short fixed list, and
words and word beginnings learned from labelled rows), how close they stand to a
second-person word, rates of capitals, punctuation and obfuscation (letters mixed
with digits or symbols, and lexicon words that only appear when such symbols are read
as letters), and sizes.

The learned lexicon keeps keys that many more toxic than other training
texts hold. Training features are cross-fitted: a row's lexicon comes from the other
half of the rows, so that the trees see densities as they are on new texts. The
trees and the isotonic map are Spark MLlib fits on the bounded sample; scoring is
one numpy scan per text and the trees in the JVM.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, label_sample, slices, write_table
from .textscan import DIGIT, KIND, LOWER, MARK, SPACE, UPPER, WORD, mix, prefix_hash, scan, word_hash

# insults that count from the start, whatever the labels hold
INSULTS = (
    "asshole awful bastard bitch bozo clown coward crap creep cretin damn degenerate disgusting dumb dumbass fool "
    "filth freak garbage hate idiot idiotic imbecile jerk kill liar loser lunatic maggot moron nasty parasite pathetic pig "
    "rat rubbish scum shit shut sick stupid suck trash ugly useless vermin vile worthless wretch"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos ti tú usted ustedes vosotros tus su sus".split()

#: read as letters when looking for obfuscated words
LEET = LOWER.copy()
for _a, _b in ("0o", "1i", "3e", "4a", "5s", "7t", "8b", "@a", "$s", "!i", "|l", "+t"):
    LEET[ord(_a)] = ord(_b)
LEET_KIND = KIND.copy()
LEET_KIND[[ord(c) for c in "@$!|+"]] = WORD
#: symbols that stand between the letters of one word
FILLER = np.zeros(256, bool)
FILLER[[ord(c) for c in "*._-~'"]] = True

PREFIXES = (4, 5, 6)
NAMES = ("fixed", "fixed_near", "words", "prefix4", "prefix5", "prefix6", "any", "any_near", "most_count", "second", "caps", "caps_words",
         "marks", "exclaims", "mixed", "hidden", "stretched", "size")


@dataclass
class Lexicon:
    """Sorted hashes of the learned keys: whole words, then each prefix length."""

    keys: list[np.ndarray]


EMPTY = Lexicon([np.empty(0, np.uint64) for _ in range(1 + len(PREFIXES))])


def _sorted_hashes(words: list[str]) -> np.ndarray:
    return np.sort(np.array([word_hash(w) for w in words], np.uint64))


FIXED, SECOND = _sorted_hashes(INSULTS), _sorted_hashes(SECOND_PERSON)


def _in(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(h), bool)
    return keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h


def word_keys(data: np.ndarray, t, word: np.ndarray) -> list[np.ndarray]:
    """Hash of each word token, and of its beginnings (0: too short)."""
    vals = LOWER[data]
    return [t.hash[word]] + [prefix_hash(vals, t.start[word], t.size[word], p) for p in PREFIXES]


def dense_features(data: np.ndarray, bounds: np.ndarray, lexicon: Lexicon, near: int = 4) -> np.ndarray:
    """(texts, len(NAMES)) features; an empty text has zeros."""
    n = len(bounds) - 1
    t = scan(data, bounds)
    word = np.flatnonzero(t.kind == WORD)
    text, hashes = t.text[word], word_keys(data, t, word)
    words = np.maximum(np.bincount(text, minlength=n), 1)
    total = lambda hit: np.bincount(text, weights=hit, minlength=n)
    fixed, second = _in(hashes[0], FIXED), _in(hashes[0], SECOND)
    learned = [_in(h, k) for h, k in zip(hashes, lexicon.keys)]
    any_hit = fixed | np.logical_or.reduce(learned)
    close = np.zeros(len(word), bool)  # a second-person word of the same text within ``near`` words
    at = np.flatnonzero(second)
    if len(at):
        for side in (np.searchsorted(at, np.arange(len(word))) - 1, np.minimum(np.searchsorted(at, np.arange(len(word))), len(at) - 1)):
            other = at[np.maximum(side, 0)]
            close |= (np.abs(other - np.arange(len(word))) <= near) & (text[other] == text)
    ups, digs = (np.concatenate(([0], np.cumsum(m[data]))) for m in (UPPER, DIGIT))
    ends = t.start[word] + t.size[word]
    up, dig = ups[ends] - ups[t.start[word]], digs[ends] - digs[t.start[word]]
    chars = np.maximum(np.diff(bounds), 1)
    per_text = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[bounds])
    # the text read with symbols as letters, and without fillers between letters
    kind = KIND[data]
    solid = np.concatenate(([SPACE], kind[:-1])) == WORD
    joins = FILLER[data] & solid & (np.concatenate((kind[1:], [SPACE])) == WORD)
    kept = ~joins
    moved = np.concatenate(([0], np.cumsum(kept)))[bounds]
    loud = scan(data[kept], moved, LEET_KIND, LEET)
    read = np.flatnonzero(loud.kind == WORD)
    hit = _in(loud.hash[read], FIXED) | _in(loud.hash[read], lexicon.keys[0])
    hidden = np.bincount(loud.text[read], weights=hit, minlength=n) - total(fixed | learned[0])
    same3 = np.zeros(len(data), bool)
    if len(data) > 2:
        same3[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (kind[2:] == WORD)
    hits = total(any_hit)
    cols = [
        total(fixed) / words, total(fixed & close) / words, *[total(x) / words for x in learned], hits / words, total(any_hit & close) / words,
        np.log1p(hits), total(second) / words, per_text(UPPER[data]) / chars, total((up == t.size[word]) & (up > 1)) / words,
        per_text(kind == MARK) / chars, per_text(data == 33) / chars, total((dig > 0) & (dig < t.size[word])) / words,
        np.maximum(hidden, 0) / words, per_text(same3) / chars, np.log1p(np.diff(bounds)),
    ]
    return np.column_stack(cols)


def learn_lexicon(sample: DataFrame, min_texts: int = 4, precision: float = 0.9, max_keys: int = 4000) -> dict[int, Lexicon]:
    """Lexicons by part: 0 and 1 from the half of the rows that isn't that part, 2 from all.

    ``sample`` has (text, y, part). A key (word or beginning) is taken if at least
    ``min_texts`` toxic texts hold it and, after smoothing, at least ``precision``
    of the texts with it are toxic, each class counted alike.
    """
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ys, parts = b.column(1).to_numpy(), b.column(2).to_numpy()
            for at, data, bounds in slices(b.column(0)):
                t = scan(data, bounds)
                word = np.flatnonzero(t.kind == WORD)
                cls = (ys * 2 + parts)[at + t.text[word]]
                for length, h in enumerate(word_keys(data, t, word)):
                    ok = h != 0
                    h, text, c = h[ok], t.text[word][ok], cls[ok]
                    order = np.lexsort((text, h))
                    h, text, c = h[order], text[order], c[order]
                    once = np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[: len(h)]  # a key counts once a text
                    h, c = h[once], c[once]
                    first = np.append(True, h[1:] != h[:-1])[: len(h)]
                    keys = h[first]
                    counts = np.bincount((np.cumsum(first) - 1) * 4 + c, minlength=4 * len(keys)).reshape(-1, 4)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), length, np.int32)), pa.array(keys.view(np.int64)), *[pa.array(c) for c in counts.T]], names=["kind", "key", "n0", "n1", "t0", "t1"])

    rows = arrow_map(sample.select("text", "y", "part"), fn, "kind int, key long, n0 long, n1 long, t0 long, t1 long")
    sums = rows.groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "t0", "t1")])
    size = sample.groupBy("y", "part").count().collect()  # four rows
    count = {(r["y"], r["part"]): r["count"] for r in size}
    sums = write_table(sums.where(F.col("t0") + F.col("t1") >= min_texts), "lexicon-counts")
    out = {}
    for part, (neg, pos, ys) in {0: ("n1", "t1", (1,)), 1: ("n0", "t0", (0,)), 2: (F.col("n0") + F.col("n1"), F.col("t0") + F.col("t1"), (0, 1))}.items():
        neg, pos = (F.col(c) if isinstance(c, str) else c for c in (neg, pos))
        negs, poss = (max(1, sum(count.get((y, p), 0) for p in ys)) for y in (0, 1))
        share = (pos + 0.1) / poss / ((pos + 0.1) / poss + (neg + 0.5) / negs)
        # enough texts that chance would not give them: rare keys are many
        chosen = sums.where((pos >= min_texts) & (share >= precision) & (pos >= 3 * neg)).orderBy(F.desc(pos), "kind", "key").limit(max_keys).select("kind", "key").collect()
        out[part] = Lexicon([np.sort(np.array([r["key"] for r in chosen if r["kind"] == k], np.int64).view(np.uint64)) for k in range(1 + len(PREFIXES))])
    return out


def with_features(docs: DataFrame, lexicons: dict[int, Lexicon], id_col: str = "id", text_col: str = "text", part_col: str | None = None) -> DataFrame:
    """(id, x array<double>, y, part) of rows with columns id, text, and optional y and part."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = b.column(2).to_numpy()
            x = np.zeros((b.num_rows, len(NAMES)))
            for part in np.unique(parts):
                rows = np.flatnonzero(parts == part)
                for at, data, bounds in slices(b.column(1).take(pa.array(rows))):
                    x[rows[at: at + len(bounds) - 1]] = dense_features(data, bounds, lexicons[int(part)])
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([b.column(0), lists, b.column(2), b.column(3)], names=["id", "x", "part", "y"])

    part = F.col(part_col) if part_col else F.lit(2)
    y = F.col("y") if "y" in docs.columns and part_col else F.lit(0)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), part.cast("int").alias("part"), y.cast("int").alias("y"))
    return arrow_map(rows, fn, "id long, x array<double>, part int, y int")


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    bounds: list[float]       # isotonic map: margins and values
    values: list[float]


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 20_000, trees: int = 30, depth: int = 3, seed: int = 5) -> ToxicityModel:
    """Lexicon, trees and calibration from at most ``max_rows`` labelled training rows.

    Every fourth row (by a hash of its id) is kept from the trees and fits the
    calibration. Without labelled rows of both classes the score is 0.
    """
    sample, n = label_sample(docs, labels, label, max_rows)
    sample = write_table(sample.withColumn("part", F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(2)).cast("int")), "toxic-sample")
    if sample.select("y").distinct().count() < 2:
        return ToxicityModel(EMPTY, None, [], [])
    lexicons = learn_lexicon(sample)
    x = write_table(with_features(sample, lexicons, "doc_id", "text", "part"), "toxic-features")
    x = x.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), (F.pmod(F.xxhash64(F.col("id") + 2), F.lit(4)) == 0).alias("calibrate"))
    x = write_table(x, "toxic-vectors")
    gbt = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=32, minInstancesPerNode=3, seed=seed, subsamplingRate=1.0)
    model = gbt.fit(x.where(~F.col("calibrate")).coalesce(max(1, n // 2500)))
    margin = model.transform(x.where("calibrate")).select(vector_to_array("rawPrediction")[1].alias("margin"), "label")
    iso = IsotonicRegression(featuresCol="margin").fit(margin)
    return ToxicityModel(lexicons[2], model, list(iso.boundaries), list(iso.predictions))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) per row: calibrated probability of label 1.

    Within a step of the isotonic map a thousandth of the uncalibrated probability keeps texts
    in order. Null and empty texts score by all-zero features. Repeated rows and null ids keep
    their rows; an empty table gives an empty result; other columns are ignored.
    """
    if model.trees is None:
        return docs.select(F.col(id_col).cast("long").alias(id_col), F.lit(0.0).alias("score"))
    x = with_features(docs, {2: model.lexicon}, id_col, text_col).select("id", array_to_vector("x").alias("features"))
    raw = model.trees.transform(x).select("id", vector_to_array("rawPrediction")[1].alias("margin"))
    at, ys = model.bounds, model.values

    def calibrate(margins: pa.Array) -> np.ndarray:
        return np.interp(margins, at, ys)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.column(1).to_numpy()
            score = 0.999 * calibrate(m) + 0.001 / (1 + np.exp(-2 * m))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], names=["id", "score"])

    return arrow_map(raw, fn, "id long, score double").withColumnRenamed("id", id_col)
