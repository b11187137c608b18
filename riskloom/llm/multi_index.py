"""Approximate nearest neighbours by multi-index hashing over learned binary codes.

Codes: vectors are centred and turned by ``rotations`` learned rotations (principal
axes, then iterative quantisation), the signs are the bits. Vectors of each length have an index of
their own. Rotations and the search radius are fitted on a bounded sample (``sample`` rows with the smallest
hashes; rows are cut at a hash that leaves about twice as many before any reach the driver); every row is indexed. The radius is the ``recall`` quantile of the Hamming
distances from sample rows to their true ``k`` nearest in the sample; in the whole
table the nearest are nearer still.

Index: a code is cut into bytes, and every index block of about ``block`` rows
orders its rows by each byte. Search: queries meet every index block (a stated
query set against all rows, in blocks). If two codes differ in at most
r = m*a + c bits (m bytes, c < m), then c + 1 fixed bytes have one within a bits
or the others one within a - 1; those buckets are probed, the codes found are
checked for the radius, and what is left is ranked by the distance of the
original vectors in double precision. A query with fewer than ``k`` codes in a block
widens its radius there, so it always gets ``k`` rows if there are as many.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, group_bounds, runs, write_table
from .vectors import matrix, vector_rows

POPCOUNT = np.bitwise_count(np.arange(256, dtype=np.uint8)).astype(np.int64)
#: byte differences in order of their number of bits, and how many there are up to each
DELTAS = np.argsort(POPCOUNT, kind="stable").astype(np.uint8)
UP_TO = np.cumsum(np.bincount(POPCOUNT))


def learn_rotations(x: np.ndarray, rotations: int, rounds: int = 20, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(mean, (d, rotations*d) projection): principal axes turned to where signs lose least."""
    mean = x.mean(axis=0)
    z = x - mean
    axes = np.linalg.svd(z.T @ z)[0]
    v = z @ axes
    out = []
    for r in range(rotations):
        turn = np.linalg.qr(np.random.default_rng([seed, r]).standard_normal((x.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
            turn = (u @ w).T
        out.append(axes @ turn)
    return mean, np.hstack(out)


def encode(x: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """(rows, bytes) codes."""
    return np.packbits((x - mean) @ turn > 0, axis=1)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - q) ** 2).sum(axis=1))


def fit_radius(x: np.ndarray, codes: np.ndarray, k: int, recall: float, queries: int = 512) -> int:
    """Hamming radius that holds the ``recall`` share of the true ``k`` nearest of sample rows."""
    found = []
    for i in range(min(queries, len(x))):
        d = distances(x, x[i])
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(x) - 1)]
        found.append(hamming(codes[near], codes[i]))
    return int(np.ceil(np.quantile(np.concatenate(found), recall))) if found and len(found[0]) else codes.shape[1] * 8


class MultiIndex:
    """Rows of one block, ordered by each byte of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.starts = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, j], minlength=256)))) for j in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Row numbers of every code within ``radius`` bits."""
        m = len(code)
        if radius >= m * 8:
            return np.arange(len(self.codes))
        a, c = divmod(radius, m)
        hit = np.zeros(len(self.codes), bool)
        for j in range(m):
            most = a if j <= c else a - 1
            if most < 0:
                continue
            probe = code[j] ^ DELTAS[: UP_TO[min(most, 8)]]
            at = self.starts[j][probe]
            size = self.starts[j][probe.astype(np.int64) + 1] - at
            hit[self.order[j][np.repeat(at - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())]] = True
        rows = np.flatnonzero(hit)
        return rows[hamming(self.codes[rows], code) <= radius]


def _search(mean: np.ndarray, turn: np.ndarray, radius: int, k: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, ["qc", "ib"], 1):
            bounds = group_bounds(tab, ["qc", "ib"])
            for at, to in zip(bounds, bounds[1:]):
                cell = tab.slice(int(at), int(to - at))
                asks = cell.column("ask").to_numpy(zero_copy_only=False).astype(bool)
                ids, rows_of, x = cell.column("id").to_numpy(), cell.column("row").to_numpy(), matrix(cell.column("vec"))
                codes = encode(x, mean, turn)
                own, xs, own_row = ids[~asks], x[~asks], rows_of[~asks]
                if not len(own):
                    continue
                index = MultiIndex(codes[~asks])
                out: list[tuple[np.ndarray, ...]] = []
                for q in np.flatnonzero(asks):
                    r = radius
                    while True:
                        rows = index.within(codes[q], r)
                        rows = rows[own_row[rows] != rows_of[q]]
                        if len(rows) >= k or r >= codes.shape[1] * 8:
                            break
                        r += max(1, codes.shape[1] // 2)
                    d = distances(xs[rows], x[q])
                    best = np.lexsort((own[rows], d))[:k]
                    out.append((np.full(len(best), rows_of[q]), np.full(len(best), ids[q]), own[rows][best], d[best]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["row", "query_id", "id", "score"])
    return fn


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, rotations: int = 2,
            recall: float = 0.98, sample: int = 8192, block: int = 8192, query_block: int = 4096) -> DataFrame:
    """(query_id, rank int, id_col, score): the ``k`` nearest found of every query row, by Euclidean distance.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but the query's own (other rows of its id
    are candidates, and queries if they meet the condition); ties go to the smaller id; a query with fewer candidates gets them all. Null, empty and zero
    vectors, those with null or non-finite components and rows without an id take no part. Vectors of different lengths
    have no distance: each length is searched by itself. An empty table
    gives an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    valid = vector_rows(df, id_col, vec_col).where(F.col("id").isNotNull()).withColumn("row", F.monotonically_increasing_id())
    valid = write_table(valid, "ann-vectors")       # the row numbers stay as they are written
    out = None
    for length in valid.groupBy(F.size("vec").alias("d")).count().orderBy("d").collect():       # one row per vector length
        found = _nearest_of_length(valid.where(F.size("vec") == length["d"]), length["count"], is_query, k, rotations, recall, sample, block, query_block)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    best = F.row_number().over(Window.partitionBy("row").orderBy("score", "id"))
    return out.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), F.col("id").alias(id_col), "score")


def _nearest_of_length(valid: DataFrame, n: int, is_query: Column, k: int, rotations: int, recall: float, sample: int, block: int, query_block: int) -> DataFrame | None:
    """(row, query_id, id, score) of at least the ``k`` nearest found in each index block, over ``n`` rows of one length; None without queries."""
    query_blocks = -(-valid.where(is_query).count() // query_block)
    if not query_blocks:
        return None
    spread = F.xxhash64("id", "row")
    cut = min(1.0, 2.0 * sample / n)        # about twice the sample passes the cut, whatever the number of partitions
    few = valid.where(F.abs(spread.cast("double")) <= cut * 2.0 ** 63).orderBy(spread, "id", "row").limit(sample)
    x = np.array([r["vec"] for r in few.select("vec").collect()])  # at most ``sample`` vectors
    if not len(x):      # a small table whose hashes all lie above the cut
        x = np.array([r["vec"] for r in valid.limit(sample).select("vec").collect()])
    mean, turn = learn_rotations(x, rotations)
    radius = fit_radius(x, encode(x, mean, turn), k, recall)
    index_blocks = -(-n // block)
    asked = valid.where(is_query)
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(int(count) - 1)))
    index = valid.select(F.pmod(spread, F.lit(index_blocks)).cast("int").alias("ib"), every(query_blocks).alias("qc"), F.lit(False).alias("ask"), "id", "row", "vec")
    asks = asked.select(every(index_blocks).alias("ib"), F.pmod(spread, F.lit(query_blocks)).cast("int").alias("qc"), F.lit(True).alias("ask"), "id", "row", "vec")
    dealt = index.unionByName(asks).repartition("qc", "ib").sortWithinPartitions("qc", "ib", "id", "row")
    return arrow_map(dealt.select("qc", "ib", "ask", "id", "row", "vec"), _search(mean, turn, radius, k), "row long, query_id long, id long, score double")
