"""Embedding near-dedup by sorted projection passes.

Each pass orders the vectors lexicographically by 64 concatenated random
hyperplane signs and compares every vector with the ``window`` rows after it.
The first passes follow the number of vectors: a pair at the threshold agrees on
one sign with probability 1 - angle/pi, and where signs halve the rows, those within a
window agree on about log2(n / window) leading signs. Vectors off the centre and dense
topics share more, so every pass also measures each row: the signs it shares with the rows ``window``
places on and back (a partner that shares more is in the window), and from the row's distances to those
hyperplanes the probability that a partner at the threshold is on its side of all of them. Rows
whose passes so far leave such a pair unmet with more than 1 - ``recall`` go through further
passes among themselves, until none is left (a pair is safe if either row is). Rows in crowds that
many passes would not part (near copies by the thousand) go on until a round unites nothing new.
Verified pairs of all passes are united; then each found component is compared whole, in blocks of
bounded size, so that links between its members that no window held are not
lost either.

Exact copies are one class with a multiplicity. A pass moves (pass, key, id)
only to find positions, and each vector once to its block of ``block`` rows (plus
``window`` before and after as a halo); blocks are equal in size whatever the data, and a
task sends a spanning forest of its links, not the pairs.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, group_bounds, runs, union_min, write_table
from .components import connected_components
from .vectors import matrix, valid_vectors


#: normal distribution function, by interpolation
GRID = np.linspace(-8, 8, 4097)
NORMAL = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in GRID])
#: passes of one further round at most, and passes beyond which a row counts as in a crowd that signs don't part
ROUND, CROWD = 32, 512


def passes_needed(n: int, threshold: float, window: int, recall: float) -> int:
    """Passes after which a pair at the threshold has met with probability ``recall``, if every sign halves the rows."""
    agree = 1 - math.acos(min(1.0, threshold)) / math.pi
    meet = agree ** max(0.0, math.log2(max(1.0, n / window)))
    return 1 if meet >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _planes(seed: int, p: int, d: int) -> np.ndarray:
    return np.random.default_rng([seed, p, d]).standard_normal((d, 64))


def _keys(first: int, passes: int, seed: int):
    """(pass, key, cid) rows of passes from ``first``: the 64 signs of each pass as one ordered long."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            sizes = lists.value_lengths().to_numpy()
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                x = matrix(pa.chunked_array([lists.take(pa.array(rows))]))
                cid = b.column(0).to_numpy()[rows]
                for p in range(first, first + passes):
                    signs = np.packbits(x @ _planes(seed, p, int(d)) > 0, axis=1)  # first sign = highest bit
                    key = signs.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)  # unsigned order as signed
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), p, np.int32)), pa.array(key.view(np.int64)), pa.array(cid)], names=["p", "key", "cid"])
    return fn


def _units(tab: pa.Table, at: int, to: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) of rows at..to, for each vector length among them."""
    part = tab.slice(at, to - at)
    lists = part.column("vec").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        x = matrix(pa.chunked_array([lists.take(pa.array(rows))]))
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
        yield rows + at, x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _unmet(x: np.ndarray, planes: np.ndarray, threshold: float, window: int, starts: bool, ends: bool) -> np.ndarray:
    """Per row of ``x`` (unit vectors in key order), the log probability that a partner at the threshold is in no window of this pass.

    A partner whose first other sign comes after those shared with the row ``window`` places on (or back, by the
    side it falls to) is in the window. ``starts``, ``ends``: the pass has no row before the first, after the last one.
    """
    n, d = x.shape
    side = x @ planes
    high = side > 0

    def shared(rows: np.ndarray, open_at: np.ndarray) -> np.ndarray:
        differ = high != high[rows]
        return np.where(open_at, -1, np.where(differ.any(axis=1), differ.argmax(axis=1), 64))[:, None]

    i = np.arange(n)
    above = shared(np.minimum(i + window, n - 1), ends & (i + window >= n))
    below = shared(np.maximum(i - window, 0), starts & (i < window))
    # a partner at angle a is cos(a) * row + sin(a) * (a direction across the row)
    across = np.sqrt(np.maximum((planes * planes).sum(axis=0) - side * side, 1e-12) / max(d - 1, 1))
    same = np.interp(np.abs(side) * (threshold / math.sqrt(max(1e-12, 1 - threshold * threshold))) / across, GRID, NORMAL)
    agree = np.cumprod(same, axis=1)
    first = np.concatenate((np.ones((n, 1)), agree[:, :-1]), axis=1) * (1 - same)      # the first other sign is this one
    meet = (first * (np.arange(64) > np.where(high, below, above))).sum(axis=1) + agree[:, -1] * (np.maximum(above, below)[:, 0] < 64)
    return np.log(np.maximum(1 - meet, 1e-12))


def _window_links(threshold: float, window: int, block: int, n: int, seed: int, step: int = 256):
    """(a, b, null): star edges of the links within windows of each (p, blk) run, rows in order of pos; (a, null, unmet): see ``_unmet``."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, ["p", "blk"], 1 << 12):
            bounds = group_bounds(tab, ["p", "blk"])
            cid, pos, blk, p = (tab.column(c).to_numpy() for c in ("cid", "pos", "blk", "p"))
            label = np.arange(len(cid))
            unmet = np.zeros(len(cid))
            for at, to in zip(bounds, bounds[1:]):
                for rows, x in _units(tab, int(at), int(to)):
                    unmet[rows] = _unmet(x, _planes(seed, int(p[at]), x.shape[1]), threshold, window, pos[at] == 0, pos[to - 1] == n - 1)
                    for s in range(int((pos[rows] // block < blk[at]).sum()), len(x), step):    # links from the halo before are found in its own block
                        e = min(s + step, len(x))
                        i, j = np.nonzero(x[s:e] @ x[s: e + window].T >= threshold)
                        near = (j > i) & (j - i <= window)
                        union_min(label, rows[i[near] + s], rows[j[near] + s])
            hung = np.flatnonzero(label != np.arange(len(cid)))
            home = np.flatnonzero(pos // block == blk)         # not the halo
            for a, b, u in ((cid[hung], pa.array(cid[label[hung]]), pa.nulls(len(hung), pa.float64())), (cid[home], pa.nulls(len(home), pa.int64()), pa.array(unmet[home]))):
                yield pa.RecordBatch.from_arrays([pa.array(a), b, u], names=["a", "b", "unmet"])
    return fn


def window_links(classes: DataFrame, n: int, first: int, passes: int, threshold: float, window: int, block: int, seed: int) -> DataFrame:
    """(a, b, unmet), written: edges between class ids found in the windows of ``passes`` passes from number ``first``, and each row's measure in each."""
    spark = classes.sparkSession
    keyed = arrow_map(classes.select("cid", "vec"), _keys(first, passes, seed), "p int, key long, cid long")
    placed = (
        keyed.repartitionByRange("p", "key", "cid").sortWithinPartitions("p", "key", "cid")
        .withColumn("at", F.monotonically_increasing_id())
    )
    placed = write_table(placed.select("p", "cid", "at", F.shiftright("at", 33).alias("part")), "projection-order")
    # one row per range partition and pass: positions of its first row
    parts = placed.groupBy("part", "p").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("p", "part").collect()
    before: dict[int, int] = {}
    offsets = []
    for r in parts:
        offsets.append((r["part"], r["p"], before.get(r["p"], 0) - r["first"]))
        before[r["p"]] = before.get(r["p"], 0) + r["n"]
    table = spark.createDataFrame(offsets, "part long, p int, shift long")
    pos = placed.join(F.broadcast(table), ["part", "p"]).select("p", "cid", (F.col("at") + F.col("shift")).alias("pos"))
    home = F.floor(F.col("pos") / block)
    within = F.col("pos") % block
    blocks = F.array_compact(F.array(home, F.when((within < window) & (home > 0), home - 1), F.when((within >= block - window) & ((home + 1) * block < n), home + 1)))
    dealt = pos.select("p", "cid", "pos", F.explode(blocks).alias("blk")).join(classes.select("cid", "vec"), "cid")
    dealt = dealt.select("p", "blk", "pos", "cid", "vec").repartition("p", "blk").sortWithinPartitions("p", "blk", "pos")
    return write_table(arrow_map(dealt, _window_links(threshold, window, block, n, seed), "a long, b long, unmet double"), "window-links")


def all_links(classes: DataFrame, n: int, threshold: float, window: int, block: int, recall: float, seed: int) -> DataFrame:
    """(node, component) of the links of all passes, with further passes for the rows that the measured ones do not cover."""
    aim = math.log(1 - recall)
    passes, done = passes_needed(n, threshold, window, recall), 0
    links, before, joined = None, None, None        # ``before``: (cid, unmet) of the passes before; ``joined``: classes hung on another
    while True:
        found = window_links(classes, n, done, passes, threshold, window, block, seed)
        done += passes
        edges = found.where(F.col("b").isNotNull()).select("a", "b")
        links = edges if links is None else links.unionByName(edges)
        unmet = found.where(F.col("b").isNull()).select(F.col("a").alias("cid"), "unmet")
        unmet = unmet if before is None else unmet.unionByName(before)
        open_rows = unmet.groupBy("cid").agg(F.sum("unmet").alias("unmet")).where(F.col("unmet") > aim)
        before = write_table(open_rows, "unmet")
        # passes that a row still needs at the rate measured so far
        need = F.ceil((F.lit(aim) - F.col("unmet")) / (F.least("unmet", F.lit(-1e-9)) / done))
        part = F.col("unmet") <= aim * done / CROWD
        left, apart, more = before.agg(F.count(F.lit(1)), F.count(F.when(part, 1)), F.percentile_approx(F.when(part, need), 0.9)).first()
        if left < 2:
            return connected_components(links)
        if not apart:
            components = connected_components(links)
            now = components.count()
            if now == joined:
                return components
            joined = now
        passes = max(1, min(ROUND, int(more or passes_needed(left, threshold, window, recall))))
        classes, n = write_table(classes.join(before.select("cid"), "cid", "left_semi"), "open-vectors"), left


def _cell_degrees(threshold: float, step: int = 512):
    """(cid, links) partial counts of each (component, lo, hi) cell: chunk lo against chunk hi."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "lo", "hi"]
        for tab in runs(batches, keys, 1 << 12):
            bounds = group_bounds(tab, keys)
            mult = tab.column("mult").to_numpy()
            side = tab.column("chunk").to_numpy() == tab.column("lo").to_numpy()
            inside = tab.column("lo").to_numpy() == tab.column("hi").to_numpy()
            links = np.zeros(tab.num_rows, np.int64)
            for at, to in zip(bounds, bounds[1:]):
                for rows, x in _units(tab, int(at), int(to)):
                    if inside[at]:
                        for s in range(0, len(x), step):
                            near = x[s: s + step] @ x.T >= threshold
                            here = np.arange(s, min(s + step, len(x)))
                            near[here - s, here] = False
                            links[rows[here]] += near @ mult[rows]
                    else:
                        a, b = np.flatnonzero(side[rows]), np.flatnonzero(~side[rows])
                        for s in range(0, len(a), step):
                            near = x[a[s: s + step]] @ x[b].T >= threshold
                            links[rows[a[s: s + step]]] += near @ mult[rows[b]]
                            links[rows[b]] += mult[rows[a[s: s + step]]] @ near
            yield pa.RecordBatch.from_arrays([tab.column("cid").combine_chunks(), pa.array(links)], names=["cid", "links"])
    return fn


def component_degrees(classes: DataFrame, members: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """(cid, links): how many vectors of other classes of its component each class links with.

    A component is cut into chunks of about ``chunk`` classes; every pair of
    chunks is one cell of bounded size, so a large component spreads over tasks.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    own = members.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    cells = (
        own.select("component", "cid", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("component", "cid", "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))
    )
    dealt = cells.join(classes, "cid").repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "cid")
    part = arrow_map(dealt.select("component", "lo", "hi", "chunk", "cid", "mult", "vec"), _cell_degrees(threshold), "cid long, links long")
    return part.groupBy("cid").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, window: int = 512,
                           block: int = 4096, chunk: int = 2048, recall: float = 0.998, seed: int = 7) -> DataFrame:
    """(id_col, n_links, component_id, kept) for every row of ``df``.

    Cosine in double precision; linked at ``threshold`` or above. Null, empty
    and zero vectors and those with null or non-finite components link with
    nothing (0 links, own component, kept), as do vectors of different
    lengths with one another. An id on several rows counts once as a partner
    (its smallest vector) and keeps its rows; a null id has 0 links, a null
    component and is kept. An empty table gives an empty result; other
    columns are ignored.
    """
    valid = write_table(valid_vectors(df, id_col, vec_col), "vectors")
    classes = write_table(valid.groupBy("vec").agg(F.min("id").alias("cid"), F.count(F.lit(1)).alias("mult")), "vector-classes")
    ids = df.select(F.col(id_col).cast("long").alias("id"))
    n = classes.count()
    links = all_links(classes, n, threshold, window, block, recall, seed) if n else None
    if links is None:
        return ids.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    roots = links.select("component").distinct().select(F.col("component").alias("cid"), "component")
    members = write_table(links.select(F.col("node").alias("cid"), "component").unionByName(roots), "vector-members")
    degrees = component_degrees(classes, members, threshold, chunk)
    of_class = classes.join(members, "cid", "left").join(degrees, "cid", "left").select(
        "vec", F.coalesce("component", "cid").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"))
    # copies of one vector are on the left; AQE splits a hot one
    of_id = valid.join(of_class, "vec").select("id", "component", "links")
    out = ids.join(of_id, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
