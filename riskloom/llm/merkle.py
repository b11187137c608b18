"""Merkle manifest of a dataset: 16-ary SHA-256 trees in van Emde Boas layout, and proofs from them.

Every row is a leaf; each source has its own tree over its leaves in order of id, and a tree over the sources' roots gives
the root of the dataset. Trees are stored as aligned blocks of ``LEVELS`` levels (4,096 leaves). A block's
digests lie in one byte string in van Emde Boas order: a subtree of height h is its upper half (height h // 2) followed by its
lower subtrees, each stored the same way, so that a path touches few neighbouring runs of bytes whatever the cache size; ``addresses`` gives the
place of every node by arithmetic, both to build a block and to read siblings. A block's root is its first digest, and
the roots of a tier of blocks are the leaves of the next tier, until one block is left.

Spark deals the blocks: leaves get their position in their source by one shuffle into value ranges (a source with a third
of all rows lies in many ranges), blocks of 4,096 are built apart, and each tier has 1/4,096 of the rows of the one below. Proofs go down the
same way: a block hands each of its leaves the siblings on the way to the root, which is what the block below needs. A task
holds one block and its 4,096 rows. The driver sees two numbers per tree (its number of tiers, by one aggregate).

Defined results: null fields are leaves' ``-``; a null source is a source, ordered first; rows with equal source and id are ordered by their digests (null ids
first), rows equal in all fields are leaves of their own; texts of any length are hashed whole; an empty table has no rows, no blocks and no
root. Only the five named columns are read, so other columns may have any name.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, bounded_hint, group_bounds, runs, write_table
from .line_dedup import ascii_lower

ARITY = 16
LEVELS = 3
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@lru_cache(maxsize=None)
def addresses(height: int) -> tuple[np.ndarray, ...]:
    """Van Emde Boas address of node i at depth d of a full tree of ``height`` levels of nodes, as one array per depth."""
    if height == 1:
        return (np.zeros(1, np.int64),)
    upper, lower = addresses(height // 2), addresses(height - height // 2)
    top, size = sum(map(len, upper)), sum(map(len, lower))
    deep = []
    for d, inside in enumerate(lower):
        i = np.arange(ARITY ** (len(upper) + d))
        deep.append(top + i // len(inside) * size + inside[i % len(inside)])
    return (*upper, *deep)


def tree_levels(n: int) -> int:
    """Levels of a tree over ``n`` leaves: 0 for a lone leaf."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def build_block(leaves: list[bytes], depth: int) -> bytes:
    """The digests of a block in van Emde Boas order; ``depth`` levels over at most ``ARITY ** depth`` leaf digests, missing nodes zero."""
    place = addresses(depth + 1)
    out = np.zeros((sum(map(len, place)), 32), np.uint8)
    row = leaves
    for d in range(depth, -1, -1):
        out[place[d][: len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, 32)
        if d:
            text = b"".join(row).hex().encode()
            row = [hashlib.sha256(text[at: at + 64 * ARITY]).digest() for at in range(0, len(text), 64 * ARITY)]
    return out.tobytes()


class Path(NamedTuple):
    """Siblings from a node to a root: (left, right) hex texts per level, and all of them joined."""

    steps: tuple[tuple[bytes, bytes], ...]
    joined: bytes

    def up(self, left: bytes, right: bytes) -> Path:
        """The path of a child: its own siblings come first."""
        return Path(((left, right), *self.steps), left + right + self.joined)

    def fold(self, digest: bytes) -> bytes:
        text = digest.hex().encode()
        for left, right in self.steps:
            text = hashlib.sha256(left + text + right).hexdigest().encode()
        return text

    def pack(self) -> bytes:
        return b"".join(bytes((len(left) // 64, len(right) // 64)) + bytes.fromhex((left + right).decode()) for left, right in self.steps)


def unpack(path: bytes) -> Path:
    steps, at = [], 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        text = path[at + 2: at + 2 + 32 * (left + right)].hex().encode()
        steps.append((text[: 64 * left], text[64 * left:]))
        at += 2 + 32 * (left + right)
    return Path(tuple(steps), b"".join(left + right for left, right in steps))


def leaf_paths(block: bytes, depth: int, m: int, above: Path) -> list[Path]:
    """Paths of the ``m`` leaves of a block whose root has the path ``above``."""
    place = addresses(depth + 1)
    digests = np.frombuffer(block, np.uint8).reshape(-1, 32)
    counts = [m]
    for _ in range(depth):
        counts.append(-(-counts[-1] // ARITY))
    paths = [above]
    for d in range(1, depth + 1):
        n = counts[depth - d]
        text = digests[place[d][:n]].tobytes().hex().encode()
        below = []
        for i in range(n):
            at = i // ARITY * ARITY * 64
            run, own = text[at: at + 64 * ARITY], 64 * (i % ARITY)
            below.append(paths[i // ARITY].up(run[:own], run[own + 64:]))
        paths = below
    return paths


def _field(c: str) -> Column:
    text = F.col(c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a row's five fields as 32 bytes, with ``text`` in place of its text if given."""
    parts = [_field(c) for c in FIELDS[:-1]]
    last = _field("text") if text is None else F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*parts, last), 256))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``gid`` (ascending by group, nulls first), ``n`` (the group's rows) and ``pos`` (its place in the group, from 0).

    One shuffle into ranges of (group, order); ties are numbered apart, so that no value has to fit one task.
    """
    keys = [group, *order, "tie"]
    placed = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    placed = write_table(placed.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), name)
    # one row per group and range
    parts = placed.groupBy(group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = write_table(parts.select(F.col(group).alias("of"), F.col("part").alias("in"), (before - F.col("first")).alias("shift"),
                                     F.sum("rows").over(whole).alias("n"), F.min("first").over(whole).alias("gid")), f"{name}-parts")
    found = placed.join(bounded_hint(parts), (F.col("part") == F.col("in")) & F.col(group).eqNullSafe(F.col("of")))
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "in", "of", "shift")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (gid, n, blk, pos, digest), sorted, to one row per block."""
    for tab in runs(batches, ["gid", "blk"], 1 << 12):
        bounds = group_bounds(tab, ["gid", "blk"])
        heads = tab.take(bounds[:-1]).select(["gid", "n", "blk"])
        n = heads.column("n").to_pylist()
        digests = tab.column("digest").to_pylist()
        built = [build_block(digests[at:to], min(LEVELS, tree_levels(total))) for at, to, total in zip(bounds, bounds[1:], n)]
        sizes = pa.array(np.diff(bounds))
        out = heads.append_column("m", sizes).append_column("nodes", pa.array(built, pa.binary()))
        yield from out.combine_chunks().to_batches()


def build_tiers(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The tiers of blocks, lowest first, over rows (gid, n, pos, digest): each (gid, n, blk, m, nodes), written."""
    most = leaves.agg(F.max("n")).first()[0] or 0       # one number
    tiers, nodes = [], leaves
    while most:
        dealt = nodes.select("gid", "n", F.expr(f"pos div {BLOCK}").alias("blk"), "pos", "digest")
        dealt = dealt.repartition("gid", "blk").sortWithinPartitions("gid", "blk", "pos")
        tiers.append(write_table(arrow_map(dealt, _blocks, "gid long, n long, blk long, m long, nodes binary"), f"{name}-tier{len(tiers)}"))
        above = tiers[-1].where(F.col("n") > BLOCK)
        nodes = above.select("gid", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("blk").alias("pos"), F.substring("nodes", 1, 32).alias("digest"))
        most = -(-most // BLOCK) if most > BLOCK else 0
    return tiers


def tree_roots(tiers: list[DataFrame]) -> DataFrame:
    """(gid, digest): the root of each tree."""
    tops = [t.where(F.col("n") <= BLOCK).select("gid", F.substring("nodes", 1, 32).alias("digest")) for t in tiers]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


class Manifest(NamedTuple):
    """``leaves``: (doc_id, gid, n, pos, digest, changed); ``trees``: tiers of the sources' trees; ``subroots``: (gid, pos, digest, source); ``top``: tiers over them."""

    leaves: DataFrame
    trees: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]


def build_manifest(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """The trees of ``docs``; ``changed`` is another digest per row, kept beside the leaf to be verified against its proof (the leaf itself if None)."""
    leaf = leaf_digest()
    rows = docs.select("doc_id", "source", leaf.alias("digest"), (leaf if changed is None else changed).alias("changed"))
    leaves = ranked(rows, "source", ["doc_id", "digest"], "merkle-leaves")
    trees = build_tiers(leaves, "merkle")
    if not trees:
        return Manifest(leaves, [], leaves.limit(0).select("gid", "pos", "digest", "source"), [])
    # sources are numbered in order: one more ranking, over one row per source
    sources = leaves.where(F.col("pos") == 0).select("gid", "source")
    roots = tree_roots(trees).join(sources, "gid").select(F.lit(0).cast("long").alias("whole"), F.col("gid").alias("tree"), "digest", "source")
    subroots = ranked(roots, "whole", ["tree"], "merkle-subroots").select("gid", "n", "pos", "digest", F.col("tree"), "source")
    return Manifest(leaves, trees, subroots.select(F.col("tree").alias("gid"), "pos", "digest", "source"), build_tiers(subroots, "merkle-top"))


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the paths of their roots (gid, n, blk, m, nodes, path) to (gid, pos, path) of their leaves."""
    for b in batches:
        for r in b.to_pylist():
            below = leaf_paths(r["nodes"], min(LEVELS, tree_levels(r["n"])), r["m"], unpack(r["path"]))
            pos = np.arange(r["m"], dtype=np.int64) + r["blk"] * BLOCK
            yield pa.RecordBatch.from_arrays([pa.array(np.full(r["m"], r["gid"], np.int64)), pa.array(pos), pa.array([p.pack() for p in below], pa.binary())], names=["gid", "pos", "path"])


def _with_paths(tiers: list[DataFrame], roots: DataFrame, name: str) -> DataFrame:
    """The lowest tier's blocks with the path of each block's root; ``roots``: (gid, path) of the trees' roots."""
    paths = None
    for t in reversed(range(len(tiers))):
        tops = tiers[t].where(F.col("n") <= BLOCK).join(roots, "gid")
        if paths is None:
            found = tops
        else:
            inner = tiers[t].join(paths.select("gid", F.col("pos").alias("blk"), "path"), ["gid", "blk"])
            found = inner.unionByName(tops)
        if t == 0:
            return found
        paths = write_table(arrow_map(found.select("gid", "n", "blk", "m", "nodes", "path"), _down, "gid long, pos long, path binary"), f"{name}-paths{t}")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block (pos -1, with nodes and path) followed by its leaves (doc_id, digest, changed): proofs and folded roots."""
    for tab in runs(batches, ["gid", "blk"], 1 << 12):
        bounds = group_bounds(tab, ["gid", "blk"])
        for at, to in zip(bounds, bounds[1:]):
            head, rows = tab.slice(at, 1).to_pylist()[0], tab.slice(at + 1, to - at - 1)
            above = unpack(head["path"])
            paths = leaf_paths(head["nodes"], min(LEVELS, tree_levels(head["n"])), rows.num_rows, above)
            leaf, changed = rows.column("digest").to_pylist(), rows.column("changed").to_pylist()
            root = (paths[0].fold(leaf[0])).decode()
            subroot = head["subroot"].hex()
            folded = [p.fold(c).decode() for p, c in zip(paths, changed)]
            m = rows.num_rows
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id").combine_chunks(), pa.array([x.hex() for x in leaf]), pa.array([subroot] * m), pa.array([root] * m),
                pa.array([hashlib.sha256(p.joined).hexdigest() for p in paths]), pa.array(folded), pa.array([f == root for f in folded])],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify_rows(spark, manifest: Manifest) -> DataFrame:
    """One row per leaf: its digest, subroot, root, the SHA-256 of its proof, and the root that ``changed`` folds to along it."""
    if not manifest.trees:
        return spark.createDataFrame([], RESULT)
    empty = manifest.top[-1].where(F.col("n") <= BLOCK).select("gid", F.lit(b"").alias("path"))
    tops = _with_paths(manifest.top, empty, "merkle-top")
    tops = arrow_map(tops.select("gid", "n", "blk", "m", "nodes", "path"), _down, "gid long, pos long, path binary").drop("gid")
    roots = write_table(manifest.subroots.join(tops, "pos").select("gid", "path", F.col("digest").alias("subroot")), "merkle-roots")
    blocks = _with_paths(manifest.trees, roots.select("gid", "path"), "merkle").join(roots.select("gid", "subroot"), "gid")
    none = F.lit(None)
    heads = blocks.select("gid", "blk", F.lit(-1).cast("long").alias("pos"), "n", "nodes", "path", "subroot", none.cast("long").alias("doc_id"),
                          none.cast("binary").alias("digest"), none.cast("binary").alias("changed"))
    rows = manifest.leaves.select("gid", F.expr(f"pos div {BLOCK}").alias("blk"), "pos", "n", none.cast("binary").alias("nodes"), none.cast("binary").alias("path"),
                                  none.cast("binary").alias("subroot"), "doc_id", "digest", "changed")
    dealt = heads.unionByName(rows).repartition("gid", "blk").sortWithinPartitions("gid", "blk", "pos")
    return arrow_map(dealt, _verify, RESULT)


def lowered_where(condition: Column) -> Column:
    """The leaf digest of a row whose text is lower-cased (A-Z) where ``condition`` holds."""
    text = F.col("text")
    return leaf_digest(F.when(condition, ascii_lower(text)).otherwise(text))
