"""SimHash near-dedup with bit-sliced comparison.

A text's fingerprint has a bit where over half of its word shingles' XXH64
values have it. Fingerprints within ``radius`` bits link; a group of documents
is a connected component of links.

Work runs on distinct fingerprints. By the pigeonhole principle two words of
64 bits within 3 bits agree on one of four 16-bit blocks, so each fingerprint
goes to four buckets; a bucket above ``split_above`` fingerprints is split
again on its other 48 bits (four blocks of 12), and then on the other 36 (four
of 9), so that no bucket of similar fingerprints meets whole in one task.
Within a bucket 64 fingerprints at a time are stored as vertical bit planes; a
carry-save counter per lane adds up differing bits for all lanes at once, and a
block is abandoned when every lane exceeds the radius. A task emits a spanning
forest of the links it has found, not the pairs.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, group_bounds, runs, union_min, write_table
from .components import connected_components

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: bits of the pigeonhole blocks at each level (4 blocks each of what is left)
LEVELS = (16, 12, 9)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``."""
    words = text.lower().split()  # bytes: only ASCII letters and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    one = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((one(joined[i:j], seed) for i, j in spans), np.uint64, len(words) - k + 1)
    # counts of each byte value at each of the 8 byte places, then of each bit
    counts = np.zeros(2048, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8).astype(np.int64) + 256 * np.arange(8)
        counts += np.bincount(part.ravel(), minlength=2048)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    set_in = (counts.reshape(8, 256) @ bits).ravel()
    return int.from_bytes(np.packbits(2 * set_in > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    """(id, fp long) per row; a null text is empty."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py() or b"", shingle, seed) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, fn, "id long, fp long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(blocks, 64) planes of 64-value blocks: bit l of plane b is bit b of the block's value l."""
    blocks = -(-len(values) // 64)
    lanes = np.zeros(blocks * 64, np.uint64)
    lanes[: len(values)] = values
    lanes = lanes.reshape(blocks, 64)
    planes = np.empty((blocks, 64), np.uint64)
    at = np.arange(64, dtype=np.uint64)
    for bit in range(64):
        planes[:, bit] = np.bitwise_or.reduce(((lanes >> np.uint64(bit)) & np.uint64(1)) << at, axis=1)
    return planes


def bit_sliced_links(values: np.ndarray, ends: np.ndarray, radius: int, items: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Position pairs i < j < ends[i] whose values differ in at most ``radius`` bits, in chunks.

    ``ends[i]`` is the end of the bucket of position i. A work item is one
    value against one block of 64 lanes of its bucket.
    """
    planes = bit_planes(values)
    n = len(values)
    first = (np.arange(n) + 1) >> 6
    per = np.where(ends > np.arange(n) + 1, ((ends - 1) >> 6) - first + 1, 0)
    total = np.concatenate(([0], np.cumsum(per)))
    k = int(radius).bit_length()
    spare = (1 << k) - 1 - radius  # counters start here, so that overflow means "over the radius"
    for at in range(0, int(total[-1]), items):
        to = min(at + items, int(total[-1]))
        which = np.arange(at, to)
        q = np.searchsorted(total, which, "right") - 1
        blk = first[q] + which - total[q]
        # lanes outside (i, end of bucket) count as exceeded
        low = np.clip(q + 1 - (blk << 6), 0, 64)
        high = np.clip(ends[q] - (blk << 6), 0, 64)
        ones = lambda x: np.where(x >= 64, FULL, (np.uint64(1) << np.minimum(x, 63).astype(np.uint64)) - np.uint64(1))
        over = ~(ones(high) & ~ones(low))
        count = [np.full(len(q), FULL if spare >> c & 1 else 0, np.uint64) for c in range(k)]
        value = values[q]
        for bit in range(64):
            carry = planes[blk, bit] ^ (np.uint64(0) - ((value >> np.uint64(bit)) & np.uint64(1)))
            for c in range(k):  # carry-save add of one bit per lane
                count[c], carry = count[c] ^ carry, count[c] & carry
            over |= carry
            if bit & 7 == 7:  # abandon blocks of which every lane has exceeded the radius
                live = over != FULL
                if not live.all():
                    q, blk, over, value = q[live], blk[live], over[live], value[live]
                    count = [c[live] for c in count]
                if not len(q):
                    break
        if len(q):
            found = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            item, lane = np.nonzero(found)
            yield q[item], (blk[item] << 6) + lane


def _bucket_links(radius: int):
    """Star edges (a, b) of the links within each bucket of rows sorted by bucket."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, ["bucket"], 1 << 17):
            fps = tab.column("fp").to_numpy().view(np.uint64)
            bounds = group_bounds(tab, ["bucket"])
            ends = np.repeat(bounds[1:], np.diff(bounds))
            label = np.arange(len(fps))
            for i, j in bit_sliced_links(fps, ends, radius):
                union_min(label, i, j)
            hung = np.flatnonzero(label != np.arange(len(fps)))
            if len(hung):
                yield pa.RecordBatch.from_arrays([pa.array(fps[hung].view(np.int64)), pa.array(fps[label[hung]].view(np.int64))], names=["a", "b"])
    return fn


def _blocks(rest: Column, width: int) -> Column:
    """The four blocks of ``width`` bits of ``rest``: structs (part: block number and bits; left: the other bits)."""
    out = []
    for b in range(4):
        part = F.shiftrightunsigned(rest, b * width).bitwiseAND(F.lit((1 << width) - 1))
        below = rest.bitwiseAND(F.lit((1 << (b * width)) - 1))
        above = F.shiftleft(F.shiftrightunsigned(rest, (b + 1) * width), b * width) if (b + 1) * width < 64 else F.lit(0).cast("long")
        out.append(F.struct((part + F.lit(b << width).cast("long")).alias("part"), above.bitwiseOR(below).alias("left")))
    return F.array(*out)


def fingerprint_links(fps: DataFrame, radius: int = 3, split_above: int = 8192) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) within ``radius`` (0 to 3) bits."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks find every pair for a radius of 0 to 3 bits")
    fps = fps.select("fp").distinct()
    edges = None
    rows = fps.select("fp", F.lit(0).cast("long").alias("bucket"), F.col("fp").alias("rest"))
    for level, width in enumerate(LEVELS):
        rows = (
            rows.select("fp", "bucket", F.explode(_blocks(F.col("rest"), width)).alias("x"))
            .select("fp", (F.shiftleft("bucket", width + 2) + F.col("x.part")).alias("bucket"), F.col("x.left").alias("rest"))
        )
        ready = rows
        if level < len(LEVELS) - 1:
            counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
            large = write_table(counts.where(F.col("n") > split_above).select("bucket"), "large-buckets")
            if large.limit(1).count():
                ready = rows.join(large, "bucket", "left_anti")
                rows = rows.join(large, "bucket", "left_semi")
            else:
                rows = None
        found = arrow_map(ready.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp"), _bucket_links(radius), "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        if rows is None:
            break
    return edges


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
                   seed: int = 42, split_above: int = 8192) -> DataFrame:
    """(id_col, fp long, component_id) per row of ``docs``.

    ``component_id`` is the smallest id of the documents reachable by links,
    itself included. A null or word-less text has fingerprint 0 and links like
    any other. Repeated rows stay; a null id keeps its row and names no group
    (null component where no member has an id). An empty table gives an empty
    result; other columns are ignored.
    """
    marks = write_table(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    fps = marks.groupBy("fp").agg(F.min("id").alias("least"))
    links = connected_components(fingerprint_links(fps, radius, split_above))
    rooted = fps.join(links.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    # the marks' side holds the copies; AQE splits a hot fingerprint
    return marks.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
