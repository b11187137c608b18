"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, write_table

__all__ = ["bounded_hint", "held_out", "label_sample", "runs", "scratch_path", "ship_package", "slices", "table", "union_min", "write_table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/riskloom-llm/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per session), wherever they start."""
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    base = os.path.join(tempfile.mkdtemp(prefix="riskloom-pkg-"), "riskloom_pkg")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "riskloom"))  # Spark serves it to every executor
    sc._riskloom_shipped = True


def bounded_hint(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to hold at most ``max_rows`` (narrow) rows; else as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def held_out(doc_id: Column) -> Column:
    """True for the evaluation fifth: crc32(doc_id as text) mod 5 is 0."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % 5) == 0


def label_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[DataFrame, int]:
    """(doc_id, text, y) of at most ``max_rows`` labelled training rows, those with the smallest hashes of the id, and their number.

    Rows are counted and cut at a hash that about twice as many pass before they are ordered, so that what one task orders
    doesn't grow with the partitions. Only rows outside the held-out fifth are used. A doc_id with several
    labels or texts counts once (largest label, smallest text).
    """
    keys = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")).withColumn("h", F.xxhash64("doc_id"))
    )
    near = F.col("h") <= F.lit(hash_cut(keys.count(), max_rows))
    keys = write_table(keys.where(near).orderBy("h", "doc_id").limit(max_rows).drop("h"), "label-keys")  # at most max_rows narrow rows
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(keys), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")), keys.count()


def hash_cut(n: int, wanted: int) -> int:
    """A 64-bit hash that about ``2 * wanted`` of ``n`` hashes are at or below (all of them if there are fewer)."""
    return (1 << 63) - 1 if n <= 2 * wanted else -(1 << 63) + int((2 * wanted / n) * 2.0 ** 64)


def slices(values: pa.Array, most_bytes: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole texts of about ``most_bytes``: (first row, UTF-8 bytes, text starts with the end).

    A null text is empty; a text longer than the bound is a run of its own.
    """
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset: values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8) if values.buffers()[2] is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(values):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        yield at, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], most_rows: int) -> Iterator[pa.Table]:
    """Rows sorted by ``keys`` as tables of whole key groups of at least ``most_rows`` rows (the last may be smaller).

    Only the group that is still open is held beyond that, so callers bound a group's size before.
    """
    held: list[pa.Table] = []
    n = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(pa.Table.from_batches([b]))
        n += b.num_rows
        if n < most_rows:
            continue
        whole = pa.concat_tables(held)
        same = np.ones(whole.num_rows, bool)
        for k in keys:
            col = whole.column(k).to_numpy()
            same &= col == col[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield whole.slice(0, cut)
            whole = whole.slice(cut)
        held, n = [whole], whole.num_rows
    if n:
        yield pa.concat_tables(held)


def group_bounds(tab: pa.Table, keys: list[str]) -> np.ndarray:
    """Starts of the key groups of a sorted table, with the end."""
    change = np.zeros(tab.num_rows, bool)
    change[0] = True
    for k in keys:
        col = tab.column(k).to_numpy()
        change[1:] |= col[1:] != col[:-1]
    return np.append(np.flatnonzero(change), tab.num_rows)


def union_min(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of the pairs (i, j) in place; a class is named by its smallest position."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)
