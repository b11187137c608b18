"""Variable-capacity best-fit packing.

Items are packed into bins of several permitted capacities, each with a cost. Items go from the
longest down into the open bin that they fit best; where none fits, the capacity is
opened that costs least per unit it can still be filled with. The same is tried with each capacity alone, and
the cheapest plan is kept. At the end every bin is downsized to the smallest permitted
capacity that holds its contents.

Packing runs in units of about ``unit_items`` items, dealt by a hash of (id, piece, repeat): the
plan does not depend on partitions, and no unit grows with the data.
"""
from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, group_bounds, runs, write_table

CAPACITIES = (512, 1024, 2048, 4096, 8192)


def default_cost(capacity: int) -> float:
    """A step's work: its length, and a fixed part for starting a sequence."""
    return capacity + 64.0


def fit(lengths: list[int], capacities: list[int], costs: dict[int, float], open_only: int | None = None) -> list[tuple[int, list[int]]]:
    """(capacity, item numbers) of each bin, for lengths in descending order."""
    bins: list[tuple[int, list[int]]] = []
    free: list[tuple[int, int]] = []      # (room, bin), sorted
    left = sum(lengths)
    for i, n in enumerate(lengths):
        at = bisect_left(free, (n, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            fits = [c for c in capacities if c >= n]
            if open_only is not None and open_only >= n:
                room = open_only
            elif open_only is not None:
                room = fits[0]
            else:
                room = min(fits, key=lambda c: (costs[c] / max(1, min(c, left)), c))
            b = len(bins)
            bins.append((room, []))
        bins[b][1].append(i)
        insort(free, (room - n, b))
        left -= n
    return [(min(c for c in capacities if c >= sum(lengths[i] for i in items)), items) for _, items in bins]


def best_plan(lengths: list[int], capacities: list[int], costs: dict[int, float]) -> list[tuple[int, list[int]]]:
    plans = [fit(lengths, capacities, costs)] + [fit(lengths, capacities, costs, c) for c in capacities]
    return min(plans, key=lambda p: sum(costs[c] for c, _ in p))


def _pack(capacities: list[int], costs: dict[int, float]):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in runs(batches, ["unit"], 1):
            bounds = group_bounds(tab, ["unit"])
            for at, to in zip(bounds, bounds[1:]):
                part = tab.slice(int(at), int(to - at))
                lengths = part.column("length").to_numpy()
                plan = best_plan(lengths.tolist(), capacities, costs)
                order = pa.array(np.concatenate([np.array(items) for _, items in plan]))
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(items) for _, items in plan]))).astype(np.int32))
                items = part.select(["id", "piece", "length"]).take(order).to_batches()
                items = pa.Table.from_batches(items).combine_chunks()
                structs = pa.StructArray.from_arrays([items.column(c).combine_chunks() for c in ("id", "piece", "length")], names=["id", "piece", "length"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(plan), part.column("unit")[0].as_py(), np.int64)), pa.array(np.arange(len(plan), dtype=np.int32)),
                    pa.array(np.array([c for c, _ in plan], np.int32)), pa.array(np.array([int(lengths[i].sum()) for _, i in plan], np.int32)),
                    pa.ListArray.from_arrays(offsets, structs)], names=["unit", "bin", "capacity", "used", "items"])
    return fn


def pack_best_fit(items: DataFrame, id_col: str = "doc_id", length_col: str = "length", capacities: tuple[int, ...] = CAPACITIES, costs: dict[int, float] | None = None, unit_items: int = 8192) -> DataFrame:
    """(unit, bin, capacity, used, items array<struct<id, piece, length>>) per bin.

    An item longer than the largest capacity is cut into pieces of that capacity and a rest. A null, negative or
    zero length is an item of length 0, which stands in a bin and takes no room. Repeated rows are items of their own;
    null ids stay items. An empty table gives an empty result; other columns are ignored.
    """
    capacities = sorted(set(capacities))
    costs = costs or {c: default_cost(c) for c in capacities}
    most = capacities[-1]
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    # repeated rows are counted first, then spread again with a number each
    rows = rows.groupBy("id", "n").agg(F.count(F.lit(1)).alias("times")).select("id", "n", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("repeat"))
    pieces = rows.select("id", "repeat", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most) - 1, F.lit(0)))).alias("piece"))
    pieces = pieces.select("id", "repeat", F.col("piece").cast("int").alias("piece"), F.least(F.lit(most), F.col("n") - F.col("piece").cast("long") * most).cast("int").alias("length"))
    pieces = write_table(pieces, "packing-items")
    units = max(1, -(-pieces.count() // unit_items))
    dealt = pieces.withColumn("unit", F.pmod(F.xxhash64("id", "piece", "repeat", "length"), F.lit(units)))
    dealt = dealt.repartition("unit").sortWithinPartitions("unit", F.desc("length"), "id", "piece", "repeat").select("unit", "id", "piece", "length")
    return arrow_map(dealt, _pack(capacities, costs), "unit long, bin int, capacity int, used int, items array<struct<id:long,piece:int,length:int>>")
