"""Connected components of an edge table, as rounds of joins and min-aggregates.

Alternating star contraction: in a large-star step every node hangs its
larger neighbours on its smallest neighbour, in a small-star step its smaller
ones. Both are a ``groupBy().min`` (combined map-side, so a hub's edges are
never gathered) and an equi-join that AQE may split on a hub. Each round is
written to the shared folder; the driver sees one checksum row per round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table


def _hash(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge that isn't its component's smallest node.

    Nulls and self-loops link nothing, repeated edges count once, an empty
    table gives an empty result. Callers coalesce missing nodes to themselves.
    """
    e = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    e = write_table(e, "edges")
    seen = _hash(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(root, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(root.select("u", F.col("m").alias("v"))).distinct()
        )
        e = write_table(small, "edges")
        now = _hash(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
