"""Per-key ordered operators that stay safe when one key is very hot.

A window ``PARTITION BY key`` sends every row of a key to one task. For a
loan that is harmless (a loan has at most a few hundred monthly rows), but a
mis-keyed feed can put a third of all rows under one key. These helpers
count rows per key first (a partial aggregate, cheap), send ordinary keys
through the plain window and give hot keys a range-partitioned path: the
hot rows are spread over many tasks in key+order, each row gets its
position inside its partition, and per-(key, partition) offsets turn those
positions into a per-key index. Prior-row lookups for hot keys then become
an equi-join on (key, index), which is not skewed.

Top-k-per-key windows (``row_number() <= k``) need none of this: Catalyst
adds a partial WindowGroupLimit before the shuffle, so a hot key ships at
most k rows per map task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, RiskConfig
from ..session import durable

#: hashes by which rows are counted before keys
HASHES = 1 << 18

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def hot_keys(df: DataFrame, key: str, cfg: RiskConfig = DEFAULT):
    """Keys holding more than ``cfg.hot_key_rows`` rows, with a checked count.

    Returns ``(hot_df, n_hot)`` or ``None`` when no key is hot. The hot set
    is at most total_rows / hot_key_rows keys; it is broadcast only when its
    counted size is under ``cfg.max_broadcast_keys``. Rows are first counted per hash of the key
    (``HASHES`` counts a task, whatever the keys); only keys of hashes with enough rows are
    counted themselves. A written mart makes the check once and sets
    ``hot_key_rows`` to None where no loan is hot.
    """
    if cfg.hot_key_rows is None:
        return None
    hashed = F.pmod(F.xxhash64(key), F.lit(HASHES))
    near = df.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > cfg.hot_key_rows).select("_hash")
    if near.limit(1).count() == 0:
        return None
    counts = df.select(key).withColumn("_hash", hashed).join(near, "_hash", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter(F.col("_rows") > cfg.hot_key_rows).select(key)
    n_hot = hot.count()
    return (hot, n_hot) if n_hot else None


def _split(df: DataFrame, key: str, cfg: RiskConfig):
    found = hot_keys(df, key, cfg)
    if found is None:
        return df, None
    hot, n_hot = found
    hot_side = F.broadcast(hot) if n_hot <= cfg.max_broadcast_keys else hot
    return df.join(hot_side, key, "left_anti"), df.join(hot_side, key, "left_semi")


def range_index(df: DataFrame, key: str | None, order_cols: list, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """0-based index of each row within ``key`` (or globally) in ``order_cols`` order.

    Range-partitions on (key, order), records each row's position inside its
    partition, and adds the row counts of the same key in earlier partitions.
    No task ever holds more than one range partition, whatever the skew. The
    order must be total (add a unique tie-breaker).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ([key] if key else []) + list(order_cols)
    placed = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    # positions depend on the sampled range bounds: pin them before reuse
    placed = durable(placed)
    placed = placed.withColumn("_part", F.shiftright(F.col("_mid"), _POS_BITS))
    group = ([key] if key else []) + ["_part"]
    stats = placed.groupBy(*group).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per (key, partition): the window holds <= num_partitions rows per key
    stats = stats.withColumn("_offset", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    if key is None:
        stats = F.broadcast(stats)  # one row per range partition
    out_df = placed.join(stats.drop("_cnt"), group)
    return out_df.withColumn(out, (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("long")) \
        .drop("_mid", "_part", "_first", "_offset")


def row_index(df: DataFrame, key: str, order_cols: list, out: str,
              cfg: RiskConfig = DEFAULT) -> DataFrame:
    """0-based row number within ``key`` by ``order_cols`` (skew-safe)."""
    normal, hot = _split(df, key, cfg)
    w = Window.partitionBy(key).orderBy(*order_cols)
    ranked = normal.withColumn(out, (F.row_number().over(w) - 1).cast("int"))
    if hot is None:
        return ranked
    hot_ranked = range_index(hot, key, order_cols, out).withColumn(out, F.col(out).cast("int"))
    return ranked.unionByName(hot_ranked)


def with_prior(df: DataFrame, key: str, order_col: str, cols: dict[str, str],
               cfg: RiskConfig = DEFAULT, gap_months: int | None = None) -> DataFrame:
    """Add the previous observation's values (LAG 1 within key by order_col).

    ``cols`` maps source column -> output column. Ordinary keys use a lag
    window; hot keys are indexed in range partitions and joined to the row
    one position earlier. With ``gap_months`` the prior values are NULL
    unless the previous observation is exactly that many months earlier
    (calendar lag instead of prior observation). Rows that repeat a (key, order) are
    ordered by their other columns, so the prior row is the same on both paths.
    """
    want = dict(cols)
    if gap_months is not None:
        want[order_col] = "_prior_order"
    normal, hot = _split(df, key, cfg)
    order = [order_col, *[c for c in df.columns if c not in (key, order_col)]]
    w = Window.partitionBy(key).orderBy(*order)
    out = normal.select("*", *[F.lag(src).over(w).alias(dst) for src, dst in want.items()])
    if hot is not None:
        idx = range_index(hot, key, order, "_seq")
        prev = idx.select(F.col(key).alias("_pk"), (F.col("_seq") + 1).alias("_pseq"),
                          *[F.col(src).alias(dst) for src, dst in want.items()])
        joined = idx.join(prev, (idx[key] == prev["_pk"]) & (idx["_seq"] == prev["_pseq"]), "left") \
            .drop("_pk", "_pseq", "_seq")
        out = out.unionByName(joined)
    if gap_months is not None:
        on_time = F.add_months(F.col("_prior_order"), gap_months) == F.col(order_col)
        for dst in cols.values():
            out = out.withColumn(dst, F.when(on_time, F.col(dst)))
        out = out.drop("_prior_order")
    return out


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int, out: str = "rn") -> DataFrame:
    """Rows ranked 1..k within ``key`` (partial group limit runs before the shuffle)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)
