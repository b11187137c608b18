"""Independent Spark jobs from driver threads, each in its own fair-scheduler pool."""
from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

POOL = "spark.scheduler.pool"


def in_parallel(thunks: list[Callable], spark: SparkSession | None = None, pool: str | None = None, at_once: int | None = None) -> list:
    """Run ``thunks`` at the same time; results in their order, the first error raised.

    With ``spark`` each runs in a scheduler pool of its own (``<pool>-<number>``), so that under
    ``spark.scheduler.mode=FAIR`` a fit of hundreds of small jobs isn't held up by another one's; under FIFO
    the pools have no effect. At most ``at_once`` run together.
    """
    if not thunks:
        return []

    def call(i: int):
        if spark is None:
            return thunks[i]()
        sc = spark.sparkContext
        before = sc.getLocalProperty(POOL)
        sc.setLocalProperty(POOL, f"{pool or 'riskloom'}-{i}")
        try:
            return thunks[i]()
        finally:
            sc.setLocalProperty(POOL, before)

    with ThreadPoolExecutor(max_workers=min(len(thunks), at_once or len(thunks))) as threads:
        return [f.result() for f in [threads.submit(call, i) for i in range(len(thunks))]]
