"""Vector columns: which rows take part, and their packed form."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _fine(x) -> F.Column:
    """A finite, non-zero, non-empty vector."""
    return (x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
            & F.exists(x, lambda v: v != 0))


def vector_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec array<double>): every row with a finite, non-zero, non-empty vector, whatever its id."""
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(_fine(F.col("vec")))


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, vec array<double>): rows with an id and a finite, non-zero, non-empty vector.

    An id that stands on several rows counts once, with its smallest vector.
    """
    return vector_rows(df, id_col, vec_col).where(F.col("id").isNotNull()).groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """(rows, d) doubles of a list column whose lists have one length."""
    col = column.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)
