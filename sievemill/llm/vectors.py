"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str | Column) -> Column:
    """Whether a vector is not null, not zero, and all its components are finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(v, number) & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists without nulls, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def load(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>, dim); v is null for vectors that take no part."""
    v = F.when(usable(vector_col), F.col(vector_col).cast("array<double>"))
    return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).withColumn("dim", F.size("v"))
