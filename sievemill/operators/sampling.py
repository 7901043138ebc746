"""Heads and samples in a defined order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def head(df: DataFrame, n: int | None, ord_col: str = "ord") -> DataFrame:
    """The first n rows by order; all of them if n is null or 0."""
    return df.orderBy(ord_col).limit(n) if n else df


def sample_size(total: int, rate: float) -> int:
    """One row at least, unless there is none."""
    return min(max(1, int(total * rate)), total)


def sample_order(id_col: str = "qa_id", seed: str = "1") -> Column:
    """The order in which rows are drawn: by a digest of seed and id."""
    return F.md5(F.concat(F.lit(seed), F.col(id_col)).cast("binary"))


def fixed_sample(df: DataFrame, rate: float, id_col: str = "qa_id", seed: str = "1", ord_col: str = "ord") -> DataFrame:
    """sample_size rows without replacement: those with the smallest digests of seed and id.

    The digests' first four hex digits are counted (65,536 rows at most reach the driver); only the rows at the
    one prefix where the sample ends are put in order.
    """
    digest = sample_order(id_col, seed)
    prefix = F.substring(digest, 1, 4)
    counts = sorted(tuple(r) for r in df.groupBy(prefix.alias("p")).agg(F.count("*").alias("n")).collect())
    left = sample_size(sum(n for _, n in counts), rate)
    for p, n in counts:
        if n >= left:
            return df.filter(prefix < p).unionByName(df.filter(prefix == p).orderBy(digest, ord_col).limit(left))
        left -= n
    return df.limit(0)
