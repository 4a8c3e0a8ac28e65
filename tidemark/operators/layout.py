"""Physical placement: partitions, buckets, statistics, reuse."""

from contextlib import contextmanager
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a partition, about.
ROWS_PER_PARTITION = 1_000_000


def balanced(df, *cols, n=None) -> DataFrame:
    """Bring rows of equal ``cols`` together; adaptive execution splits a hot key over several tasks
    and merges small partitions."""
    return df.hint("rebalance", *([n] if n else []), *[F.col(c) for c in cols])


def repartition(df, n=None, *cols) -> DataFrame:
    """By count, by columns, or both; by columns, a hot key is split."""
    return balanced(df, *cols, n=n) if cols else df.repartition(n)


def partitions_for(df, rows=ROWS_PER_PARTITION) -> int:
    """Partition count by size: the rows of ``df`` over ``rows``."""
    return max(1, ceil(df.count() / rows))


def coalesce(df, n) -> DataFrame:
    return df.coalesce(n)


def distribute(df, how, col=None, n=None) -> DataFrame:
    """``hash`` on a column, ``replicate``, or ``round_robin``.

    Replication is the join's own: adaptive execution sends a side to every task once its size is known to be small, and a side
    that is not stays partitioned.
    """
    if how == "hash":
        return balanced(df, col, n=n)
    if how == "replicate":
        return df
    if how == "round_robin":
        return df.repartition(n or df.sparkSession.sparkContext.defaultParallelism)
    raise ValueError(f"unknown distribution {how!r}")


def range_bucket(col, bounds):
    """RANGE RIGHT partition number: 0 before the first bound, i from bound i on."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.lit(0)
    for i, bound in enumerate(sorted(bounds), start=1):
        out = F.when(c >= F.lit(bound), i).otherwise(out)
    return out


def analyze(spark, table, cols):
    """Collect row count and column statistics for the optimizer."""
    names = ", ".join(f"`{c}`" for c in cols)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {names}")


@contextmanager
def cached(df):
    """Keep a result for the queries of a ``with`` block; it spills to disk, can be recomputed, and is released at the end.

    What leaves the block must have been computed inside, by a write or an action.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
