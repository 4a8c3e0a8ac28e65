"""Data-quality checks. Each returns a small report row, never the data."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_count(df, expected) -> DataFrame:
    """One row: actual and expected row count and a pass/fail status."""
    status = F.when(F.col("actual") == expected, "passed").otherwise("failed")
    return df.agg(F.count("*").alias("actual")).select("actual", F.lit(expected).cast("long").alias("expected"),
                                                       status.alias("status"))


def duplicate_keys(df, keys) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def check_key(df, keys) -> DataFrame:
    """One row: NULL-key rows, duplicated keys, and whether the key is unique and complete."""
    null_key = reduce(lambda p, q: p | q, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    report = per_key.agg(
        F.coalesce(F.sum(F.when(null_key, F.col("__n"))), F.lit(0)).alias("null_key_rows"),
        F.count(F.when((F.col("__n") > 1) & ~null_key, 1)).alias("duplicate_keys"))
    return report.withColumn("status", F.when((F.col("null_key_rows") == 0) & (F.col("duplicate_keys") == 0),
                                              "passed").otherwise("failed"))


def check_lengths(df, limits) -> DataFrame:
    """One row per text column of ``{column: longest allowed}``: longest value, limit, status."""
    longest = df.agg(*[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(c) for c in limits])
    rows = longest.unpivot([], list(limits), "name", "longest")
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("name"))
    return rows.withColumn("allowed", limit).withColumn(
        "status", F.when(F.col("longest") <= F.col("allowed"), "passed").otherwise("failed"))


def _plain(name):
    return name.strip().lower().replace(" ", "_")


def resolve_column(df, name):
    """The column that equals ``name`` up to case and spaces, or None."""
    matches = [c for c in df.columns if c == name] or [c for c in df.columns if _plain(c) == _plain(name)]
    return matches[0] if matches else None


def require(df, names) -> list[str]:
    """Required columns that ``df`` lacks; empty means the entity can be loaded."""
    return [n for n in names if resolve_column(df, n) is None]
