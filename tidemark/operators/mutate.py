"""Table mutations as rewrites: each returns the new content of the table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import anti


def update_where(df, predicate, assignments) -> DataFrame:
    """Set columns where the predicate is true; all right-hand sides see the old row."""
    values = {k: v if isinstance(v, Column) else F.lit(v) for k, v in assignments.items()}
    return df.select(*[
        F.when(predicate, values[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values
        else F.col(c) for c in df.columns])


def delete_where(df, predicate) -> DataFrame:
    """Drop rows where the predicate is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def delete_matching(df, other, keys) -> DataFrame:
    return anti(df, other, keys)


def insert_into(target, rows) -> DataFrame:
    """Target rows followed by ``rows``, matched by name and cast to the target's types."""
    cast = rows.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields if f.name in rows.columns])
    return target.unionByName(cast, allowMissingColumns=True)


def truncate(df) -> DataFrame:
    """No rows, same columns; does not scan ``df``."""
    return df.sparkSession.createDataFrame([], df.schema)
