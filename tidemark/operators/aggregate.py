"""Grouped and global aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import _col


def summarize(df, keys, **aggs) -> DataFrame:
    """GROUP BY ``keys`` (names or aliased expressions); no keys means one global row."""
    cols = [agg.alias(name) for name, agg in aggs.items()]
    return df.groupBy(*keys).agg(*cols) if keys else df.agg(*cols)


def summarize_dict(df, keys, aggs, names=None) -> DataFrame:
    """``{column: function name}`` aggregates, renamed by ``{"fn(column)": name}``."""
    out = df.groupBy(*keys).agg(aggs)
    return out.withColumnsRenamed(names) if names else out


def ratio_of_sums(df, keys, a, b, name="ratio", **aggs) -> DataFrame:
    """SUM(a) / NULLIF(SUM(b), 0) beside other aggregates."""
    ratio = F.sum(_col(a)).cast("double") / F.nullif(F.sum(_col(b)).cast("double"), F.lit(0.0))
    return summarize(df, keys, **aggs, **{name: ratio})


def distinct_rows(df, *cols) -> DataFrame:
    return df.select(*cols).distinct()


def concat_group(df, keys, col, order, sep=",", name="value_list", distinct=False) -> DataFrame:
    """Ordered text concatenation of the ``col`` values of each group, repeats kept.

    The result holds a whole group in one text, so group by a fine key such as an order. With ``distinct`` repeats
    are removed before the gathering shuffle and a group gathers its distinct values (column names, categories) only.
    """
    order = [order] if isinstance(order, str) else list(order)
    slim = df.select(*keys, col, *[o for o in order if o != col and o not in keys])
    slim = slim.distinct() if distinct else slim
    entry = F.struct(*[F.col(o) for o in order], F.col(col).cast("string").alias("__text"))
    gathered = slim.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("__items"))
    return gathered.select(*keys, F.array_join(F.col("__items.__text"), sep).alias(name))


def flag_any(df, keys, predicate, name="flag") -> DataFrame:
    """1 for groups with at least one row satisfying the predicate, else 0."""
    return summarize(df, keys, **{name: F.max(F.when(predicate, 1).otherwise(0))})


def pivot(df, keys, col, values, agg) -> DataFrame:
    """Rows to columns; listing ``values`` spares the extra job that would find them."""
    return df.groupBy(*keys).pivot(col, list(values)).agg(agg)


def unpivot(df, ids, cols, name="name", value="value", drop_nulls=True) -> DataFrame:
    out = df.unpivot(list(ids), list(cols), name, value)
    return out.filter(F.col(value).isNotNull()) if drop_nulls else out
