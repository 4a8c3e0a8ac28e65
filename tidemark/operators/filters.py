"""Row filters. All are plain predicates, so they reach the scan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import _col, is_blank


def where(df, predicate) -> DataFrame:
    return df.filter(predicate)


def where_between(df, col, low, high) -> DataFrame:
    """Inclusive on both ends."""
    return df.filter(_col(col).between(low, high))


def where_half_open(df, col, low, high) -> DataFrame:
    """``low <= col < high``, the shape that lines up with partition bounds."""
    return df.filter((_col(col) >= low) & (_col(col) < high))


def where_in(df, col, values) -> DataFrame:
    return df.filter(_col(col).isin(list(values)))


def where_like(df, col, pattern) -> DataFrame:
    return df.filter(_col(col).like(pattern))


def where_rlike(df, col, regex) -> DataFrame:
    return df.filter(_col(col).rlike(regex))


def where_contains(df, col, text) -> DataFrame:
    return df.filter(_col(col).contains(text))


def where_blank(df, col) -> DataFrame:
    return df.filter(is_blank(col))


def where_present(df, col) -> DataFrame:
    return df.filter(~is_blank(col))


def month_pruned(df, date_col, low, high, month_col="ym") -> DataFrame:
    """Half-open date filter plus the matching range on a derived ``yyyy-MM`` partition column.

    A date filter alone does not prune partitions of a derived column, so both are given.
    """
    months = F.col(month_col).between(str(low)[:7], str(high)[:7])
    return where_half_open(df, date_col, F.lit(str(low)).cast("timestamp_ntz"),
                           F.lit(str(high)).cast("timestamp_ntz")).filter(months)
