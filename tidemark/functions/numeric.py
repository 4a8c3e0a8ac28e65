"""Numeric expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditional import _col


def round_to(c, n=2) -> Column:
    return F.round(_col(c), n)


def fixed(c, n=2) -> Column:
    """Text with ``n`` decimals and thousands separators."""
    return F.format_number(_col(c), n)


def clamp_min(c, low=0) -> Column:
    """Values below ``low`` become ``low``; NULL stays NULL."""
    c = _col(c)
    return F.when(c < low, F.lit(low)).otherwise(c)


def convert(amount, rate, digits=2) -> Column:
    """Amount times rate, rounded."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    return F.round(_col(amount) * rate, digits)
