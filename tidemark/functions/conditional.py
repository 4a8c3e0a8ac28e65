"""Branches, defaults and guarded division."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case(branches, default=None) -> Column:
    """First matching (condition, value) pair wins; conditions may nest other cases."""
    out = None
    for condition, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def first_non_null(*cols) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def safe_divide(a, b) -> Column:
    """a / b, NULL when b is zero, as ``a / NULLIF(b, 0)``."""
    return _col(a) / F.nullif(_col(b), F.lit(0))


def is_blank(c) -> Column:
    """NULL, empty or only spaces; never NULL itself."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def blank_to(c, sentinel) -> Column:
    return F.when(is_blank(c), F.lit(sentinel)).otherwise(_col(c))
