"""Date and time expressions. Clock values are parameters, so a rerun gives the same rows."""

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conditional import _col


def literal(value, dtype) -> Column:
    """A driver value as a constant of a column's type.

    A Python time goes to a zone-less column as written; as a plain literal it would be an instant
    and shift by the session's zone.
    """
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(dtype)


def parse_ts(c, fmt="yyyy-MM-dd") -> Column:
    """Timestamp without zone; text that does not fit ``fmt`` becomes NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def fmt_date(c, fmt="yyyy-MM") -> Column:
    return F.date_format(_col(c), fmt)


def days_between(later, earlier) -> Column:
    return F.datediff(_col(later), _col(earlier))


def _epoch_seconds(c) -> Column:
    """Whole seconds since 1970 of a zone-less time, whatever the session's zone."""
    span = _col(c).cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    days, hours, minutes, seconds = (F.extract(F.lit(unit), span) for unit in ("DAY", "HOUR", "MINUTE", "SECOND"))
    whole = ((days.cast("long") * 24 + hours) * 60 + minutes) * 60
    return whole + F.floor(seconds).cast("long")


def seconds_between(start, stop) -> Column:
    """Count of whole-second boundaries crossed, as an audit run time."""
    return _epoch_seconds(stop) - _epoch_seconds(start)


def duration_minutes(start, stop) -> Column:
    """Minutes as a double; negative when ``stop`` precedes ``start``."""
    return seconds_between(start, stop) / F.lit(60.0)


def age_years(birth, asof) -> Column:
    """Whole years of 365.25 days at ``asof``."""
    asof = asof if isinstance(asof, Column) else F.to_date(F.lit(str(asof)))
    return F.floor(F.datediff(asof, _col(birth)) / F.lit(365.25))


def shift_days(c, n) -> Column:
    """Move a timestamp by whole days, keeping the time of day."""
    return _col(c) + F.make_dt_interval(days=F.lit(n))


def to_zone(c, zone="Asia/Kolkata", source="UTC") -> Column:
    """Wall time in ``zone`` of a zone-less time taken in ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(zone), _col(c).cast("timestamp_ntz"))


def stamp(now) -> Column:
    """One batch time for every row: a literal when given, else the query's own time."""
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(str(now)).cast("timestamp_ntz")
