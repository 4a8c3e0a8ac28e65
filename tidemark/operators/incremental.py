"""Watermark windows and control-row lookups."""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import _col
from ..functions.dates import literal, shift_days
from .quality import resolve_column
from .windows import latest

# Fixed value: the low bound when nothing was loaded yet.
FIRST_WATERMARK = "1900-01-01"


def high_water(df, col):
    """Greatest value of the watermark column; one column scan, one value on the driver."""
    return latest(df, col)


def incremental(df, col, last, hi=None, inclusive=False, lookback_days=0) -> DataFrame:
    """Rows in ``(last, hi]``, or ``[last, hi]`` when inclusive; ``hi`` defaults to the maximum.

    ``last`` None has no low bound, for a first load. Bounds are literals, so they reach the scan. ``lookback_days`` moves the low bound back to
    catch late rows; the upsert behind makes the overlap harmless.
    """
    name = resolve_column(df, col)
    if name is None:
        raise KeyError(f"watermark column {col!r} is missing")
    dtype = df.schema[name].dataType
    hi = high_water(df, name) if hi is None else hi
    c = _col(f"`{name}`")
    below = c <= literal(hi, dtype)
    if last is None:
        return df.filter(below)
    low = literal(last, dtype)
    if lookback_days:
        low = shift_days(low, -lookback_days).cast(dtype)
    return df.filter((c >= low if inclusive else c > low) & below)


def null_watermarks(df, col) -> DataFrame:
    """Rows a watermark can never pick up, to be reported; the condition reaches the scan."""
    return df.filter(F.col(f"`{col}`").isNull())


def advance(control, name, hi, key="table_name", value="last_loaded_ts", where=True) -> DataFrame:
    """Control rows with one object's watermark set; call after its data is written."""
    return control.withColumn(value, F.when((F.col(key) == name) & F.lit(where), literal(hi, control.schema[value].dataType))
                              .otherwise(F.col(value)))


def control_for(control, name, zone):
    """The control row of an object in a zone, or None."""
    match = (F.lower("SourceObjectName") == name.lower()) & (F.lower("DestinationZone") == zone.lower())
    return active(control).filter(match).orderBy("Controlid").first()


def active(control) -> DataFrame:
    """Control rows in use: all, but those whose ``IsActive`` says otherwise."""
    return control.filter(F.coalesce(F.col("IsActive").cast("boolean"), F.lit(True))) if "IsActive" in control.columns else control


def metadata_columns(text):
    """Column names of a control row's ``ColumnMetaData``, a JSON array of objects with ``ColumnName``; None if there is none."""
    return [c["ColumnName"] for c in json.loads(text)] or None if text else None


def extract(df, window=None, columns=None, blank_cols=(), col=None) -> DataFrame:
    """Extract of a control row: chosen columns, unsupported ones blanked, optional ``(low, high]``.

    ``columns`` is a list or the row's ``ColumnMetaData`` text. A bound that is None is open.
    Only comparisons and column names are used, so a database source evaluates them itself.
    """
    columns = (metadata_columns(columns) if isinstance(columns, str) else columns) or df.columns
    blank = {b.lower() for b in blank_cols}
    rows = df
    if window is not None:
        low, high = window
        dtype = df.schema[col].dataType
        if low is not None:
            rows = rows.filter(F.col(col) > literal(low, dtype))
        if high is not None:
            rows = rows.filter(F.col(col) <= literal(high, dtype))
    return rows.select(*[F.lit("").alias(c) if c.lower() in blank else F.col(c) for c in columns])
