"""Column expressions. Every function takes and returns Columns; none runs Python per row."""

from .conditional import blank_to, case, first_non_null, is_blank, safe_divide
from .dates import (
    age_years,
    days_between,
    duration_minutes,
    fmt_date,
    parse_ts,
    seconds_between,
    shift_days,
    stamp,
    to_zone,
)
from .hashing import natural_id, row_hash, surrogate_id
from .nested import build_json, explode_col, json_get, parse_json, zip_arrays
from .numeric import clamp_min, convert, fixed, round_to
from .text import (
    collapse_ws,
    concat_blank,
    csv_list,
    expand_abbrev,
    norm_phone,
    norm_zip,
    pad_left,
    printable,
    replace_all,
    title,
    utf8,
    valid_uuid,
)

__all__ = [
    "age_years", "blank_to", "build_json", "case", "clamp_min", "collapse_ws", "concat_blank", "convert", "csv_list",
    "days_between", "duration_minutes", "expand_abbrev", "explode_col", "first_non_null", "fixed", "fmt_date", "is_blank",
    "json_get", "natural_id", "norm_phone", "norm_zip", "pad_left", "parse_json", "parse_ts", "printable", "replace_all",
    "round_to", "row_hash", "safe_divide", "seconds_between", "shift_days", "stamp", "surrogate_id", "title", "to_zone",
    "utf8", "valid_uuid", "zip_arrays",
]
