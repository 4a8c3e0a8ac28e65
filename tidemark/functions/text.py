"""Text cleaning expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditional import _col, blank_to

# Honorifics and their long forms, applied in this order.
HONORIFICS = {"Dr.": "Doctor", "Mr.": "Mister", "Mrs.": "Missus"}

# Sentinels for missing values.
NO_ZIP = "00000"
NOT_PROVIDED = "Not Provided"
UNKNOWN = "Unknown"
UNKNOWN_CATEGORY = "UNKNOWN"
NOT_APPLICABLE = "N/A"


def title(c) -> Column:
    """Upper-case the first letter of each space-separated word, lower-case the rest."""
    return F.initcap(_col(c))


def concat_blank(*cols) -> Column:
    """Concatenate with NULL read as the empty string."""
    return F.concat_ws("", *[_col(c).cast("string") for c in cols])


def replace_all(c, pairs) -> Column:
    """Literal replacements, applied in the order of ``pairs``."""
    items = pairs.items() if isinstance(pairs, dict) else pairs
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), items, _col(c))


def expand_abbrev(c, mapping=None) -> Column:
    return replace_all(c, HONORIFICS if mapping is None else mapping)


def collapse_ws(c) -> Column:
    return F.regexp_replace(_col(c), r"\s+", " ")


def printable(c) -> Column:
    """Keep only ASCII space to tilde."""
    return F.regexp_replace(_col(c), r"[^\x20-\x7E]", "")


def pad_left(c, n, ch="0") -> Column:
    """Left-pad shorter values; longer ones keep their length (plain lpad would cut them)."""
    c = _col(c)
    return F.when(F.length(c) < n, F.lpad(c, n, ch)).otherwise(c)


def utf8(c) -> Column:
    return F.encode(_col(c), "UTF-8")


def csv_list(cols, quote='"', sep=", ") -> Column:
    """Quoted values joined by ``sep``; NULL entries are skipped."""
    return F.concat_ws(sep, *[F.concat(F.lit(quote), _col(c).cast("string"), F.lit(quote)) for c in cols])


def norm_zip(c, numeric=False) -> Column:
    """Five-digit postal text: drop a trailing ``.0``, left-pad, blank becomes ``00000``.

    ``numeric`` marks a floating input, whose whole values are written without an exponent.
    """
    c = _col(c)
    if numeric:
        whole = F.floor(c).cast("decimal(20,0)").cast("string")
        c = F.when((c == F.floor(c)) & (F.abs(c) < 1e18), whole).otherwise(c.cast("string"))
    return pad_left(blank_to(F.regexp_replace(F.trim(c.cast("string")), r"\.0$", ""), NO_ZIP), 5, "0")


def norm_phone(c) -> Column:
    """Digits only; nothing left becomes ``Not Provided``."""
    return blank_to(F.regexp_replace(_col(c).cast("string"), "[^0-9]", ""), NOT_PROVIDED)


def valid_uuid(c) -> Column:
    """``Valid`` for 32 hex digits, dashes ignored; anything else, NULL too, is ``Invalid``."""
    ok = F.replace(_col(c), F.lit("-"), F.lit("")).rlike("^[0-9a-fA-F]{32}$")
    return F.when(ok, "Valid").otherwise("Invalid")
