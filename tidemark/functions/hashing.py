"""Row hashes and surrogate ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditional import _col


JSON_OPTIONS = {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def row_hash(cols, mode="sha2", encoding="UTF-8") -> Column:
    """Change-detection hash of ``cols`` in the given order.

    ``sha2`` hashes the row as JSON, so NULL, ``NA`` and embedded separators stay distinct. Times keep their microseconds
    and instants are written in UTC, so the hash does not depend on the session's zone.
    ``sha1`` is the compatible form: values joined by ``|``, NULL written ``NA``, 40 upper-case
    hex digits, over UTF-8 or UTF-16LE bytes.
    """
    if mode == "sha2":
        fields = F.struct(*[_col(c).alias(f"c{i}") for i, c in enumerate(cols)])
        return F.sha2(F.to_json(fields, JSON_OPTIONS), 256)
    if mode != "sha1":
        raise ValueError(f"unknown hash mode {mode!r}")
    text = F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols])
    return F.upper(F.sha1(F.encode(text, encoding)))


def natural_id(cols) -> Column:
    """Stable id from natural columns, 64 hex digits: equal rows get equal ids in every run, and NULL is a value of its own."""
    return row_hash(cols)


def surrogate_id() -> Column:
    """Unique in one run only; neither dense nor repeatable."""
    return F.monotonically_increasing_id()
