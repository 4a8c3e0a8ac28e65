"""Arrays, structs and JSON text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .conditional import _col


def explode_col(c, alias) -> Column:
    """One row per element; NULL and empty arrays give no row."""
    return F.explode(_col(c)).alias(alias)


def zip_arrays(*cols, alias="zipped") -> Column:
    """Array of structs by position; the shorter array is filled with NULL."""
    return F.arrays_zip(*[_col(c) for c in cols]).alias(alias)


def parse_json(c, schema) -> Column:
    """Struct from JSON text or bytes; malformed text gives NULL fields."""
    return F.from_json(_col(c).cast("string"), schema)


def json_get(c, path) -> Column:
    """Text at a ``$.A.B`` path, NULL when absent."""
    return F.get_json_object(_col(c), path)


def build_json(spec, as_array=True) -> Column:
    """JSON text from ``{"Group": {"Field": column}}`` or ``{"Field": column}``; NULL fields are left out.

    A group whose fields are all NULL is left out too.
    """
    fields = []
    for name, value in spec.items():
        if isinstance(value, dict):
            cols = [_col(c) for c in value.values()]
            group = F.struct(*[c.alias(k) for k, c in zip(value, cols)])
            fields.append(F.when(F.coalesce(*[c.cast("string") for c in cols]).isNotNull(), group).alias(name))
        else:
            fields.append(_col(value).alias(name))
    row = F.struct(*fields)
    return F.to_json(F.array(row) if as_array else row)
