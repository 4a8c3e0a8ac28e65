"""Projections. Each operator builds one ``select``, so plans stay flat."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import _col


def select_cols(df, *cols, **aliases) -> DataFrame:
    """Keep ``cols`` and add ``alias=source`` columns."""
    return df.select(*cols, *[_col(src).alias(name) for name, src in aliases.items()])


def with_exprs(df, **exprs) -> DataFrame:
    """All columns plus computed ones; strings are SQL expressions."""
    return df.withColumns({k: v if isinstance(v, Column) else F.expr(v) for k, v in exprs.items()})


def rename(df, mapping) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def standardize_names(df, style="snake") -> DataFrame:
    """``snake``: lower case, outer spaces dropped, inner spaces to ``_``; ``upper``: upper case."""
    if style == "upper":
        return df.toDF(*[c.upper() for c in df.columns])
    return df.toDF(*[c.lower().strip().replace(" ", "_") for c in df.columns])


def rename_positional(df, names) -> DataFrame:
    return df.toDF(*names)


def drop_cols(df, *cols) -> DataFrame:
    return df.drop(*cols)


def with_literal(df, name, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def cast_cols(df, mapping, safe=True) -> DataFrame:
    """Cast columns in place; ``safe`` turns values that do not fit into NULL."""
    def cast(name, dtype):
        return F.col(name).try_cast(dtype) if safe else F.col(name).cast(dtype)

    return df.withColumns({name: cast(name, dtype) for name, dtype in mapping.items()})


def cast_struct(df, name, schema) -> DataFrame:
    """Rename or retype the fields of a struct by position."""
    return df.withColumn(name, F.col(name).cast(schema))


def flatten(df, name, aliases=None) -> DataFrame:
    """Replace a struct column by its fields, renamed by ``aliases``."""
    aliases = aliases or {f: f for f in df.schema[name].dataType.names}
    keep = [c for c in df.columns if c != name]
    return df.select(*keep, *[F.col(f"{name}.{f}").alias(a) for f, a in aliases.items()])


def columns_of_type(df, dtype) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, dtype)]


def apply_by_type(df, dtype, fn) -> DataFrame:
    """Apply ``fn(column)`` to every column of a type, in one projection."""
    names = set(columns_of_type(df, dtype))
    return df.select(*[fn(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


def fill_defaults(df, mapping) -> DataFrame:
    """NULL to a per-column default, cast to the column's type; absent columns are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v).cast(df.schema[k].dataType)) for k, v in present.items()})


def with_scalar(df, name, one_row) -> DataFrame:
    """Add the single value of a one-row, one-column DataFrame as an operand."""
    return df.withColumn(name, one_row.scalar())


def pipe(df, *steps) -> DataFrame:
    return reduce(lambda acc, step: step(acc), steps, df)

