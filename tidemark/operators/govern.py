"""Row filters, masks and limited views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_filter(df, col, principal) -> DataFrame:
    """Rows whose ``col`` equals the principal; NULL belongs to nobody."""
    return df.filter(F.col(col) == F.lit(principal))


def row_filter_view(df, name, col, principal) -> str:
    """Publish the filtered rows as a temporary view and return its name."""
    row_filter(df, col, principal).createOrReplaceTempView(name)
    return name


def predicate_function(spark, name, view, col) -> str:
    """Publish the filter as a table function of the principal: ``SELECT * FROM name('East')``.

    The optimizer inlines it, so the predicate reaches the scan behind the view.
    """
    schema = spark.table(view).schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(principal STRING) RETURNS TABLE ({fields}) "
              f"RETURN SELECT {columns} FROM {view} WHERE `{col}` = principal")
    return name


def default_mask(col, dtype, width=4):
    """Masked value by type: number 0, boolean false, date 1900-01-01, text XXXX, or as many X as a column of ``width`` below
    four holds, else NULL; NULL stays NULL. The mask never tells the value's own length."""
    c = F.col(col)
    if isinstance(dtype, T.NumericType):
        masked = F.lit(0)
    elif isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        masked = F.lit("1900-01-01")
    elif isinstance(dtype, T.StringType):
        masked = F.lit("X" * min(width, 4))
    elif isinstance(dtype, T.BooleanType):
        masked = F.lit(False)
    else:
        masked = F.lit(None)
    return F.when(c.isNotNull(), masked.cast(dtype)).alias(col)


def mask(df, cols, unmasked=False, widths=None) -> DataFrame:
    """Default-mask ``cols`` unless the reader may see them. ``widths`` names declared widths of narrow text columns."""
    if unmasked:
        return df
    hidden, widths = set(cols), widths or {}
    return df.select(*[default_mask(f.name, f.dataType, widths.get(f.name, 4)) if f.name in hidden else F.col(f.name)
                       for f in df.schema.fields])


def limited_view(df, cols) -> DataFrame:
    return df.select(*cols)


def register_udf(spark, name, fn):
    """Register a scalar function under ``name`` for SQL and return it for DataFrames."""
    return spark.udf.register(name, fn)
