"""Target tables from a column catalogue: what to create, its key, and how to load it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import concat_group, flag_any, summarize
from ..operators.joins import anti

TABLE = ["CustomSchemaName", "TableName"]


def target_tables(catalogue, existing=None) -> DataFrame:
    """One row per table that does not exist yet.

    ``catalogue`` has a row per column: CustomSchemaName, TableName, ColumnName, DataType,
    ColumnId, IsPrimaryKey (``Yes`` or else). Tables with key and non-key columns are upserted,
    the others reloaded; the choice is made per table. ``/`` in a table name becomes ``_``.
    """
    missing = catalogue if existing is None else anti(catalogue, existing, TABLE)
    is_key = F.coalesce(F.col("IsPrimaryKey") == "Yes", F.lit(False))
    named = missing.withColumns({"__ddl": F.concat_ws(" ", "ColumnName", "DataType"), "__key": is_key})
    columns = concat_group(named, TABLE, "__ddl", "ColumnId", ", ", "ColumnNames", distinct=True)
    keys = concat_group(named.filter("__key"), TABLE, "ColumnName", "ColumnId", ", ", "KeyColumns", distinct=True)
    kinds = flag_any(named, TABLE, F.col("__key"), "HasKey").join(flag_any(named, TABLE, ~F.col("__key"), "HasOther"), TABLE)
    load = F.when((F.col("HasKey") == 1) & (F.col("HasOther") == 1), "upsert").otherwise("reload")
    out = columns.join(keys, TABLE, "left").join(kinds, TABLE)
    return out.select("CustomSchemaName", F.replace("TableName", F.lit("/"), F.lit("_")).alias("TableName"),
                      "ColumnNames", "KeyColumns", load.alias("LoadKind"))


def table_sizes(catalogue) -> DataFrame:
    """Columns and key columns per table."""
    key = F.when(F.col("IsPrimaryKey") == "Yes", F.col("ColumnName"))
    return summarize(catalogue, TABLE, Columns=F.count_distinct("ColumnName"), KeyColumns=F.count_distinct(key))
