"""Writers. Content that replaces a table goes to a fresh folder, never over the one being read."""

from math import ceil

from pyspark.sql import DataFrame

from ..operators.layout import balanced, range_bucket
from ..schemas import with_audit_fields

# Text is written as it is; by default the CSV writer would trim values.
UNTRIMMED = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Rows of a bucket, about.
BUCKET_ROWS = 2_000_000


def write_csv(df, path):
    """CSV with a header, a folder of parts."""
    df.write.mode("overwrite").csv(path, header=True, **UNTRIMMED)


def write_delimited(df, path, quote_all=True, sep=",", header=True):
    """Delimited text, every value quoted, backslash as the escape."""
    df.write.mode("overwrite").csv(path, sep=sep, quoteAll=quote_all, escape="\\", header=header, **UNTRIMMED)


def write_parquet(df, path, partition_by=()):
    if partition_by:
        df = balanced(df, *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df, path, batch_id):
    """Add one batch as its own partition; repeating a batch replaces it instead of doubling it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def ctas(df, name, path) -> DataFrame:
    """Create a snappy parquet table from a query."""
    df.write.mode("overwrite").format("parquet").option("compression", "snappy").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def buckets_for(*tables, rows=BUCKET_ROWS) -> int:
    """Bucket count for tables that are to lie in the same buckets: the largest one's rows over ``rows``."""
    return max(1, *[ceil(t.count() / rows) for t in tables])


def write_bucketed(df, name, n, by, sort, path=None) -> DataFrame:
    """Table hashed into ``n`` buckets by a column and sorted inside, for repeated joins on it.

    A bucket is read by one task, so bucket tables whose keys are spread: dimensions, or facts
    already summed to the key.
    """
    writer = balanced(df, by).write.mode("overwrite").format("parquet").bucketBy(n, by).sortBy(sort)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def write_range_partitioned(df, path, col, bounds, name="range_id"):
    """RANGE RIGHT partitions: before the first bound, between bounds, from the last bound on."""
    balanced(df.withColumn(name, range_bucket(col, bounds)), name).write.mode("overwrite").partitionBy(name).parquet(path)


def copy_table(rows, path):
    """Copy the result of a query to a new folder."""
    rows.write.mode("errorifexists").parquet(path)


def materialize(df, name, path) -> DataFrame:
    """Store an aggregate as a table; a refresh gives a new ``path``."""
    return ctas(df, name, path)


def ensure_table(spark, name, schema, path, keys=()) -> DataFrame:
    """Create the target with its audit columns when it does not exist, keys not nullable."""
    if not spark.catalog.tableExists(name):
        full = with_audit_fields(schema)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{' NOT NULL' if f.name in keys else ''}"
                         for f in full.fields)
        location = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'")
    return spark.table(name)
