"""Database source and sinks over JDBC.

Credentials come from the caller's secret store as ``properties``; none is kept here.
"""

from pyspark.sql import DataFrame


def read_options(url, query, properties=None, partition=None) -> dict:
    """Reader options. ``partition`` = (column, low, high, n) splits the read into n range queries;
    without it one task reads the whole result, so give it for anything large."""
    options = {"url": url, **(properties or {})}
    if partition is None:
        return options | {"query": query}
    column, low, high, n = partition
    # A partitioned read takes a table expression instead of a query.
    return options | {"dbtable": f"({query}) src", "partitionColumn": column, "lowerBound": str(low),
                      "upperBound": str(high), "numPartitions": str(n)}


def read_jdbc(spark, url, query, properties=None, partition=None) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, query, properties, partition)).load()


def write_jdbc(df, url, table, mode="append", properties=None, connections=16, batch=10_000):
    """Append to or replace a table over a bounded number of connections.

    A replace truncates, which keeps the table's own definition and grants.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    options = {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": str(batch),
               **(properties or {})}
    if mode == "overwrite":
        options["truncate"] = "true"
    df.write.format("jdbc").options(**options).mode(mode).save()
