"""Query registry, table access, and the mapping of the tables to the sales model."""

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is the same result as one SQL statement."""
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


class Tables:
    """The parquet tables of one scale-factor folder as attributes."""

    # Number of ranges in which rankings are split; None leaves each query its own choice.
    split = None

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder).rstrip("/")

    def __getattr__(self, name):
        return self.spark.read.parquet(self.path(name))

    def path(self, name):
        return f"{self.folder}/{name}.parquet"

    def scratch(self, label):
        return scratch_path(self.spark, label)

    def table_name(self, label):
        return f"{label}_{uuid.uuid4().hex[:12]}"


def json_arrays(df, path, chunk):
    """Input files of one JSON array each. ``chunk`` numbers rows so that a few dozen share a number."""
    arrays = df.groupBy(chunk.alias("__chunk")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def money(c):
    return F.col(c).cast("decimal(18,2)")


def as_double(c):
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def sales_fact(t):
    """Order lines with customer and region. The small tables are joined to orders before the lines are."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    buyers = t.customer.select("c_custkey", "c_nationkey").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    orders = t.orders.select("o_orderkey", "o_custkey").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("order_date"),
                        F.col("l_quantity").cast("bigint").alias("quantity"),
                        money("l_extendedprice").alias("total_amount"), F.col("r_name").alias("region"))


def products(t):
    return t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                         F.col("p_type").alias("category"))


FACT_SQL = """(SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
 l_shipdate AS order_date, CAST(l_quantity AS BIGINT) AS quantity,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount, r_name AS region
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
PRODUCTS_SQL = "(SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category FROM part)"


def title_sql(x):
    """Word-wise capitalisation in SQL."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            "lambda s: upper(s[1]) || s[2:]), ' ')")


def printable_sql(x):
    return f"regexp_replace({x}, '[^\\x20-\\x7E]', '', 'g')"


def collapse_sql(x):
    return f"regexp_replace({x}, '\\s+', ' ', 'g')"


def blank_sql(x, sentinel):
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '{sentinel}' ELSE {x} END"


def zip_sql(text):
    """Postal text from ``text``, already without an exponent."""
    cut = f"regexp_replace({text}, '\\.0$', '')"
    padded = f"CASE WHEN length({cut}) < 5 THEN lpad({cut}, 5, '0') ELSE {cut} END"
    return f"CASE WHEN {text} IS NULL OR trim({cut}) = '' THEN '00000' ELSE {padded} END"
