"""Quality checks, row filters, masks, functions, placement."""

import pandas as pd
from pyspark.sql import functions as F

from ..functions.text import HONORIFICS
from ..operators import govern, layout, quality
from .base import query


@query("dq_row_count", """SELECT count(*) AS actual, (SELECT count(*) FROM events) AS expected,
 CASE WHEN count(*) = (SELECT count(*) FROM events) THEN 'passed' ELSE 'failed' END AS status FROM orders""")
def _(t):
    return quality.check_count(t.orders, t.events.count())


@query("dq_unique_key", """SELECT 'customer' AS name, 0 AS duplicate_keys, 'passed' AS status UNION ALL
 SELECT 'lineitem', count(*), CASE WHEN count(*) = 0 THEN 'passed' ELSE 'failed' END
 FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(t):
    one = quality.check_key(t.customer, ["c_custkey"]).withColumn("name", F.lit("customer"))
    two = quality.check_key(t.lineitem, ["l_orderkey", "l_linenumber"]).withColumn("name", F.lit("lineitem"))
    return one.unionByName(two).select("name", "duplicate_keys", "status")


@query("dq_text_length", """SELECT 'lang' AS name, CAST(max(length(lang)) AS INTEGER) AS longest, 10 AS allowed, 'passed' AS status FROM documents
 UNION ALL SELECT 'text', CAST(max(length(text)) AS INTEGER), 50, CASE WHEN max(length(text)) <= 50 THEN 'passed' ELSE 'failed' END FROM documents""")
def _(t):
    return quality.check_lengths(t.documents, {"lang": 10, "text": 50})


@query("dq_required_column", "SELECT o_orderkey, 'loaddatetime' AS missing FROM orders")
def _(t):
    missing = quality.require(t.orders, ["O_ORDERKEY", "loaddatetime"])
    return t.orders.select("o_orderkey", F.lit(",".join(missing)).alias("missing"))


REGIONAL_SQL = """SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'"""


def _regional(t):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")


@query("gov_row_filter", REGIONAL_SQL)
def _(t):
    return govern.row_filter(_regional(t), "r_name", "ASIA")


@query("udf_table_predicate", REGIONAL_SQL)
def _(t):
    view = t.table_name("regional")
    _regional(t).createOrReplaceTempView(view)
    name = govern.predicate_function(t.spark, t.table_name("rows_of"), view, "r_name")
    return t.spark.sql(f"SELECT c_custkey, r_name FROM {name}('ASIA')")


@query("gov_mask_default", """SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN CAST(0 AS DOUBLE) END AS o_totalprice,
 'X' AS o_orderstatus, 'XXXX' AS o_orderpriority,
 TIMESTAMP '1900-01-01' AS o_orderdate, FALSE AS urgent FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("o_totalprice"),
                           "o_orderstatus", "o_orderpriority", "o_orderdate", (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    # The status column is declared one character wide; the mask follows the column, never the value.
    return govern.mask(rows, ["o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate", "urgent"], widths={"o_orderstatus": 1})


@query("gov_limited_view", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def _(t):
    return govern.limited_view(t.lineitem, ["l_orderkey", "l_partkey", "l_quantity"])


@query("udf_scalar", """SELECT conv_id, turn, replace(replace(replace(CASE role WHEN 'user' THEN 'Mr. ' ELSE 'Dr. ' END || text,
 'Dr.', 'Doctor'), 'Mr.', 'Mister'), 'Mrs.', 'Missus') AS expanded FROM conversations""")
def _(t):
    @F.pandas_udf("string")
    def expand(text: pd.Series) -> pd.Series:
        for short, long in HONORIFICS.items():
            text = text.str.replace(short, long, regex=False)
        return text

    govern.register_udf(t.spark, "expand_abbreviations", expand)
    titled = F.concat(F.when(F.col("role") == "user", "Mr. ").otherwise("Dr. "), "text")
    return t.conversations.select("conv_id", "turn", titled.alias("t")).selectExpr(
        "conv_id", "turn", "expand_abbreviations(t) AS expanded")


@query("phys_repartition", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def _(t):
    lines = t.lineitem.select("l_suppkey")
    spread = layout.repartition(lines, layout.partitions_for(lines))
    return layout.repartition(spread, None, "l_suppkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("phys_coalesce", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    sellers = t.supplier.select("s_suppkey", "s_name")
    return layout.coalesce(sellers, layout.partitions_for(sellers))


@query("phys_stats", "SELECT count(*) AS n, max(c_custkey) AS top_key FROM customer")
def _(t):
    name = t.table_name("customer_stats")
    t.customer.write.option("path", t.scratch("stats")).saveAsTable(name)
    layout.analyze(t.spark, name, ["c_custkey", "c_mktsegment"])
    return t.spark.table(name).agg(F.count("*").alias("n"), F.max("c_custkey").alias("top_key"))
