"""Aggregations, pivot and unpivot."""

from pyspark.sql import functions as F

from ..operators import aggregate as agg
from .base import FACT_SQL, as_double, money, query, sales_fact

AMOUNT = "sum(CAST(l_extendedprice AS DECIMAL(18,2)))"


@query("agg_group_basic", f"""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST({AMOUNT} AS DOUBLE) AS amount,
 avg(l_quantity) AS avg_qty FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _(t):
    return agg.summarize(t.lineitem, ["l_returnflag", "l_linestatus"], n=F.count("*"),
                         amount=as_double(F.sum(money("l_extendedprice"))), avg_qty=F.avg("l_quantity"))


@query("agg_dict", """SELECT l_suppkey, sum(l_quantity) AS quantity, max(l_tax) AS top_tax FROM lineitem GROUP BY l_suppkey""")
def _(t):
    return agg.summarize_dict(t.lineitem, ["l_suppkey"], {"l_quantity": "sum", "l_tax": "max"},
                              {"sum(l_quantity)": "quantity", "max(l_tax)": "top_tax"})


@query("agg_by_expr", """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
 count(*) AS n FROM orders GROUP BY ALL""")
def _(t):
    return agg.summarize(t.orders, [F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")], n=F.count("*"))


@query("agg_count_distinct", """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(*) AS n,
 sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag""")
def _(t):
    return agg.summarize(t.lineitem, ["l_returnflag"], parts=F.count_distinct("l_partkey"), n=F.count("*"),
                         quantity=F.sum("l_quantity"))


@query("agg_count_nonnull", """SELECT l_suppkey, count(nullif(l_tax, 0)) AS taxed, count(*) AS n FROM lineitem GROUP BY l_suppkey""")
def _(t):
    return agg.summarize(t.lineitem, ["l_suppkey"], taxed=F.count(F.nullif("l_tax", F.lit(0.0))), n=F.count("*"))


@query("agg_ratio", f"""SELECT region, CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(sum(quantity) AS DOUBLE), 0) AS avg_value,
 count(*) AS n FROM {FACT_SQL} GROUP BY region""")
def _(t):
    return agg.ratio_of_sums(sales_fact(t), ["region"], "total_amount", "quantity", "avg_value", n=F.count("*"))


@query("agg_global", f"""SELECT max(l_shipdate) AS last_date, count(*) AS n, CAST({AMOUNT} AS DOUBLE) AS amount FROM lineitem""")
def _(t):
    return agg.summarize(t.lineitem, [], last_date=F.max("l_shipdate"), n=F.count("*"),
                         amount=as_double(F.sum(money("l_extendedprice"))))


@query("agg_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def _(t):
    return agg.summarize(t.orders, ["o_custkey"], n=F.count("*")).filter("n > 12")


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return agg.distinct_rows(t.lineitem, "l_partkey", "l_suppkey")


@query("agg_string", """SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey""")
def _(t):
    return agg.concat_group(t.lineitem, ["l_orderkey"], "l_returnflag", "l_returnflag", ", ", "flags")


@query("agg_string_distinct", """SELECT p_brand, string_agg(p_type, ', ' ORDER BY p_type) AS types
 FROM (SELECT DISTINCT p_brand, p_type FROM part) GROUP BY p_brand""")
def _(t):
    return agg.concat_group(t.part, ["p_brand"], "p_type", "p_type", ", ", "types", distinct=True)


@query("agg_string_xml", """SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS lines
 FROM lineitem GROUP BY l_orderkey""")
def _(t):
    return agg.concat_group(t.lineitem, ["l_orderkey"], "l_linenumber", "l_linenumber", ",", "lines")


@query("agg_sum_strings", """SELECT l_returnflag, CAST(sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18,2))) AS DOUBLE) AS amount
 FROM lineitem GROUP BY l_returnflag""")
def _(t):
    text = t.lineitem.select("l_returnflag", F.col("l_extendedprice").cast("string").alias("price"))
    return agg.summarize(text, ["l_returnflag"], amount=as_double(F.sum(F.col("price").try_cast("decimal(18,2)"))))


@query("agg_flag_distinct", """SELECT o_custkey, count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN 'PK' END) AS flag
 FROM orders GROUP BY o_custkey""")
def _(t):
    return agg.flag_any(t.orders, ["o_custkey"], F.col("o_orderpriority") == "1-URGENT")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _pivoted(t):
    return agg.pivot(t.customer, ["c_nationkey"], "c_mktsegment", SEGMENTS, F.sum(money("c_acctbal")))


@query("pivot", "SELECT c_nationkey, " + ", ".join(
    f"CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) FILTER (c_mktsegment = '{s}') AS DOUBLE) AS \"{s}\"" for s in SEGMENTS)
    + " FROM customer GROUP BY c_nationkey")
def _(t):
    return _pivoted(t).select("c_nationkey", *[as_double(s).alias(s) for s in SEGMENTS])


@query("unpivot", """SELECT c_nationkey, c_mktsegment AS department, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS salary
 FROM customer GROUP BY c_nationkey, c_mktsegment""")
def _(t):
    out = agg.unpivot(_pivoted(t), ["c_nationkey"], SEGMENTS, "department", "salary")
    return out.withColumn("salary", as_double("salary"))
