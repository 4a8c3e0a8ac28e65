"""Rankings, frames, sorting and top-k."""

from pyspark.sql import functions as F

from ..operators import windows as w
from .base import FACT_SQL, as_double, query, sales_fact

BY_SEGMENT = "OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)"
BY_BALANCE = "OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC)"


def _customers(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")


# A few segments or regions hold all rows, so their rankings are split; customers and parts hold few rows each.
@query("win_row_number", f"SELECT c_custkey, c_mktsegment, c_acctbal, row_number() {BY_SEGMENT} AS row_num FROM customer")
def _(t):
    return w.rank_rows(_customers(t), ["c_mktsegment"], ["-c_acctbal"], ["c_custkey"], split=t.split or True, row_num="row_number")


@query("win_rank", "SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS r FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return w.rank_rows(rows, ["o_custkey"], ["o_orderpriority"], split=t.split, r="rank").drop("o_orderpriority")


@query("win_dense_rank", """SELECT customer_id, avg_qty, dense_rank() OVER (ORDER BY avg_qty DESC) AS dr FROM
 (SELECT o_custkey AS customer_id, avg(l_quantity) AS avg_qty FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 GROUP BY o_custkey)""")
def _(t):
    sold = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    averages = sold.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.avg("l_quantity").alias("avg_qty"))
    return w.rank_rows(averages, [], ["-avg_qty"], split=t.split or True, dr="dense_rank")


@query("win_ntile", f"SELECT c_custkey, c_mktsegment, c_acctbal, ntile(2) {BY_SEGMENT} AS tile FROM customer")
def _(t):
    return w.rank_rows(_customers(t), ["c_mktsegment"], ["-c_acctbal"], ["c_custkey"], tiles=2, split=t.split or True, tile="ntile")


@query("win_rank_over_agg", f"""SELECT region, product_id, CAST(sum(total_amount) AS DOUBLE) AS revenue,
 rank() OVER (PARTITION BY region ORDER BY sum(total_amount) DESC) AS revenue_rank FROM {FACT_SQL} GROUP BY region, product_id""")
def _(t):
    out = w.rank_groups(sales_fact(t), ["region", "product_id"], F.sum("total_amount"), ["region"], "revenue_rank", "revenue", split=t.split or True)
    return out.withColumn("revenue", as_double("revenue"))


@query("win_moving_avg", """SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
 avg(l_quantity) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice
 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS avg_qty FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return w.moving_avg(rows, ["l_partkey"], order, "l_quantity", 5, "avg_qty", split=t.split).drop("l_quantity")


@query("win_arbitrary_seq", """SELECT count(*) AS n, CAST(1 AS BIGINT) AS first_seq, count(*) AS last_seq,
 count(*) AS n_distinct FROM lineitem""")
def _(t):
    numbered = w.arbitrary_sequence(t.lineitem.select("l_orderkey", "l_linenumber"))
    return numbered.agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
                        F.count_distinct("seq").alias("n_distinct"))


@query("sort_multi", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey")
def _(t):
    return w.sort(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderstatus", "-o_totalprice", "o_orderkey")


@query("limit_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return w.top(t.orders.select("o_orderkey", "o_totalprice"), 10, "-o_totalprice", "o_orderkey")


@query("top1_by_order", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 1")
def _(t):
    return w.latest_row(t.events.select("event_id", "ts"), ["-ts", "event_id"])


@query("topk_per_group", """SELECT o_custkey, o_orderkey, o_totalprice, r AS price_rank FROM (SELECT *, rank() OVER
 (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS r FROM orders) WHERE r <= 3""")
def _(t):
    return w.top_k(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["-o_totalprice"], 3, "price_rank")
