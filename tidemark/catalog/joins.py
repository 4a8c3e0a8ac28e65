"""Join operators."""

from pyspark.sql import functions as F

from ..operators import joins
from ..operators.upsert import stamp_audit_cols, with_hash
from .base import as_double, money, query


@query("join_inner", """SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    out = joins.inner(t.orders, t.customer, {"o_custkey": "c_custkey"})
    return out.select("o_orderkey", "o_totalprice", "c_name")


@query("join_star_chain", """SELECT l_orderkey, l_linenumber, l_extendedprice, p_brand, s_name, n_name FROM lineitem
 JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    out = joins.star(t.lineitem, [(t.part, {"l_partkey": "p_partkey"}), (t.supplier, {"l_suppkey": "s_suppkey"}),
                                  (t.nation, {"s_nationkey": "n_nationkey"})])
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice", "p_brand", "s_name", "n_name")


@query("join_left_lookup", """SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id)""")
def _(t):
    return joins.lookup(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"], ["quality"])


@query("join_broadcast", """SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    nations = joins.lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    out = joins.lookup(t.customer, nations, {"c_nationkey": "n_nationkey"}, ["n_name", "r_name"])
    return out.select("c_custkey", "n_name", "r_name")


@query("join_cross", """SELECT c_custkey, r_name AS to_region,
 CAST(CAST(c_acctbal AS DECIMAL(18,2)) * (r_regionkey + 1) AS DOUBLE) AS amount FROM customer CROSS JOIN region""")
def _(t):
    # Balances in one currency meet the rates from that currency: an equi-join on it.
    rates = t.region.select(F.lit("USD").alias("from_ccy"), "r_name", (F.col("r_regionkey") + 1).alias("rate"))
    balances = t.customer.select("c_custkey", money("c_acctbal").alias("amount"), F.lit("USD").alias("ccy"))
    pairs = joins.inner(balances, rates, {"ccy": "from_ccy"})
    return pairs.select("c_custkey", F.col("r_name").alias("to_region"),
                        as_double(F.col("amount") * F.col("rate")).alias("amount"))


@query("join_anti_isnull", """SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders
 WHERE o_totalprice > 450000) ON o_custkey = c_custkey WHERE o_custkey IS NULL""")
def _(t):
    big = t.orders.filter("o_totalprice > 450000")
    return joins.anti(t.customer, big, {"c_custkey": "o_custkey"}).select("c_custkey", "c_name")


@query("join_not_exists", """SELECT doc_id, source FROM documents d
 WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def _(t):
    return joins.anti(t.documents, t.labels, ["doc_id"]).select("doc_id", "source")


@query("join_semi_exists", """SELECT p_partkey, p_name FROM part
 WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 49)
 AND EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    rows = joins.semi(t.part, t.lineitem.filter("l_quantity >= 49"), {"p_partkey": "l_partkey"})
    gate = joins.exists_any(t.lineitem, F.col("l_returnflag") == "R")
    return rows.filter(F.lit(gate)).select("p_partkey", "p_name")


@query("join_hash_diff", """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0
 AND c_mktsegment <> 'BUILDING'""")
def _(t):
    # The stored copy lacks one segment and has negative balances as zero.
    old = t.customer.filter("c_mktsegment <> 'BUILDING'").withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0)))
    target = stamp_audit_cols(old, 1, "2025-01-01 00:00:00")
    return joins.changed(with_hash(t.customer), target, ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal")


def _regions_with_gap(t):
    return t.region.select("r_regionkey", F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("code"))


@query("join_text_key_nullable", """SELECT c_custkey, r_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    # The same region is '' on one side and NULL on the other.
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    left = t.customer.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("r_name") != "ASIA", F.col("r_name")).otherwise("").alias("code"))
    # The second key is a number with NULLs on both sides; it matches as it is.
    number = F.when(F.col("code") != "EUROPE", F.length("code"))
    right = _regions_with_gap(t).withColumn("size", F.when(F.coalesce("code", F.lit("")) != "EUROPE", F.length(F.coalesce("code", F.lit("")))))
    return joins.inner(left.withColumn("size", number), right, ["code", "size"], blank_null=True).select("c_custkey", "r_regionkey")


@query("join_null_safe", """SELECT c_custkey, r_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    left = t.customer.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("code"))
    return joins.inner(left, _regions_with_gap(t), ["code"], null_safe=True).select("c_custkey", "r_regionkey")


@query("join_update_from", """SELECT o_orderkey, o_custkey, CASE WHEN c_custkey IS NULL THEN o_orderpriority
 WHEN c_acctbal < -500 THEN NULL ELSE c_mktsegment END AS o_orderpriority FROM orders
 LEFT JOIN (SELECT * FROM customer WHERE c_acctbal < 0) ON o_custkey = c_custkey""")
def _(t):
    src = t.customer.filter("c_acctbal < 0").withColumn("tag", F.when(F.col("c_acctbal") >= -500, F.col("c_mktsegment")))
    target = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return joins.update_from(target, src, {"o_custkey": "c_custkey"}, {"o_orderpriority": "tag"})


@query("join_update_repeated", """SELECT c_custkey, coalesce(last_status, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN
 (SELECT o_custkey, arg_max(o_orderstatus, ROW(o_orderdate, o_orderkey)) AS last_status FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def _(t):
    # Customers have many orders: the last one counts, and no customer is doubled.
    return joins.update_from(t.customer.select("c_custkey", "c_mktsegment"), t.orders, {"c_custkey": "o_custkey"},
                             {"c_mktsegment": "o_orderstatus"}, order=["o_orderdate", "o_orderkey"])


@query("join_lateral_json", """SELECT event_id, event_type AS name, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
 FROM events UNION ALL SELECT event_id, 'user', CAST(user_id AS INTEGER) FROM events""")
def _(t):
    items = F.to_json(F.array(
        F.struct(F.col("event_type").alias("name"), F.get_json_object("props", "$.k").cast("int").alias("k")),
        F.struct(F.lit("user").alias("name"), F.col("user_id").cast("int").alias("k"))))
    rows = t.events.select("event_id", items.alias("doc"))
    out = joins.lateral_json(rows, "doc", "array<struct<name: string, k: int>>")
    return out.select("event_id", "name", "k")
