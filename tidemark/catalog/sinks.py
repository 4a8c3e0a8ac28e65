"""Sinks and table mutations: write whole tables, return what is read back."""

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import mutate
from ..operators.layout import distribute
from ..operators.upsert import stamp_audit_cols
from ..plans import marts
from ..plans.clean import clean_generic
from ..sources import paths, readers, writers
from .base import FACT_SQL, as_double, money, query, sales_fact

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"
BOUNDS = ["1996-01-01", "1997-01-01", "1998-01-01", "1999-01-01"]
BATCH, NOW = 7, "2025-01-15 08:00:00"


@query("sink_csv", PART_SQL)
def _(t):
    path = t.scratch("csv")
    writers.write_csv(t.part, path)
    return readers.read_delimited(t.spark, path, t.part.schema)


@query("sink_text_quoted", "SELECT conv_id, turn, role, text FROM conversations")
def _(t):
    # Texts hold quotes and line breaks, which the quoted form must keep.
    path = t.scratch("quoted")
    writers.write_delimited(t.conversations, path)
    return t.spark.read.schema(t.conversations.schema).csv(path, header=True, escape="\\", multiLine=True)


@query("sink_parquet", ORDERS_SQL)
def _(t):
    path = t.scratch("parquet")
    writers.write_parquet(t.orders, path)
    return readers.read_parquet(t.spark, path)


@query("sink_append", """SELECT o_orderkey, o_orderstatus,
 CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS batch_id FROM orders""")
def _(t):
    path = t.scratch("append")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    # The last batch arrives twice and must count once.
    for batch, status in ((1, "F"), (2, "O"), (3, "P"), (3, "P")):
        writers.append(rows.filter(F.col("o_orderstatus") == status), path, batch)
    return readers.read_parquet(t.spark, path)


@query("sink_ctas", """SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
 FROM orders GROUP BY o_custkey""")
def _(t):
    spent = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), as_double(F.sum(money("o_totalprice"))).alias("spent"))
    return writers.ctas(spent, t.table_name("spent"), t.scratch("ctas"))


@query("sink_bucketed", """SELECT o_custkey, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
 GROUP BY o_custkey, c_mktsegment""")
def _(t):
    # Orders are summed to their customer first, so no bucket holds a hot customer's orders.
    # Both sides lie in the same buckets: the join needs no shuffle.
    per_customer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    buyers = t.customer.select("c_custkey", "c_mktsegment")
    n = writers.buckets_for(buyers)
    o = writers.write_bucketed(per_customer, t.table_name("orders_b"), n, "o_custkey", "o_custkey", t.scratch("bucketed"))
    c = writers.write_bucketed(buyers, t.table_name("customer_b"), n, "c_custkey", "c_custkey", t.scratch("bucketed"))
    return o.join(c, o.o_custkey == c.c_custkey).select("o_custkey", "c_mktsegment", "n")


@query("sink_range_partitioned", """SELECT CAST((o_orderdate >= TIMESTAMP '1996-01-01') AS INTEGER)
 + CAST((o_orderdate >= TIMESTAMP '1997-01-01') AS INTEGER) + CAST((o_orderdate >= TIMESTAMP '1998-01-01') AS INTEGER)
 + CAST((o_orderdate >= TIMESTAMP '1999-01-01') AS INTEGER) AS range_id, count(*) AS n, min(o_orderdate) AS first_date,
 max(o_orderdate) AS last_date FROM orders GROUP BY range_id""")
def _(t):
    path = t.scratch("ranges")
    writers.write_range_partitioned(t.orders, path, F.to_date("o_orderdate"), BOUNDS)
    rows = readers.read_parquet(t.spark, path)
    return rows.groupBy("range_id").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_date"),
                                        F.max("o_orderdate").alias("last_date"))


@query("sink_distributed", """SELECT l_orderkey, l_quantity, p_type, n_name FROM lineitem JOIN part ON l_partkey = p_partkey
 JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def _(t):
    # Both sides of the large join lie by its key, the small table goes to every task, the result is spread evenly.
    lines = distribute(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"), "hash", "l_partkey")
    parts = distribute(t.part.select("p_partkey", "p_type"), "hash", "p_partkey")
    nations = distribute(t.nation.select("n_nationkey", "n_name"), "replicate")
    sellers = distribute(t.supplier, "round_robin").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select("l_orderkey", "l_quantity", "p_type", "n_name")


@query("sink_run_path", """SELECT upper(p_name) AS "Name", upper(p_name) || substring(upper(p_brand), 3) AS "ProductNumber",
 format('{:,.2f}', CAST(p_retailprice AS DOUBLE)) AS "ListPrice", substring(upper(p_name), 1, 3) AS "New_Region_Name" FROM part""")
def _(t):
    base = t.scratch("lake")
    bronze = f"{base}/BRONZE/Production/Product/2024-02-21T11-03-01.375/Product.csv"
    raw = t.part.select(F.col("p_name").alias("Name"), F.col("p_brand").alias("ProductNumber"),
                        F.col("p_retailprice").alias("ListPrice"))
    writers.write_csv(raw, bronze)
    silver = paths.run_path(bronze, "Silver", datetime(2024, 3, 1, 12, 13, 19, 730000))
    writers.write_csv(clean_generic(readers.read_csv(t.spark, bronze, infer=True)), silver)
    return readers.read_csv(t.spark, silver)


@query("sink_date_path", r"""SELECT o_orderkey,
 replace(replace(replace(o_orderpriority || '\YYYY\MM\DD\', 'YYYY', strftime(o_orderdate, '%Y')), '\MM\',
 '\' || strftime(o_orderdate, '%m') || '\'), '\DD\', '\' || strftime(o_orderdate, '%d') || '\') AS folder,
 'orders_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') || '.parquet' AS file_name FROM orders""")
def _(t):
    folder = F.concat("o_orderpriority", F.lit("\\YYYY\\MM\\DD\\"))
    filled, name = paths.expand_template_cols(folder, F.lit("orders_*.parquet"), F.col("o_orderdate"))
    return t.orders.select("o_orderkey", filled.alias("folder"), name.alias("file_name"))


@query("sink_insert_select", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""")
def _(t):
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.to_date("o_orderdate").alias("order_day"),
                                                         money("o_totalprice").alias("amount"))
    rest = t.orders.filter("o_orderstatus <> 'F'").select(F.col("o_totalprice").alias("amount"), "o_orderkey",
                                                          F.col("o_orderdate").alias("order_day"))
    return mutate.insert_into(done, rest).withColumn("amount", as_double("amount"))


@query("mut_update_where", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS o_totalprice FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return mutate.update_where(rows, F.col("o_orderstatus") == "P", {"o_orderstatus": "X", "o_totalprice": 0})


@query("mut_delete_where", """SELECT o_orderkey, o_orderstatus FROM orders
 WHERE NOT coalesce(nullif(o_orderstatus, 'O') = 'F', FALSE)""")
def _(t):
    # The predicate is NULL for open orders, and those stay.
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return mutate.delete_where(rows, F.nullif(F.col("o_orderstatus"), F.lit("O")) == "F")


@query("mut_delete_join", """SELECT o_orderkey, o_custkey FROM orders
 WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal < 0)""")
def _(t):
    return mutate.delete_matching(t.orders.select("o_orderkey", "o_custkey"), t.customer.filter("c_acctbal < 0"),
                                  {"o_custkey": "c_custkey"})


@query("mut_truncate", """SELECT count(*) AS n_after, (SELECT count(*) FROM orders) AS n_before FROM orders WHERE 1 = 0""")
def _(t):
    path = t.scratch("truncate")
    writers.write_parquet(mutate.truncate(t.orders), path)
    emptied = readers.read_parquet(t.spark, path)
    return emptied.agg(F.count("*").alias("n_after")).withColumn("n_before", t.orders.agg(F.count("*")).scalar())


@query("mut_create_if_absent", """SELECT p_partkey, p_name, p_brand, CAST(7 AS BIGINT) AS "ETLCreatedBatchID",
 FALSE AS "IsDeleted" FROM part""")
def _(t):
    rows = t.part.select("p_partkey", "p_name", "p_brand")
    name, path = t.table_name("part_target"), t.scratch("target")
    for _ in range(2):  # the second call finds the table
        table = writers.ensure_table(t.spark, name, rows.schema, path, keys=["p_partkey"])
    stamp_audit_cols(rows, BATCH, NOW).select(*table.columns).write.mode("append").parquet(path)
    t.spark.catalog.refreshTable(name)
    return t.spark.table(name).select("p_partkey", "p_name", "p_brand", "ETLCreatedBatchID", "IsDeleted")


@query("sink_copy_table", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def _(t):
    path = t.scratch("copy")
    rows = readers.sql_on_path(t.spark, t.path("customer"), "SELECT c_custkey, c_name FROM {source} WHERE c_acctbal >= 0")
    writers.copy_table(rows, path)
    return readers.read_parquet(t.spark, path)


@query("sink_materialized_agg", f"""SELECT customer_id, CAST(sum(total_amount) AS DOUBLE) AS total_spent,
 count(total_amount) AS sale_count FROM {FACT_SQL} GROUP BY customer_id""")
def _(t):
    name = t.table_name("customer_sales")
    # The refresh replaces the first version by a whole new one.
    for fact in (sales_fact(t).filter("region = 'ASIA'"), sales_fact(t)):
        out = marts.customer_sales(fact)
        table = writers.materialize(out.withColumn("total_spent", as_double("total_spent")), name, t.scratch("mv"))
    return table
