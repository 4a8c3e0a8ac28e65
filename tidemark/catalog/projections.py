"""Projections, filters and conditional expressions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as X
from ..operators import filters, project
from ..operators.aggregate import summarize
from ..operators.windows import top_k
from ..sources.writers import write_parquet
from .base import FACT_SQL, as_double, query, sales_fact


@query("proj_select", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus FROM orders")
def _(t):
    return project.select_cols(t.orders, "o_orderstatus", order_id="o_orderkey", customer_id="o_custkey")


@query("proj_star_plus", "SELECT *, p_size * 2 AS double_size, upper(p_type) AS type_name FROM part")
def _(t):
    return project.with_exprs(t.part, double_size="p_size * 2", type_name=F.upper("p_type"))


@query("proj_rename", "SELECT n_nationkey AS nation_id, n_name AS nation, n_regionkey FROM nation")
def _(t):
    return project.rename(t.nation, {"n_nationkey": "nation_id", "n_name": "nation"})


@query("proj_rename_all", "SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS total_price FROM orders")
def _(t):
    messy = t.orders.select(F.col("o_orderkey").alias(" Order Key"), F.col("o_custkey").alias("Customer Key "),
                            F.col("o_totalprice").alias("TOTAL PRICE"))
    return project.standardize_names(messy)


@query("proj_todf", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def _(t):
    return project.rename_positional(t.customer, ["id", "name", "nation", "balance", "segment"])


@query("proj_drop", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def _(t):
    return project.drop_cols(t.lineitem, "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("proj_literal", "SELECT c_custkey, 'USA' AS country FROM customer")
def _(t):
    return project.with_literal(t.customer.select("c_custkey"), "country", "USA")


@query("proj_arith", """SELECT c_custkey, c_acctbal * 100 AS cents, c_acctbal * -1 AS negated,
 c_acctbal * c_nationkey AS weighted FROM customer""")
def _(t):
    out = project.with_exprs(t.customer, cents=F.col("c_acctbal") * 100, negated=F.col("c_acctbal") * -1,
                             weighted=F.col("c_acctbal") * F.col("c_nationkey"))
    return out.select("c_custkey", "cents", "negated", "weighted")


@query("proj_cast", """SELECT o_orderkey, TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS level,
 TRY_CAST(o_orderstatus AS INTEGER) AS status, CAST(o_orderdate AS DATE) AS day,
 CAST(o_custkey AS VARCHAR) AS customer FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("level"),
                           F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("day"),
                           F.col("o_custkey").alias("customer"))
    return project.cast_cols(rows, {"level": "int", "status": "int", "day": "date", "customer": "string"})


@query("proj_cast_struct", "SELECT c_custkey, c_name AS full_name, c_mktsegment AS department FROM customer")
def _(t):
    nested = t.customer.select("c_custkey", F.struct("c_name", "c_mktsegment").alias("info"))
    return project.cast_struct(nested, "info", "struct<full_name: string, department: string>").select("c_custkey", "info.*")


@query("proj_struct_field", "SELECT c_custkey, c_name AS customer, c_acctbal AS balance FROM customer")
def _(t):
    nested = t.customer.select("c_custkey", F.struct("c_name", "c_acctbal").alias("info"))
    return project.flatten(nested, "info", {"c_name": "customer", "c_acctbal": "balance"})


@query("proj_by_type", """SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type,
 p_size, p_retailprice FROM part""")
def _(t):
    return project.apply_by_type(t.part, T.StringType, F.upper)


@query("filt_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000")
def _(t):
    return filters.where(t.orders, "o_totalprice > 250000").select("o_orderkey", "o_totalprice")


@query("filt_between", """SELECT l_orderkey, l_shipdate FROM lineitem
 WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'""")
def _(t):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-03-31"))
    return filters.where_between(t.lineitem, "l_shipdate", low, high).select("l_orderkey", "l_shipdate")


@query("filt_half_open", """SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-03-01' GROUP BY ym""")
def _(t):
    path = t.scratch("months")
    write_parquet(t.orders.withColumn("ym", X.fmt_date("o_orderdate")), path, ["ym"])
    stored = t.spark.read.schema(t.orders.withColumn("ym", F.lit("")).schema).parquet(path)
    return filters.month_pruned(stored, "o_orderdate", "1997-01-01", "1997-03-01").groupBy("ym").agg(F.count("*").alias("n"))


@query("filt_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(t):
    return filters.where_in(t.customer, "c_mktsegment", ["BUILDING", "MACHINERY"]).select("c_custkey", "c_mktsegment")


@query("filt_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def _(t):
    return filters.where_like(t.part, "p_name", "%ring%").select("p_partkey", "p_name")


@query("filt_rlike", "SELECT doc_id, n_chars FROM documents WHERE regexp_matches(text, '[0-9]{3}-[0-9]{4}')")
def _(t):
    return filters.where_rlike(t.documents, "text", "[0-9]{3}-[0-9]{4}").select("doc_id", "n_chars")


@query("filt_contains", "SELECT doc_id FROM documents WHERE contains(text, 'the')")
def _(t):
    return filters.where_contains(t.documents, "text", "the").select("doc_id")


@query("filt_null", """SELECT 'blank' AS kind, doc_id FROM (SELECT doc_id, CASE lang WHEN 'en' THEN NULL WHEN 'de' THEN '  '
 ELSE lang END AS l FROM documents) WHERE l IS NULL OR trim(l) = '' UNION ALL
 SELECT 'present', doc_id FROM documents WHERE lang NOT IN ('en', 'de')""")
def _(t):
    gaps = F.when(F.col("lang") == "de", "  ").when(F.col("lang") != "en", F.col("lang"))
    rows = t.documents.select("doc_id", gaps.alias("l"))
    blank = filters.where_blank(rows, "l").select(F.lit("blank").alias("kind"), "doc_id")
    return blank.unionByName(filters.where_present(rows, "l").select(F.lit("present").alias("kind"), "doc_id"))


@query("expr_case", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 250000 THEN 'big done'
 ELSE 'done' END WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS state FROM orders""")
def _(t):
    done = X.case([(F.col("o_totalprice") > 250000, "big done")], "done")
    state = X.case([(F.col("o_orderstatus") == "F", done), (F.col("o_orderstatus") == "O", "open")], "other")
    return t.orders.select("o_orderkey", state.alias("state"))


@query("expr_coalesce", """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'F'), nullif(o_orderpriority, '5-LOW'), 'none') AS v
 FROM orders""")
def _(t):
    v = X.first_non_null(F.nullif("o_orderstatus", F.lit("F")), F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("none"))
    return t.orders.select("o_orderkey", v.alias("v"))


@query("expr_nullif", "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_tax, 0) AS per_tax FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", X.safe_divide("l_extendedprice", "l_tax").alias("per_tax"))


@query("expr_fillna_map", """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'Unknown') AS status,
 coalesce(CASE WHEN o_totalprice > 1000 THEN o_totalprice END, 0) AS price FROM orders""")
def _(t):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                           F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice")).alias("price"))
    return project.fill_defaults(rows, {"status": "Unknown", "price": 0, "absent": "x"})


@query("expr_blank_default", """SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN 'Not Provided' ELSE lang END AS lang
 FROM documents""")
def _(t):
    gaps = F.when(F.col("lang") == "de", "  ").when(F.col("lang") != "en", F.col("lang"))
    return t.documents.select("doc_id", X.blank_to(gaps, "Not Provided").alias("lang"))


@query("expr_scalar_subquery", """SELECT event_id, (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events) AS max_ts,
 date_diff('day', CAST(ts AS DATE), CAST((SELECT max(ts) FROM events) AS DATE)) AS age_days FROM events""")
def _(t):
    newest = t.events.agg(F.coalesce(F.max("ts"), F.lit("1900-01-01").cast("timestamp_ntz")).alias("m"))
    out = project.with_scalar(t.events.select("event_id", "ts"), "max_ts", newest)
    return out.select("event_id", "max_ts", X.days_between("max_ts", "ts").alias("age_days"))


@query("cte_chain", f"""WITH recent AS (SELECT * FROM {FACT_SQL} WHERE order_date >= TIMESTAMP '1998-01-01'),
 summed AS (SELECT region, year(order_date) AS y, sum(total_amount) AS amount FROM recent GROUP BY ALL),
 ranked AS (SELECT *, rank() OVER (PARTITION BY y ORDER BY amount DESC) AS r FROM summed)
 SELECT region, CAST(y AS INTEGER) AS y, CAST(amount AS DOUBLE) AS amount FROM ranked WHERE r <= 2""")
def _(t):
    return project.pipe(
        sales_fact(t),
        lambda d: filters.where(d, "order_date >= timestamp_ntz'1998-01-01'"),
        lambda d: summarize(d, ["region", F.year("order_date").alias("y")], amount=F.sum("total_amount")),
        lambda d: top_k(d, ["y"], ["-amount"], 2),
        lambda d: d.select("region", "y", as_double("amount").alias("amount")))

