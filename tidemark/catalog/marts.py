"""Sales marts over the benchmark tables."""

from pyspark.sql import functions as F

from ..operators.layout import cached
from ..plans import marts
from ..sources import readers, writers
from ..session import settle
from .base import FACT_SQL, PRODUCTS_SQL, as_double, money, products, query, sales_fact

SINCE = "1997-01-01"


def _category_sql(k, cols):
    return f"""WITH g AS (SELECT region, strftime(order_date, '%Y-%m') AS month_bucket, category, sum(total_amount) AS amount,
 CAST(sum(quantity) AS BIGINT) AS units, count(DISTINCT customer_id) AS customers FROM {FACT_SQL} JOIN {PRODUCTS_SQL} USING (product_id)
 WHERE order_date >= TIMESTAMP '{SINCE}' GROUP BY ALL)
 SELECT region, month_bucket, category, {cols} FROM (SELECT *, rank() OVER (PARTITION BY region, month_bucket ORDER BY amount DESC)
 AS r FROM g) WHERE r <= {k}"""


TOP3_SQL = _category_sql(3, "CAST(amount AS DOUBLE) AS revenue, units AS total_quantity, customers AS customer_count, r AS sales_rank")


def category_month_top3(t):
    return marts.category_month_top(sales_fact(t), products(t), SINCE, 3).withColumn("revenue", as_double("revenue"))


query("mart_category_month_top3", TOP3_SQL)(category_month_top3)


@query("mart_category_month_top3_late", TOP3_SQL)
def _(t):
    return marts.category_month_top_late(sales_fact(t), products(t), SINCE, 3).withColumn("revenue", as_double("revenue"))


@query("mart_category_month_top2", _category_sql(2, """CAST(amount AS DOUBLE) AS total_sales, units AS total_units,
 customers AS customer_count, r AS sales_rank, CAST(amount AS DOUBLE) / nullif(CAST(units AS DOUBLE), 0) AS avg_order_value"""))
def _(t):
    out = marts.category_month_top(sales_fact(t), products(t), SINCE, 2, ratio=True)
    return out.withColumn("total_sales", as_double("total_sales"))


@query("mart_product_month_top3", f"""WITH g AS (SELECT region, strftime(order_date, '%Y-%m') AS month_bucket, product_id, product_name, category,
 CAST(sum(quantity) AS BIGINT) AS total_units_sold, sum(total_amount) AS amount FROM {FACT_SQL} JOIN {PRODUCTS_SQL} USING (product_id)
 WHERE order_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31' GROUP BY ALL)
 SELECT * EXCLUDE (amount, r), CAST(amount AS DOUBLE) AS revenue, r AS sales_rank FROM (SELECT *, rank() OVER
 (PARTITION BY region, month_bucket ORDER BY amount DESC) AS r FROM g) WHERE r <= 3""")
def _(t):
    out = marts.product_month_top(sales_fact(t), products(t), "1998-01-01", "1998-12-31", 3)
    return out.withColumn("revenue", as_double("revenue"))


REGION_PRODUCT_SQL = f"""SELECT region, product_id, count(order_id) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_sales
 FROM {FACT_SQL} WHERE region IN ('ASIA', 'EUROPE', 'AFRICA') AND order_date BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
 GROUP BY region, product_id HAVING count(order_id) > 1"""


@query("mart_region_product_having_flat", REGION_PRODUCT_SQL)
def _(t):
    out = marts.region_product(sales_fact(t), "1998-01-01", "1998-12-31", 1, ["ASIA", "EUROPE", "AFRICA"])
    return out.withColumn("total_sales", as_double("total_sales"))


@query("mart_region_product_having", REGION_PRODUCT_SQL)
def _(t):
    path = t.scratch("by_region")
    # Only the asked-for regions and year are written; reading one folder for each region is what the layout shows.
    wanted = sales_fact(t).filter(F.col("region").isin("ASIA", "EUROPE", "AFRICA") & F.col("order_date").between(
        F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz")))
    writers.write_parquet(wanted, path, ["region"])
    stored = readers.read_parquet(t.spark, path)
    out = marts.region_product(stored, "1998-01-01", "1998-12-31", 1, ["ASIA", "EUROPE", "AFRICA"])
    return out.withColumn("total_sales", as_double("total_sales"))


@query("mart_customer_sales", f"""SELECT customer_id, CAST(sum(total_amount) AS DOUBLE) AS total_spent, count(total_amount) AS sale_count
 FROM {FACT_SQL} GROUP BY customer_id""")
def _(t):
    return marts.customer_sales(sales_fact(t)).withColumn("total_spent", as_double("total_spent"))


@query("mart_name_spend", """SELECT c_name AS name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name""")
def _(t):
    spend = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("name"), money("o_totalprice").alias("spentamount"))
    out = marts.name_spend(spend).withColumn("total_spent", as_double("total_spent"))
    return writers.ctas(out, t.table_name("name_spend"), t.scratch("ctas"))


def _territories(t):
    """Nation as territory, orders as headers, lines as details, discounts as offers."""
    territory = t.nation.select(F.col("n_nationkey").alias("TerritoryID"), F.col("n_name").alias("Name"))
    header = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("SalesOrderID"), F.col("c_nationkey").alias("TerritoryID"))
    offer_id = F.round(F.col("l_discount") * 100).cast("int")
    detail = t.lineitem.select(F.col("l_orderkey").alias("SalesOrderID"), offer_id.alias("SpecialOfferID"),
                               F.col("l_quantity").cast("bigint").alias("OrderQty"), money("l_extendedprice").alias("LineTotal"))
    offer = t.lineitem.select(offer_id.alias("SpecialOfferID"), F.col("l_discount").alias("DiscountPct")).distinct()
    return territory, header, detail, offer


TERRITORY_SQL = """SELECT n_nationkey AS "TerritoryID", n_name AS "Name"{cols}, CAST(sum(l_quantity) AS BIGINT) AS "No_of_orders_by_Region",
 CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "Totalsales_Amt" FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""
OFFER_COLS = ', CAST(round(l_discount * 100) AS INTEGER) AS "SpecialOfferID", l_discount AS "DiscountPct"'


@query("mart_territory_sales", TERRITORY_SQL.format(cols=""))
def _(t):
    territory, header, detail, _ = _territories(t)
    return marts.territory_sales(territory, header, detail).withColumn("Totalsales_Amt", as_double("Totalsales_Amt"))


@query("mart_territory_offer", TERRITORY_SQL.format(cols=OFFER_COLS))
def _(t):
    out = marts.territory_offer(*_territories(t), descending=True)
    return out.withColumn("Totalsales_Amt", as_double("Totalsales_Amt"))


@query("mart_customer_month_avg", """SELECT o_custkey AS "CustomerID", CAST(year(o_orderdate) AS INTEGER) AS yearofpurchase,
 CAST(month(o_orderdate) AS INTEGER) AS monthofpurchase,
 round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS "Avgpurchase" FROM orders GROUP BY ALL""")
def _(t):
    header = t.orders.select(F.col("o_custkey").alias("CustomerID"), F.col("o_orderdate").alias("OrderDate"),
                             money("o_totalprice").alias("TotalDue"))
    return marts.customer_month_avg(header).withColumn("Avgpurchase", F.round(as_double("Avgpurchase"), 4))


@query("mart_employee_ranks", """SELECT c_custkey AS id, c_mktsegment AS department, c_acctbal AS salary,
 row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS row_num,
 rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS rank,
 dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS dense_rank,
 ntile(2) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS ntile_2 FROM customer""")
def _(t):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("department"),
                               F.col("c_acctbal").alias("salary"))
    return marts.employee_ranks(people, split=t.split or True)


@query("phys_cache", f"""SELECT 'total' AS kind, CAST(sum(total_amount) AS DOUBLE) AS amount FROM {FACT_SQL} UNION ALL
 SELECT 'best', CAST(max(s) AS DOUBLE) FROM (SELECT sum(total_amount) AS s FROM {FACT_SQL} GROUP BY customer_id)""")
def _(t):
    with cached(marts.customer_sales(sales_fact(t))) as spent:
        total = spent.agg(F.lit("total").alias("kind"), as_double(F.sum("total_spent")).alias("amount"))
        best = spent.agg(F.lit("best").alias("kind"), as_double(F.max("total_spent")).alias("amount"))
        return settle(total.unionByName(best), "totals")
