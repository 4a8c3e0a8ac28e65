"""Sales marts.

``fact`` has order_id, customer_id, product_id, order_date, quantity, total_amount, region;
``products`` has product_id, product_name, category.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import safe_divide
from ..functions.dates import fmt_date
from ..operators.filters import where_half_open
from ..operators.joins import inner
from ..operators.windows import rank_rows, top_k


def _top_by_month(fact, products, grain, aggs, measure, k, since=None, until=None):
    """Filter, join, aggregate by region-month-grain, keep the ``k`` best of each region-month.

    The group columns already hold a dimension's attributes, so nothing is joined back, and the
    ranked input is one row per group.
    """
    rows = fact if since is None else fact.filter(F.col("order_date") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        rows = rows.filter(F.col("order_date") <= F.lit(until).cast("timestamp_ntz"))
    joined = inner(rows.withColumn("__month", F.trunc("order_date", "MM")), products, ["product_id"])
    grouped = joined.groupBy("region", "__month", *grain).agg(*[a.alias(n) for n, a in aggs.items()])
    # The month is a date while grouping and becomes text once per group.
    grouped = grouped.select("region", fmt_date("__month").alias("month_bucket"), *grain, *aggs)
    return top_k(grouped, ["region", "month_bucket"], [f"-{measure}"], k, "sales_rank")


def category_month_top(fact, products, since, k=3, ratio=False) -> DataFrame:
    """Best ``k`` categories of each region and month by revenue; ``ratio`` adds the average order value."""
    if not ratio:
        aggs = {"revenue": F.sum("total_amount"), "total_quantity": F.sum("quantity"),
                "customer_count": F.count_distinct("customer_id")}
        out = _top_by_month(fact, products, ["category"], aggs, "revenue", k, since)
        return out.orderBy("region", "month_bucket", F.desc("revenue"))
    aggs = {"customer_count": F.count_distinct("customer_id"), "total_units": F.sum("quantity"),
            "total_sales": F.sum("total_amount")}
    out = _top_by_month(fact, products, ["category"], aggs, "total_sales", k, since)
    out = out.withColumn("avg_order_value", safe_divide(F.col("total_sales").cast("double"), F.col("total_units").cast("double")))
    return out.orderBy("region", "month_bucket", F.desc("total_sales"))


def category_month_top_late(fact, products, since, k=3) -> DataFrame:
    """The same mart written filter-last; the optimizer moves the filter below the join."""
    joined = inner(fact, products, ["product_id"]).withColumn("month_bucket", fmt_date("order_date"))
    kept = joined.filter(F.col("order_date") >= F.lit(since).cast("timestamp_ntz"))
    grouped = kept.groupBy("region", "month_bucket", "category").agg(
        F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("total_quantity"),
        F.count_distinct("customer_id").alias("customer_count"))
    return top_k(grouped, ["region", "month_bucket"], ["-revenue"], k, "sales_rank")


def product_month_top(fact, products, low, high, k=3) -> DataFrame:
    """Best ``k`` products of each region and month inside ``[low, high]``."""
    aggs = {"total_units_sold": F.sum("quantity"), "revenue": F.sum("total_amount")}
    out = _top_by_month(fact, products, ["product_id", "product_name", "category"], aggs, "revenue", k, low, high)
    return out.orderBy("region", "month_bucket", F.desc("revenue"))


def region_product(fact, low, high, min_n, regions=None) -> DataFrame:
    """Orders and sales per region and product inside ``[low, high]``, more than ``min_n`` orders.

    On a table partitioned by region the membership test prunes folders.
    """
    rows = fact.filter(F.col("order_date").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")))
    if regions:
        rows = rows.filter(F.col("region").isin(list(regions)))
    grouped = rows.groupBy("region", "product_id").agg(F.count("order_id").alias("total_orders"),
                                                       F.sum("total_amount").alias("total_sales"))
    return grouped.filter(F.col("total_orders") > min_n)


def customer_sales(fact) -> DataFrame:
    return fact.groupBy("customer_id").agg(F.sum("total_amount").alias("total_spent"),
                                           F.count("total_amount").alias("sale_count"))


def name_spend(spend) -> DataFrame:
    return spend.groupBy("name").agg(F.sum("spentamount").alias("total_spent"))


def territory_sales(territory, header, detail) -> DataFrame:
    """Orders and amount per territory."""
    return territory_offer(territory, header, detail)


def territory_offer(territory, header, detail, offer=None, descending=False) -> DataFrame:
    """Orders and amount per territory, and per special offer and discount when offers are given.

    Detail rows are first summed to their order (and offer), so the join to the header moves
    one row per order instead of every line.
    """
    by = ["SalesOrderID"] + (["SpecialOfferID"] if offer is not None else [])
    per_order = detail.groupBy(*by).agg(F.sum("OrderQty").alias("__qty"), F.sum("LineTotal").alias("__amount"))
    rows = inner(inner(per_order, header.select("SalesOrderID", "TerritoryID"), ["SalesOrderID"]),
                 territory.select("TerritoryID", "Name"), ["TerritoryID"])
    keys = ["TerritoryID", "Name"]
    if offer is not None:
        rows = inner(rows, offer.select("SpecialOfferID", "DiscountPct"), ["SpecialOfferID"])
        keys += ["SpecialOfferID", "DiscountPct"]
    out = rows.groupBy(*keys).agg(F.sum("__qty").alias("No_of_orders_by_Region"), F.sum("__amount").alias("Totalsales_Amt"))
    return out.orderBy(F.desc("TerritoryID") if descending else F.asc("TerritoryID"))


def customer_month_avg(header) -> DataFrame:
    """Average purchase per customer, year and month."""
    out = header.groupBy("CustomerID", F.year("OrderDate").alias("yearofpurchase"),
                         F.month("OrderDate").alias("monthofpurchase")).agg(F.avg("TotalDue").alias("Avgpurchase"))
    return out.orderBy("Avgpurchase", F.desc("yearofpurchase"), F.asc("monthofpurchase"))


def employee_ranks(employees, tiles=2, **options) -> DataFrame:
    """Four rankings of salaries inside departments; ``id`` breaks ties of row_num and ntile."""
    return rank_rows(employees, ["department"], ["-salary"], ["id"], tiles=tiles, row_num="row_number", rank="rank",
                     dense_rank="dense_rank", ntile_2="ntile", **options)
