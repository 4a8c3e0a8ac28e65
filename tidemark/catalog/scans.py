"""Sources: each query lands a table in the format under test and reads it back."""

from pyspark.sql import functions as F

from ..operators.aggregate import summarize
from ..operators.incremental import extract
from ..operators.joins import inner
from ..operators.layout import balanced
from ..sources import paths, readers, writers
from . import cleaning
from .base import as_double, json_arrays, query

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query("src_csv_infer", CUSTOMER_SQL)
def _(t):
    path = t.scratch("csv")
    writers.write_csv(t.customer, path)
    return readers.read_csv(t.spark, path, infer=True)


@query("src_csv_strings", """SELECT c_mktsegment, count(*) AS n,
 CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer GROUP BY c_mktsegment""")
def _(t):
    path = t.scratch("csv")
    writers.write_csv(t.customer, path)
    rows = readers.read_csv(t.spark, path)
    total = F.sum(F.col("c_acctbal").try_cast("decimal(18,2)"))
    return summarize(rows, ["c_mktsegment"], n=F.count("*"), balance=as_double(total))


@query("src_delimited_schema", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(t):
    path = t.scratch("delimited")
    t.part.write.csv(path, sep="|", quote="'", header=True, quoteAll=True)
    return readers.read_delimited(t.spark, path, t.part.schema, sep="|", quote="'")


@query("src_error_budget", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'""")
def _(t):
    # Pending orders land with text where the price belongs.
    price = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.col("o_totalprice").cast("string"))
    path = t.scratch("dirty")
    t.orders.select("o_orderkey", "o_orderstatus", price.alias("o_totalprice")).write.csv(path, header=True)
    schema = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").schema
    tolerated = t.orders.filter("o_orderstatus = 'P'").count()
    good, _ = readers.read_with_reject_limit(t.spark, path, schema, max_errors=tolerated)
    return good


@query("src_parquet", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem")
def _(t):
    return readers.read_parquet(t.spark, t.path("lineitem")).select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


@query("src_path_query", """SELECT l_returnflag, l_linestatus, count(*) AS n,
 CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM lineitem GROUP BY ALL""")
def _(t):
    return readers.sql_on_path(t.spark, t.path("lineitem"), """
        SELECT l_returnflag, l_linestatus, count(*) AS n,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM {source} GROUP BY l_returnflag, l_linestatus""")


@query("src_external_table", CUSTOMER_SQL)
def _(t):
    path = t.scratch("external")
    writers.write_parquet(t.customer, path)
    return readers.register_external(t.spark, t.table_name("customer_external"), t.customer.schema, path)


@query("src_json_array", CUSTOMER_SQL)
def _(t):
    path = t.scratch("json")
    json_arrays(t.customer, path, F.floor(F.col("c_custkey") / 50))
    return readers.read_json_array(t.spark, path, t.customer.schema)


@query("src_predicate_extract", """SELECT event_id, ts, user_id, '' AS props FROM events
 WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""")
def _(t):
    return extract(t.events, ("2024-01-10", "2024-01-20"), ["event_id", "ts", "user_id", "props"], ["PROPS"], "ts")


@query("src_recursive_files", """SELECT o_orderstatus AS status, count(*) AS n,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY o_orderstatus""")
def _(t):
    path = t.scratch("tree")
    balanced(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), "o_orderstatus").write.partitionBy("o_orderstatus").csv(path, header=True)
    rows = readers.read_tree(t.spark, path, "*.csv", schema="o_orderkey bigint, o_totalprice double")
    status = F.regexp_extract("file_path", "o_orderstatus=([^/]+)/", 1)
    return summarize(rows, [status.alias("status")], n=F.count("*"),
                     amount=as_double(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))))


@query("src_latest_folder", """SELECT event_id, user_id, event_type, value FROM events
 WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def _(t):
    path = t.scratch("days")
    dated = t.events.select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy").alias("y"),
                            F.date_format("ts", "MM").alias("m"), F.date_format("ts", "dd").alias("d"))
    writers.write_parquet(dated, path, ["y", "m", "d"])
    return readers.read_parquet(t.spark, paths.latest_partition(t.spark, path))


@query("src_entity_dispatch", """SELECT 'organizations' AS entity, count(*) AS n FROM nation
 UNION ALL SELECT 'patients', count(*) FROM customer UNION ALL SELECT 'payers', count(*) FROM supplier""")
def _(t):
    base = t.scratch("bronze")
    # Two dated folders: only the newer one counts. Regions have no cleaner and are skipped.
    writers.write_parquet(t.customer, f"{base}/Patients/2025/10/30/patients.parquet")
    writers.write_parquet(cleaning.raw_patients(t), f"{base}/Patients/2025/11/11/Patients.parquet")
    writers.write_parquet(cleaning.raw_payers(t), f"{base}/Payers/2025/11/11/Payers.parquet")
    writers.write_parquet(t.nation.withColumnRenamed("n_name", "NAME"), f"{base}/Organizations/2025/11/11/organizations.parquet")
    writers.write_parquet(t.region, f"{base}/Regions/2025/11/11/regions.parquet")
    registry = cleaning.clean.registry(cleaning.ASOF, cleaning.NOW)
    found = readers.run_entities(t.spark, base, registry, log=lambda message: None)
    counts = [df.agg(F.lit(name).alias("entity"), F.count("*").alias("n")) for _, name, _, df in found]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


@query("src_inline_rows", """SELECT c_custkey, s.code, s.lead FROM customer JOIN (VALUES
 ('AUTOMOBILE', 'A', 'Ann'), ('BUILDING', 'B', 'Bob'), ('FURNITURE', 'F', 'Flo'), ('HOUSEHOLD', 'H', 'Hal'),
 ('MACHINERY', 'M', 'Mia')) s(segment, code, lead) ON c_mktsegment = s.segment""")
def _(t):
    rows = [("AUTOMOBILE", ("A", "Ann")), ("BUILDING", ("B", "Bob")), ("FURNITURE", ("F", "Flo")),
            ("HOUSEHOLD", ("H", "Hal")), ("MACHINERY", ("M", "Mia"))]
    segments = readers.from_rows(t.spark, rows, "segment string, info struct<code: string, lead: string>")
    return inner(t.customer, segments, {"c_mktsegment": "segment"}).select("c_custkey", "info.code", "info.lead")


@query("src_delta", CUSTOMER_SQL)
def _(t):
    path = t.scratch("table")
    writers.write_parquet(t.customer, path)
    return readers.read_table(t.spark, path, "delta")
