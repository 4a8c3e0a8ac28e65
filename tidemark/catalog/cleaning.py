"""Raw entities derived from the tables, and their cleaners."""

from pyspark.sql import functions as F

from ..functions.hashing import natural_id
from ..ledger import audit
from ..plans import clean, loads
from ..sources import writers
from .base import blank_sql, collapse_sql, json_arrays, printable_sql, query, title_sql, zip_sql

ASOF, NOW = "2025-01-01", "2025-01-15 08:00:00"


def raw_patients(t):
    """Customers as patients with padded, blank, malformed and missing values."""
    c = F.col
    return t.customer.select(
        F.when(c("c_acctbal") < 0, "bad-id").otherwise(F.md5(c("c_custkey").cast("string"))).alias("Id"),
        F.when(c("c_mktsegment") == "MACHINERY", "n/a").otherwise(
            F.date_format(F.date_add(F.lit("1930-01-01").cast("date"), (c("c_custkey") * 13 % 30000).cast("int")), "yyyy-MM-dd")).alias("BIRTHDATE"),
        F.when(c("c_acctbal") > 5000, " dr. ").alias("PREFIX"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("FIRST"), F.lit("o'neil").alias("LAST"),
        F.when(c("c_nationkey") > 12, "   ").otherwise("maria josé").alias("MAIDEN"),
        F.lower("c_mktsegment").alias("MARITAL"), F.when(c("c_nationkey") < 5, "").otherwise(" f ").alias("GENDER"),
        F.concat(F.lit("12  main\t st "), c("c_nationkey").cast("string")).alias("ADDRESS"),
        F.when(c("c_nationkey") != 3, "são paulo").alias("CITY"),
        F.when(c("c_mktsegment") != "BUILDING", c("c_custkey").cast("double")).alias("ZIP"),
        F.when(c("c_acctbal") > 0, c("c_acctbal")).alias("LAT"))


ADDRESS_SQL = title_sql(f"trim({collapse_sql(chr(39) + '12  main' + chr(39) + ' || chr(9) || ' + chr(39) + ' st ' + chr(39) + ' || CAST(c_nationkey AS VARCHAR)')})")
BIRTH_SQL = "CASE WHEN c_mktsegment <> 'MACHINERY' THEN DATE '1930-01-01' + CAST(c_custkey * 13 % 30000 AS INTEGER) END"


@query("clean_patients", f"""SELECT CASE WHEN c_acctbal < 0 THEN 'bad-id' ELSE md5(CAST(c_custkey AS VARCHAR)) END AS id,
 CAST({BIRTH_SQL} AS TIMESTAMP) AS birthdate,
 CASE WHEN c_acctbal > 5000 THEN 'Dr.' ELSE 'Not Provided' END AS prefix, {title_sql('c_name')} AS first, 'O''neil' AS last,
 CASE WHEN c_nationkey > 12 THEN 'N/A' ELSE 'Maria Jos' END AS maiden, c_mktsegment AS marital,
 CASE WHEN c_nationkey < 5 THEN 'UNKNOWN' ELSE 'F' END AS gender, {ADDRESS_SQL} AS address,
 CASE WHEN c_nationkey <> 3 THEN 'So Paulo' ELSE 'Unknown' END AS city,
 {zip_sql("CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) END")} AS zip,
 CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS lat,
 CAST(floor(date_diff('day', {BIRTH_SQL}, DATE '{ASOF}') / 365.25) AS BIGINT) AS age,
 CASE WHEN c_acctbal < 0 THEN 'Invalid' ELSE 'Valid' END AS valid_uuid, TIMESTAMP '{NOW}' AS "Last_Modified" FROM customer""")
def _(t):
    return clean.clean_patients(raw_patients(t), ASOF, NOW)


def raw_payers(t):
    c = F.col
    return t.supplier.select(
        F.md5(c("s_suppkey").cast("string")).alias("Id"), F.concat(F.lit(" The   "), "s_name").alias("NAME"),
        F.when(c("s_nationkey") > 5, "1 High St").alias("ADDRESS"), F.when(c("s_nationkey") > 5, "New  York ").otherwise(" ").alias("CITY"),
        F.when(c("s_nationkey") > 5, "NY").alias("STATE_HEADQUARTERED"), (c("s_suppkey") * 97).cast("double").alias("ZIP"),
        F.when(c("s_acctbal") < 0, "---").when(c("s_nationkey") > 5, "1-555-010-0123").alias("PHONE"))


@query("clean_payers", f"""SELECT md5(CAST(s_suppkey AS VARCHAR)) AS "ID", 'The ' || s_name AS "NAME",
 CASE WHEN s_nationkey > 5 THEN '1 High St' ELSE 'Not Provided' END AS "ADDRESS",
 CASE WHEN s_nationkey > 5 THEN 'New York' ELSE 'Unknown' END AS "CITY",
 CASE WHEN s_nationkey > 5 THEN 'NY' ELSE 'Unknown' END AS "STATE_HEADQUARTERED", {zip_sql('CAST(s_suppkey * 97 AS VARCHAR)')} AS "ZIP",
 CASE WHEN s_acctbal < 0 OR s_nationkey <= 5 THEN 'Not Provided' ELSE '15550100123' END AS "PHONE", 'Valid' AS "VALID_UUID" FROM supplier""")
def _(t):
    return clean.clean_payers(raw_payers(t))


def _timed(t, *extra):
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    stop = F.col("ts") + F.make_dt_interval(mins=F.col("user_id").cast("int") - 20)
    return t.events.select(
        "event_id", F.date_format("ts", iso).alias("START"),
        F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format(stop, iso)).alias("STOP"),
        F.concat(F.lit(" routine – "), "event_type").alias("DESCRIPTION"),
        F.when(F.col("user_id") > 20, F.col("user_id")).alias("REASONCODE"),
        F.when(F.col("user_id") > 40, F.lit("chronic PAIN ")).alias("REASONDESCRIPTION"), *extra)


TIMED_SQL = f"""event_id, date_trunc('second', ts) AS start, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) + to_minutes(user_id - 20) END AS stop,
 {printable_sql(f"trim({title_sql(chr(39) + ' routine – ' + chr(39) + ' || event_type')})")} AS description,
 CASE WHEN user_id > 20 THEN user_id ELSE 0 END AS reasoncode,
 CASE WHEN user_id > 40 THEN 'Chronic Pain' ELSE 'Unknown Reason' END AS reasondescription,
 CASE WHEN event_type <> 'error' THEN CAST(user_id - 20 AS DOUBLE) END AS duration_minutes"""


@query("clean_procedures", f"""SELECT {TIMED_SQL}, CASE WHEN event_type = 'view' THEN NULL WHEN value < 20 THEN 0 ELSE value - 20 END AS base_cost,
 count(*) OVER () AS n_ids FROM events""")
def _(t):
    cost = F.when(F.col("event_type") != "view", F.col("value") - 20).alias("BASE_COST")
    out = clean.clean_procedures(_timed(t, cost))
    # Ids are hashes, so the check is that they tell all rows apart.
    distinct_ids = out.select("Procedure_Id").agg(F.count_distinct("Procedure_Id"))
    return out.drop("Procedure_Id").withColumn("n_ids", distinct_ids.scalar())


@query("clean_procedure_ids", """SELECT count(*) AS n, count(*) AS n_ids FROM (SELECT DISTINCT user_id % 7 AS a, value < 20 AS b, event_type = 'view' AS c FROM events)""")
def _(t):
    # Rows that differ only in which column is NULL get ids of their own.
    rows = t.events.select((F.col("user_id") % 7).alias("a"), (F.col("value") < 20).alias("b"), (F.col("event_type") == "view").alias("c")).distinct()
    parts = rows.select(*[F.when(rows[k].cast("int") == 1, "x").otherwise(F.lit(None)).alias(k) for k in ("b", "c")],
                        *[F.when(F.col("a") == i, "x").alias(f"a{i}") for i in range(7)])
    return parts.select(natural_id(parts.columns).alias("i")).agg(F.count("*").alias("n"), F.count_distinct("i").alias("n_ids"))


@query("clean_encounters", f"""SELECT {TIMED_SQL}, CASE WHEN event_type <> 'view' THEN value ELSE 0 END AS payer_coverage,
 value AS base_encounter_cost, CASE WHEN user_id > 20 THEN value * 2 ELSE 0 END AS total_claim_cost FROM events""")
def _(t):
    return clean.clean_encounters(_timed(
        t, F.when(F.col("event_type") != "view", F.col("value")).alias("PAYER_COVERAGE"),
        F.col("value").alias("BASE_ENCOUNTER_COST"), F.when(F.col("user_id") > 20, F.col("value") * 2).alias("TOTAL_CLAIM_COST")))


@query("clean_organizations", f"""SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN 'Unknown Organization' ELSE 'St. ' || {title_sql('s_name')} END AS name,
 {zip_sql('CAST(s_suppkey AS VARCHAR)')} AS zip, {blank_sql("'Town'", 'x')} AS city FROM supplier""")
def _(t):
    raw = t.supplier.select(
        F.col("s_suppkey").alias("Id"), F.when(F.col("s_acctbal") >= 0, F.concat(F.lit(" st.  "), F.upper("s_name"))).alias("NAME"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit(".0 ")).alias("ZIP"), F.lit("  Town ").alias("CITY"))
    return clean.clean_organizations(raw)


@query("clean_generic_csv", """SELECT o_orderkey, upper(o_orderpriority) AS "Name", CAST(floor(o_totalprice * 75) AS BIGINT) AS "AverageRate",
 format('{:,.2f}', o_totalprice) AS "LineTotal", upper(o_orderpriority) || '_' || CAST(o_custkey AS VARCHAR) AS "ProductNumber",
 upper(substring(o_orderpriority, 1, 3)) AS "New_Region_Name" FROM orders""")
def _(t):
    raw = t.orders.select("o_orderkey", F.lower("o_orderpriority").alias("Name"), F.col("o_totalprice").alias("AverageRate"),
                          F.col("o_totalprice").alias("LineTotal"),
                          F.concat(F.lit("ab_"), F.col("o_custkey").cast("string")).alias("ProductNumber"))
    return clean.clean_generic(raw)


@query("load_medallion_job", f"""SELECT 'patients' AS entity, md5(CAST(c_custkey AS VARCHAR)) AS id, CASE WHEN c_nationkey <> 3 THEN 'So Paulo'
 ELSE 'Unknown' END AS city FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT 'patients', 'bad-id', CASE WHEN c_nationkey <> 3
 THEN 'So Paulo' ELSE 'Unknown' END FROM customer WHERE c_acctbal < 0 UNION ALL
 SELECT 'payers', md5(CAST(s_suppkey AS VARCHAR)), CASE WHEN s_nationkey > 5 THEN 'New York' ELSE 'Unknown' END FROM supplier""")
def _(t):
    """Raw files to cleaned batches to the next zone: patients by watermark, payers as a whole snapshot."""
    bronze, silver, gold = t.scratch("bronze"), t.scratch("silver"), t.scratch("gold")
    writers.write_parquet(raw_patients(t), f"{bronze}/Patients/2025/11/11/Patients.parquet")
    payers = raw_payers(t)
    # Two sources of payers hand in a file of the same name.
    for folder, half in (("Payers", F.col("PHONE").isNotNull()), ("OtherPayers", F.col("PHONE").isNull())):
        json_arrays(payers.filter(half), f"{bronze}/{folder}/2025/11/11/Payers.json", F.floor(F.col("ZIP") / (97 * 50)))
    for batch in (1, 1):  # a repeated batch replaces itself
        counts = loads.bronze_to_silver(t.spark, bronze, silver, clean.registry(ASOF, NOW), batch)
    assert set(counts) == {"Patients/Patients.parquet", "Payers/Payers.json", "OtherPayers/Payers.json"}
    assert counts["Payers/Payers.json"] + counts["OtherPayers/Payers.json"] == t.supplier.count()
    ledger = audit.Ledger(t.spark, t.scratch("ledger"))
    mark = F.lit("2010-01-01").cast("timestamp_ntz").alias("LastWatermarkValue")
    control = t.spark.range(1).select(F.lit("Patients").alias("SourceObjectName"), F.lit("Gold").alias("DestinationZone"),
                                      F.lit("Last Modified").alias("IncrementalColumn"), F.col("id").alias("Controlid"), mark)
    sources = {"Patients": loads.read_batches(t.spark, f"{silver}/patients"), "Payers": loads.latest_batch(t.spark, f"{silver}/payers")}
    loads.load_zone(control, sources, "Gold", gold, 1, ledger, full=["Payers"])
    patients = loads.zone_table(ledger, "Gold", "Patients").select(F.lit("patients").alias("entity"), "id", "city")
    payers = loads.zone_table(ledger, "Gold", "Payers", whole=True).select(F.lit("payers").alias("entity"), F.col("ID").alias("id"), F.col("CITY").alias("city"))
    return patients.unionByName(payers)
