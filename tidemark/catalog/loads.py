"""Incremental loads, upserts, change feeds, control rows and the audit ledger."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..ledger import audit, catalogue, control
from ..operators import incremental as inc
from ..operators import upsert as up
from ..plans import loads
from .base import query

NOW1, NOW2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"
LOW, HIGH = "2024-01-10 00:00:00", "2024-01-20 00:00:00"


def _stored(t):
    """A target that lacks one segment and holds negative balances as zero."""
    old = t.customer.filter("c_mktsegment <> 'BUILDING'").withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0)))
    return up.stamp_audit_cols(old, 1, NOW1)


CHANGE_SQL = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'insert' WHEN c_acctbal < 0 THEN 'update' ELSE 'same' END"
EVENTS_SQL = "SELECT event_id, ts, user_id FROM events WHERE "


def _events(t):
    return t.events.select("event_id", "ts", "user_id")


@query("load_watermark_range", EVENTS_SQL + f"ts > TIMESTAMP '{LOW}' AND ts <= (SELECT max(ts) FROM events)")
def _(t):
    return inc.incremental(_events(t), "TS", LOW)


@query("load_watermark_inclusive", EVENTS_SQL + f"""ts >= (SELECT min(ts) FROM events WHERE ts > TIMESTAMP '{LOW}')
 AND ts <= TIMESTAMP '{HIGH}'""")
def _(t):
    # The low bound is the time of an existing row, which the inclusive form reads again.
    first = t.events.filter(F.col("ts") > F.lit(LOW).cast("timestamp_ntz")).agg(F.min("ts")).first()[0]
    return inc.incremental(_events(t), "ts", first, HIGH, inclusive=True)


@query("load_watermark_advance", """SELECT event_type AS table_name, CASE WHEN event_type = 'click'
 THEN (SELECT max(ts) FROM events) ELSE min(ts) END AS last_loaded_ts FROM events GROUP BY event_type""")
def _(t):
    marks = t.events.groupBy(F.col("event_type").alias("table_name")).agg(F.min("ts").alias("last_loaded_ts"))
    return inc.advance(marks, "click", inc.high_water(t.events, "ts"))


@query("load_config_lookup", """SELECT o_orderkey, o_custkey = (SELECT arg_min(c_custkey, c_acctbal) FROM customer) AS chosen FROM orders""")
def _(t):
    rows = t.customer.select(F.col("c_custkey").alias("Controlid"), F.col("c_name").alias("SourceObjectName"),
                             F.lit("Bronze").alias("DestinationZone"))
    name = t.customer.agg(F.min_by("c_name", "c_acctbal")).first()[0]
    found = inc.control_for(rows, name.upper(), "bronze")
    assert inc.control_for(rows, name, "Gold") is None
    return t.orders.select("o_orderkey", (F.col("o_custkey") == found["Controlid"]).alias("chosen"))


@query("load_zone_job", """SELECT 'events' AS name, count(*) FILTER (ts > TIMESTAMP '2024-01-10') AS n, 'no new rows' AS status,
 (SELECT max(ts) FROM events) AS mark, 0 AS unmarked FROM events UNION ALL SELECT 'nation', 0, 'no column ts', TIMESTAMP '2024-01-10', 0
 UNION ALL SELECT 'orders', count(*), 'loaded', NULL, 0 FROM orders UNION ALL SELECT 'part', 0, 'no control row', NULL, 0
 UNION ALL SELECT 'marks', count(*) FILTER (event_type <> 'error'), 'no new rows', (SELECT max(ts) FROM events), count(*) FILTER (event_type = 'error') FROM events""")
def _(t):
    name = F.when(F.col("r_name") == "ASIA", "Events").when(F.col("r_name") == "EUROPE", "nation").when(
        F.col("r_name") == "AFRICA", "marks").otherwise(F.col("r_name"))
    mark = F.when(name != "marks", F.lit("2024-01-10")).cast("timestamp_ntz").alias("LastWatermarkValue")
    control_rows = t.region.select(
        F.col("r_regionkey").alias("Controlid"), name.alias("SourceObjectName"),
        F.lit("Gold").alias("DestinationZone"), F.lit("ts").alias("IncrementalColumn"), mark)
    # Errors have no watermark in one source, and its object was never loaded: no low bound, and a number to report.
    marks = t.events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")).otherwise(
        F.when(F.col("event_id") < 0, F.col("ts")))).select("event_id", "ts")
    sources = {"events": t.events, "nation": t.nation, "orders": t.orders, "part": t.part, "marks": marks}
    root, ledger = t.scratch("zone"), audit.Ledger(t.spark, t.scratch("ledger"))
    after, _ = loads.load_zone(control_rows, sources, "gold", root, 1, ledger, full=["orders"])
    # The advanced control rows are lost; the ledger still knows what was loaded.
    _, report = loads.load_zone(control_rows, sources, "gold", root, 2, ledger, full=["orders"])
    stored = {n: loads.zone_table(ledger, "gold", n, n == "orders") for n in ("events", "orders", "marks")}
    counts = None
    for name, (status, _, unmarked) in report.items():
        rows = stored[name].agg(F.count("*").alias("n")) if name in stored else t.spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
        one = rows.select(F.lit(name).alias("name"), "n", F.lit(status).alias("status"), F.lit(unmarked).alias("unmarked"))
        counts = one if counts is None else counts.unionByName(one)
    marks = after.select(F.lower("SourceObjectName").alias("name"), F.col("LastWatermarkValue").alias("mark"))
    return counts.join(marks, "name", "left")


@query("load_full", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    root = t.scratch("full")
    ledger = audit.Ledger(t.spark, t.scratch("ledger"))
    loads.full_load(t.supplier.filter("s_acctbal < 0"), f"{root}/1", 1, ledger, "all.supplier")
    _, rows = loads.full_load(t.supplier, f"{root}/2", 2, ledger, "all.supplier")
    assert rows == t.supplier.count()
    return loads.zone_table(ledger, "all", "supplier", whole=True)


@query("load_full_reload_stamped", f"""SELECT l_orderkey, l_linenumber, l_quantity, FALSE AS "IsDeleted", '0' AS "HashValue",
 CAST(2 AS BIGINT) AS "ETLCreatedBatchID", TIMESTAMP '{NOW2}' AS "ETLModifiedDate" FROM lineitem""")
def _(t):
    out = up.full_reload(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), 2, NOW2)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "IsDeleted", "HashValue", "ETLCreatedBatchID", "ETLModifiedDate")


@query("load_snapshot_hash", """SELECT p_partkey, p_name, FALSE AS "IsDeleted",
 upper(sha1(concat_ws('|', CAST(p_partkey AS VARCHAR), p_name))) AS "HashValue" FROM part""")
def _(t):
    return up.with_hash(t.part.select("p_partkey", "p_name"), mode="sha1")


@query("load_hash_upsert", f"""SELECT c_custkey, c_name, c_acctbal, c_mktsegment, {CHANGE_SQL} AS change,
 CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(2 AS BIGINT) ELSE 1 END AS "ETLCreatedBatchID",
 CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal < 0 THEN TIMESTAMP '{NOW2}' ELSE TIMESTAMP '{NOW1}' END AS "ETLModifiedDate"
 FROM customer""")
def _(t):
    out = up.hash_upsert(_stored(t), t.customer, ["c_custkey"], 2, NOW2, label="change")
    return out.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "change", "ETLCreatedBatchID", "ETLModifiedDate")


@query("load_upsert_counts", """SELECT count(*) FILTER (c_mktsegment <> 'BUILDING' AND c_acctbal < 0) AS "RowsUpdated",
 count(*) FILTER (c_mktsegment = 'BUILDING') AS "RowsInserted" FROM customer""")
def _(t):
    return up.upsert_counts(t.customer, _stored(t), ["c_custkey"])


@query("load_micro_upsert", f"""SELECT event_id, ts + CASE WHEN user_id % 3 = 0 THEN INTERVAL 800 MICROSECOND ELSE INTERVAL 0 MICROSECOND END AS ts,
 CASE WHEN ts + CASE WHEN user_id % 3 = 0 THEN INTERVAL 800 MICROSECOND ELSE INTERVAL 0 MICROSECOND END IS DISTINCT FROM ts THEN 'update' ELSE 'same' END AS change FROM events""")
def _(t):
    # Times change by less than a millisecond.
    old = t.events.select("event_id", "ts")
    new = old.join(t.events.select(F.col("event_id").alias("e"), "user_id"), F.col("event_id") == F.col("e")).select(
        "event_id", F.when(F.col("user_id") % 3 == 0, F.col("ts") + F.expr("INTERVAL '0.000800' SECOND")).otherwise(F.col("ts")).alias("ts"))
    return up.hash_upsert(up.stamp_audit_cols(old, 1, NOW1), new, ["event_id"], 2, NOW2, label="change").select("event_id", "ts", "change")


@query("load_repeated", f"""SELECT c_custkey, c_nationkey, c_acctbal, CAST(1 AS BIGINT) AS batch, 0 AS inserted FROM
 (SELECT c_custkey, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS c_nationkey, c_acctbal FROM customer)""")
def _(t):
    # The second key column has NULLs. Three loads of one source give one load's rows, and the counts agree.
    source = t.customer.select("c_custkey", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("c_nationkey"), "c_acctbal")
    target, keys = up.stamp_audit_cols(source.limit(0), 1, NOW1), ["c_custkey", "c_nationkey"]
    for _ in range(3):
        target = up.hash_upsert(target, source, keys, 1, NOW1, null_keys="match")
    counted = up.upsert_counts(source, target, keys, null_keys="match").select(F.col("RowsInserted") + F.col("RowsUpdated"))
    return target.select(*source.columns, F.col("ETLCreatedBatchID").alias("batch")).withColumn("inserted", counted.scalar())


@query("load_control_job", """SELECT event_id, CASE WHEN ts > (SELECT date_trunc('second', max(ts)) FROM events
 WHERE ts <= TIMESTAMP '2024-01-20') THEN 'changed' ELSE event_type END AS event_type FROM events""")
def _(t):
    """Control row to low bound to extract to upsert to ledger, twice."""
    spec = t.region.filter("r_name = 'ASIA'").select(
        F.lit("crm").alias("SourceSystem"), F.lit("events").alias("SourceTable"), F.lit("raw").alias("SinkFileRoot"), F.lit("Source").alias("TableType"),
        F.lit(1).alias("SourceTypeID"), F.lit("Predicate").alias("DeltaDetectType"), F.lit("TS").alias("QueryPredicate"),
        F.lit('[{"ColumnName": "event_id"}, {"ColumnName": "event_type"}]').alias("ColumnMetaData"))
    row = control.control_rows(spec, "2025-01-01", NOW1).withColumn("ETLControlID", F.lit(5))
    ledger, root = audit.Ledger(t.spark, t.scratch("ledger")), t.scratch("controlled")
    early = t.events.filter("ts <= TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    loads.run_control(ledger, early, row, root, 1, NOW1, ["event_id"])
    # What the first load had has no changes that count; a changed watermark would be needed.
    later = t.events.withColumn("event_type", F.lit("changed"))
    loads.run_control(ledger, later, row, root, 2, NOW2, ["event_id"])
    assert loads.run_control(ledger, later, row.withColumn("IsActive", F.lit(False)), root, 3, NOW2, ["event_id"]) is None
    return loads.current_table(ledger, loads.LoadSpec(5, "events")).select("event_id", "event_type")


@query("load_by_keys", f"""SELECT c_custkey AS id, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(2 AS BIGINT) ELSE 1 END AS created
 FROM customer UNION ALL SELECT p_partkey, p_name, CAST(2 AS BIGINT) FROM part""")
def _(t):
    keyed = up.load_table(t.customer, _stored(t), ["c_custkey"], 2, NOW2)
    parts = t.part.select("p_partkey", "p_name")
    keyless = up.load_table(parts, up.stamp_audit_cols(parts, 1, NOW1), [], 2, NOW2)
    both = (keyed.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("ETLCreatedBatchID").alias("created")),
            keyless.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("ETLCreatedBatchID").alias("created")))
    return both[0].unionByName(both[1])


DIM_CHANGE = """CASE WHEN o_orderstatus = 'F' THEN 'kept' WHEN o_orderstatus = 'O' THEN 'update' ELSE 'insert' END"""


@query("dim_upsert_task", f"""SELECT o_orderkey AS "Task_ID", CASE WHEN o_orderstatus = 'F' THEN 'old' ELSE o_orderpriority END AS "Task",
 CASE WHEN o_orderstatus = 'F' THEN 'old type' WHEN c_acctbal >= 0 THEN c_mktsegment END AS "Task_Type", {DIM_CHANGE} AS change
 FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    # The dimension holds finished and open orders; open and pending ones arrive. Owners in debt have no type.
    dim = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("Task_ID"), F.lit("old").alias("Task"),
                                                        F.lit("old type").alias("Task_Type"))
    tasks = t.orders.filter("o_orderstatus <> 'F'")
    typed = tasks.join(t.customer.filter("c_acctbal >= 0"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return up.dim_upsert(dim, typed, {"Task_ID": "o_orderkey"}, {"Task": "o_orderpriority", "Task_Type": "c_mktsegment"},
                         label="change")


@query("dim_upsert_county", """SELECT c_custkey AS cnt_id, CASE WHEN c_acctbal < 0 THEN 'old' ELSE c_name END AS "County",
 CASE WHEN c_acctbal < 0 THEN 'old' ELSE n_name END AS "State", CASE WHEN c_acctbal < 0 THEN -1 ELSE c_nationkey END AS "State_Code",
 CASE WHEN c_acctbal < 0 THEN 'kept' WHEN c_mktsegment = 'BUILDING' THEN 'insert' ELSE 'update' END AS change
 FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    dim = t.customer.filter("c_acctbal < 0 OR c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("cnt_id"), F.lit("old").alias("County"), F.lit("old").alias("State"), F.lit(-1).alias("State_Code"))
    rows = t.customer.filter("c_acctbal >= 0").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return up.dim_upsert(dim, rows, {"cnt_id": "c_custkey"},
                         {"County": "c_name", "State": "n_name", "State_Code": "c_nationkey"}, label="change")


@query("dim_upsert_enrolment", """SELECT p_partkey AS "Enrolment_Status_ID", CASE WHEN p_size <= 10 THEN 'old' ELSE p_name END
 AS "Enrolment_Status_Name" FROM part""")
def _(t):
    dim = t.part.filter("p_size <= 25").select(F.col("p_partkey").alias("Enrolment_Status_ID"),
                                               F.lit("old").alias("Enrolment_Status_Name"))
    return up.dim_upsert(dim, t.part.filter("p_size > 10"), {"Enrolment_Status_ID": "p_partkey"},
                         {"Enrolment_Status_Name": "p_name"})


@query("dim_upsert_exclusion", """SELECT user_id AS "Exclusion_Reason_ID", arg_max(event_type, ROW(ts, event_id)) AS "Exclusion_Reason"
 FROM events GROUP BY user_id""")
def _(t):
    # Many source rows per key: the last one wins.
    dim = t.events.filter("event_type = 'error'").select(F.col("user_id").alias("Exclusion_Reason_ID"),
                                                        F.lit("old").alias("Exclusion_Reason")).distinct()
    return up.dim_upsert(dim, t.events, {"Exclusion_Reason_ID": "user_id"}, {"Exclusion_Reason": "event_type"},
                         order=["ts", "event_id"])


def _feed(t):
    """Orders as changes of their customer's balance; codes follow the order status and price."""
    code = (F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 4)
            .when(F.col("o_totalprice") > 250000, 1).otherwise(3))
    lsn = F.when(F.col("o_orderpriority") != "5-LOW", F.unhex(F.lpad(F.hex("o_orderkey"), 20, "0")))
    return t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"),
                           code.alias("__$operation"), lsn.alias("__$start_lsn"), F.lit(0).alias("__$seqval"))


FEED_SQL = """(SELECT o_orderkey AS lsn, o_custkey AS k, o_totalprice AS v, CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'O'
 THEN 4 WHEN o_totalprice > 250000 THEN 1 ELSE 3 END AS op FROM orders WHERE o_orderpriority <> '5-LOW')"""


@query("cdc_filter_valid", """SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal FROM orders WHERE o_orderpriority <> '5-LOW'""")
def _(t):
    return up.valid_changes(_feed(t)).select("c_custkey", "c_acctbal")


@query("cdc_merge", f"""WITH latest AS (SELECT k, arg_max(v, lsn) AS v, arg_max(op, lsn) AS op FROM {FEED_SQL} WHERE op <> 3 GROUP BY k)
 SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT k FROM latest)
 UNION ALL SELECT k, v FROM latest WHERE op IN (2, 4)""")
def _(t):
    target = t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal")
    return up.apply_cdc(target, up.valid_changes(_feed(t)), ["c_custkey"], ["__$start_lsn", "__$seqval"])


@query("cdc_strict", """WITH feed AS (SELECT o_custkey AS k, o_totalprice AS v, o_orderkey AS lsn, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END AS op FROM orders),
 first_insert AS (SELECT k, min(lsn) AS at FROM feed WHERE op = 2 GROUP BY k),
 last_update AS (SELECT k, max(lsn) AS at FROM feed WHERE op = 3 GROUP BY k),
 chosen AS (SELECT c_custkey AS k, c_mktsegment <> 'BUILDING' AS there, i.at AS ins, u.at AS upd FROM customer
 LEFT JOIN first_insert i ON i.k = c_custkey LEFT JOIN last_update u ON u.k = c_custkey)
 SELECT c.k AS c_custkey, CASE WHEN there THEN coalesce(f.v, b.c_acctbal) ELSE f.v END AS c_acctbal FROM chosen c JOIN customer b ON b.c_custkey = c.k
 LEFT JOIN feed f ON f.k = c.k AND f.lsn = CASE WHEN there THEN upd WHEN ins IS NULL THEN NULL WHEN upd > ins THEN upd ELSE ins END
 WHERE there OR ins IS NOT NULL""")
def _(t):
    # An insert and later updates of a new key in one feed: the key is there with the last value.
    feed = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), F.col("o_orderkey").alias("lsn"),
                           F.when(F.col("o_orderstatus") == "F", 2).otherwise(3).alias("__$operation"))
    target = t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal")
    return up.apply_cdc(target, feed, ["c_custkey"], ["lsn"], ops=up.COMPAT_OPS, strict=True)


def _specs(t):
    """Parts as source descriptions: brand is the system, part key the table."""
    kind = F.when(F.col("p_type") == "PROMO", "Predicate").when(F.col("p_type") == "SMALL", "ChangeTracking")
    return t.part.select(
        "p_partkey", F.col("p_brand").alias("SourceSystem"), F.lit("dbo").alias("SourceSchema"),
        F.concat(F.when(F.col("p_size") > 25, "/t/").otherwise("t"), F.col("p_partkey").cast("string")).alias("SourceTable"),
        F.lit("raw").alias("SinkFileRoot"), F.when(F.col("p_size") < 5, "given\\").alias("SinkFilePath"),
        F.when(F.col("p_size") > 40, "Stage").otherwise("Source").alias("TableType"),
        F.when(F.col("p_size") < 10, 3).otherwise(1).alias("SourceTypeID"), kind.alias("DeltaDetectType"),
        F.when(kind == "Predicate", "LOAD_DATE").alias("QueryPredicate"), F.col("p_name").alias("SourceQuery"))


TABLE_SQL = "CASE WHEN p_size > 25 THEN '/t/' ELSE 't' END || CAST(p_partkey AS VARCHAR)"
PLAIN_SQL = "CASE WHEN p_size > 25 THEN 't_' ELSE 't' END || CAST(p_partkey AS VARCHAR)"


@query("ctl_derive_fields", f"""SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Incremental' ELSE 'Full' END AS "LoadType",
 CASE p_type WHEN 'PROMO' THEN 'MAX(LOAD_DATE)' WHEN 'SMALL' THEN 'CHANGE_TRACKING_CURRENT_VERSION()' ELSE '0' END AS "MaxExpression",
 CASE WHEN p_size < 10 THEN '2025-01-01 00:00:00.000' END AS "MinExpression",
 CASE WHEN p_size < 5 THEN 'given\\' WHEN p_size <= 40 THEN {PLAIN_SQL} || '\\YYYY\\MM\\DD\\' END AS "SinkFilePath",
 CASE WHEN p_size <= 40 THEN {PLAIN_SQL} || '_*.parquet' END AS "SinkFileName",
 CASE WHEN p_size > 40 THEN 'Loading data from azure data lake storage to staging tables'
 ELSE 'Loading data from source to azure data lake storage' END AS "Note" FROM part""")
def _(t):
    out = control.derive_control(_specs(t), "2025-01-01")
    return out.select("p_partkey", "LoadType", "MaxExpression", "MinExpression", "SinkFilePath", "SinkFileName", "Note")


@query("ctl_upsert", f"""SELECT p_brand AS "SourceSystem", '[{{"SQLSource":{{"SchemaName":"dbo","TableName":"' || {TABLE_SQL} || '"}}' || CASE WHEN p_size < 10
 THEN ',"FileSource":{{"FileQuoteCharacter":""}}' ELSE '' END || '}}]' AS "Source",
 CASE WHEN p_size > 30 THEN 'old query' ELSE p_name END AS "SourceQuery",
 CASE WHEN p_size > 30 THEN 'kept' WHEN p_size > 15 THEN 'update' ELSE 'insert' END AS change FROM part""")
def _(t):
    # Rows of large parts exist already; small and middle ones are registered now.
    old = control.control_rows(_specs(t).withColumn("SourceQuery", F.lit("old query")), "2025-01-01", NOW1)
    key = F.regexp_extract("Source", "t_?/?([0-9]+)\"", 1).cast("bigint")
    sizes = t.part.select("p_partkey", "p_size")
    existing = old.withColumn("k", key).join(sizes.filter("p_size > 15"), F.col("k") == F.col("p_partkey")).select(*old.columns)
    arriving = control.control_rows(_specs(t).join(sizes.filter("p_size <= 30"), "p_partkey"), "2025-01-01", NOW2)
    merged = control.register_source(existing, arriving, label="change")
    return merged.select("SourceSystem", "Source", "SourceQuery", "change")


def _log(t):
    """Orders as past runs of their customer's load."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "Full").otherwise("Incremental")
    return t.orders.select(
        F.col("o_orderkey").alias("ETLAuditLogID"), F.col("o_custkey").alias("ETLControlID"), kind.alias("LoadType"),
        (F.col("o_orderstatus") != "P").alias("IsLoadSuccess"),
        F.when(F.col("o_totalprice") > 50000, 10).otherwise(0).cast("long").alias("RowsInserted"),
        F.col("o_orderdate").alias("ETLStartTime"), "o_orderdate", "o_orderkey")


def _controls(t, high="2025-01-01 00:00:00.000"):
    kind = F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "ChangeTracking").otherwise("Predicate")
    load = F.when(F.col("c_mktsegment") == "MACHINERY", "Full").otherwise("Incremental")
    top = F.when(kind == "ChangeTracking", "999999999").otherwise(high)
    return t.customer.select(F.col("c_custkey").alias("ETLControlID"), load.alias("LoadType"), kind.alias("DeltaDetectType"),
                             F.lit("[{\"QueryPredicate\":\"LOAD_DATE\"}]").alias("DeltaDetect"), top.alias("ETLMaxValue"))


def _bounded_log(t):
    """The log with bounds in the control's own type: versions or times."""
    tracked = t.customer.filter("c_mktsegment IN ('AUTOMOBILE', 'BUILDING')").select(F.col("c_custkey").alias("tracked"))
    joined = _log(t).join(tracked, F.col("ETLControlID") == F.col("tracked"), "left")
    bound = F.when(F.col("tracked").isNotNull(), F.col("o_orderkey").cast("string")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS"))
    return joined.withColumn("ETLMaxValue", bound)


def _resolve_sql(high, shift=0):
    return f"""WITH log AS (SELECT o_orderkey AS id, o_custkey AS c, o_orderdate AS s, o_orderstatus <> 'P' AND o_totalprice > 50000 AS good,
 o_orderpriority = '1-URGENT' AS is_full FROM orders),
 anchors AS (SELECT c, coalesce(max(s) FILTER (is_full), max(s) FILTER (NOT is_full)) AS since FROM log GROUP BY c),
 lows AS (SELECT c, max(id) FILTER (good AND s >= since) AS v, max(s) FILTER (good) AS d FROM log JOIN anchors USING (c) GROUP BY c),
 found AS (SELECT c_custkey, c_mktsegment, v, coalesce(d - INTERVAL {shift} DAY, TIMESTAMP '1900-01-01') AS d
 FROM customer LEFT JOIN lows ON c = c_custkey)
 SELECT c_custkey AS "ETLControlID", CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN CAST(coalesce(v, 0) AS VARCHAR)
 WHEN c_mktsegment = 'MACHINERY' THEN '1900-01-01 00:00:00.000' WHEN d >= TIMESTAMP '{high}' THEN '1900-01-01'
 ELSE strftime(d, '%Y-%m-%d %H:%M:%S.%g') END AS "ETLMinValue" FROM found"""


@query("audit_resolve_min", _resolve_sql("2025-01-01"))
def _(t):
    return audit.resolve_low(_bounded_log(t), _controls(t)).select("ETLControlID", "ETLMinValue")


@query("audit_reset_guard", _resolve_sql("1999-06-01"))
def _(t):
    # Many logs already reach past this high bound, so their next load starts over.
    low = audit.resolve_low(_bounded_log(t), _controls(t, "1999-06-01 00:00:00.000"))
    return low.select("ETLControlID", "ETLMinValue")


@query("audit_lookback", EVENTS_SQL + f"ts > TIMESTAMP '{LOW}' - INTERVAL 3 DAY AND ts <= TIMESTAMP '{HIGH}'")
def _(t):
    return inc.incremental(_events(t), "ts", LOW, HIGH, lookback_days=3)


def _run_events(t, *states):
    """Orders as run events: a start per order, and an end unless the order is still open."""
    start = t.orders.select(F.col("o_orderkey").alias("ETLAuditLogID"), F.col("o_orderdate").alias("ETLStartTime"),
                            F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("size"))
    seconds = F.floor(F.col("size") / 1000).cast("int")
    end = F.col("ETLStartTime") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    out = start.select("ETLAuditLogID", "ETLStartTime", F.lit(None).cast("timestamp_ntz").alias("ETLEndTime"),
                       F.lit(audit.STARTED).alias("LoadStatus"), F.lit(False).alias("IsLoadSuccess"),
                       F.lit(None).cast("bigint").alias("RunTimeInSecond"), F.lit(None).cast("string").alias("ErrorMsg"),
                       F.lit(None).cast("decimal(20,2)").alias("ThroughputInKbps"), F.col("ETLStartTime").alias("EventTime"))
    for code, state in (("F", audit.COMPLETED), ("P", audit.FAILED)):
        if state not in states:
            continue
        done = start.filter(F.col("s") == code).withColumn("ETLEndTime", end)
        fields = audit.completed_fields(state, "ETLStartTime", "ETLEndTime", F.col("size"))
        done = done.withColumns(fields).withColumns({
            "EventTime": F.col("ETLEndTime"), "ErrorMsg": F.lit("divide by zero" if state == audit.FAILED else None).cast("string")})
        out = out.unionByName(done.select(*out.columns))
    return out


@query("audit_started", """SELECT o_orderkey AS "ETLAuditLogID", 'Started' AS "LoadStatus", FALSE AS "IsLoadSuccess" FROM orders""")
def _(t):
    return audit.current_runs(_run_events(t)).select("ETLAuditLogID", "LoadStatus", "IsLoadSuccess")


@query("audit_completed", """SELECT o_orderkey AS "ETLAuditLogID", CASE o_orderstatus WHEN 'F' THEN 'Completed' ELSE 'Started' END AS "LoadStatus",
 CASE o_orderstatus WHEN 'F' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) END AS "RunTimeInSecond",
 o_orderstatus = 'F' AS "IsLoadSuccess" FROM orders""")
def _(t):
    runs = audit.current_runs(_run_events(t, audit.COMPLETED))
    return runs.select("ETLAuditLogID", "LoadStatus", "RunTimeInSecond", "IsLoadSuccess")


@query("audit_failed", """SELECT o_orderkey AS "ETLAuditLogID", CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Failed'
 ELSE 'Started' END AS "LoadStatus", CASE o_orderstatus WHEN 'P' THEN 'divide by zero' END AS "ErrorMsg",
 o_orderstatus = 'F' AS "IsLoadSuccess" FROM orders""")
def _(t):
    runs = audit.current_runs(_run_events(t, audit.COMPLETED, audit.FAILED))
    return runs.select("ETLAuditLogID", "LoadStatus", "ErrorMsg", "IsLoadSuccess")


@query("audit_process_log", """SELECT 'events' AS "Source", 'Completed' AS "LoadStatus", count(*) AS "RowsInserted",
 CAST(NULL AS VARCHAR) AS "ErrorMsg" FROM events UNION ALL SELECT 'broken', 'Failed', NULL, 'no such rows'""")
def _(t):
    ticks = iter(datetime(2025, 1, 1) + timedelta(seconds=i) for i in range(10_000))
    ledger = audit.Ledger(t.spark, t.scratch("ledger"), clock=lambda: next(ticks))
    with audit.with_audit(ledger, ETLControlID=1, Source="events") as counts:
        counts["RowsInserted"] = loads.full_load(t.events, t.scratch("events"), 1)[1]
    try:
        with audit.with_audit(ledger, ETLControlID=2, Source="broken"):
            raise LookupError("no such rows")
    except LookupError:
        pass
    return ledger.runs().select("Source", "LoadStatus", "RowsInserted", "ErrorMsg")


@query("load_ledger_job", """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(t):
    """Two batches of one object through extract, upsert, publish and ledger."""
    ledger = audit.Ledger(t.spark, t.scratch("ledger"))
    spec = loads.LoadSpec(9, "orders", keys=["o_orderkey"], watermark="modified_on",
                          columns=["o_orderkey", "o_custkey", "o_orderstatus"],
                          order=["Modified On"])
    root = t.scratch("published")
    placed, finished = F.col("o_orderdate"), F.col("o_orderstatus") == "F"
    early = t.orders.filter(placed < F.lit("1999-01-01").cast("timestamp_ntz")).withColumn("Modified On", placed)
    loads.run_load(ledger, early, spec, root, 1, NOW1)
    # Since then the later orders came in and all finished ones were changed.
    later = t.orders.withColumns({
        "o_orderstatus": F.when(finished, "X").otherwise(F.col("o_orderstatus")),
        "Modified On": F.when(finished, F.lit("2025-01-10").cast("timestamp_ntz")).otherwise(placed)})
    loads.run_load(ledger, later, spec, root, 2, NOW2)
    return loads.current_table(ledger, spec).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("stamp_audit_cols", f"""SELECT n_nationkey, n_name, n_regionkey, TIMESTAMP '{NOW1}' AS "ETLCreatedDate", CAST(1 AS BIGINT) AS "ETLCreatedBatchID",
 TIMESTAMP '{NOW1}' AS "ETLModifiedDate", CAST(1 AS BIGINT) AS "ETLModifiedBatchID", FALSE AS "IsDeleted",
 upper(sha1(concat_ws('|', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)))) AS "HashValue" FROM nation""")
def _(t):
    return up.stamp_audit_cols(t.nation, 1, NOW1, mode="sha1")


@query("stamp_load_time", f"SELECT c_custkey, TIMESTAMP '{NOW1}' AS loaddatetime FROM customer")
def _(t):
    return up.stamp_loaded(t.customer.select("c_custkey"), NOW1)


@query("stamp_client_id", """SELECT c_custkey AS id, 42 AS "Client_Id" FROM customer""")
def _(t):
    return up.stamp_client(t.customer.select(F.col("c_custkey").alias("id")), 42)


@query("ctl_target_tables", """WITH cat AS (SELECT p_brand AS s, p_name AS t, p_type AS c, min(p_size) AS ord,
 bool_or(p_size < 4) AS is_key FROM part GROUP BY ALL)
 SELECT s AS "CustomSchemaName", replace(t, ' ', '_') AS "TableName", string_agg(c || ' string', ', ' ORDER BY ord, c) AS "ColumnNames",
 string_agg(c, ', ' ORDER BY ord, c) FILTER (is_key) AS "KeyColumns",
 CASE WHEN bool_or(is_key) AND bool_or(NOT is_key) THEN 'upsert' ELSE 'reload' END AS "LoadKind" FROM cat
 WHERE s <> 'Brand#2' GROUP BY s, t""")
def _(t):
    # Brands are schemas, part names tables and part types columns; one schema exists already.
    columns = t.part.groupBy(F.col("p_brand").alias("CustomSchemaName"), F.replace("p_name", F.lit(" "), F.lit("/")).alias("TableName"),
                             F.col("p_type").alias("ColumnName")).agg(
        F.struct(F.min("p_size").alias("size"), F.first("p_type").alias("type")).alias("ColumnId"),
        F.when(F.min("p_size") < 4, "Yes").otherwise("No").alias("IsPrimaryKey")).withColumn("DataType", F.lit("string"))
    return catalogue.target_tables(columns, columns.filter("CustomSchemaName = 'Brand#2'"))
