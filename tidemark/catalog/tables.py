"""Tables of committed files: upserts of parts, deltas, windows from bounds of files, loads that run at once."""

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ledger import audit
from ..operators import upsert as up
from ..operators.layout import range_bucket
from ..plans import loads
from ..schemas import DEVICE_MESSAGES
from ..streaming import ingest
from ..tables.aggregates import Measures, RefreshedAggregate, weighted
from ..tables.checked import CheckedTable, Rules, lines
from ..tables.commits import Conflict
from ..tables.files import FileTable
from ..tables.ingest import FileIngest
from ..tables.keyed import KeyedTable
from ..tables.ranges import RangeTable
from .base import as_double, query
from .loads import CHANGE_SQL, FEED_SQL, NOW1, NOW2, _feed, _stored
from .streams import MESSAGES_SQL


@query("load_keyed_upsert", f"""SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
 CASE WHEN {CHANGE_SQL} = 'insert' THEN CAST(2 AS BIGINT) ELSE 1 END AS "ETLCreatedBatchID",
 CASE WHEN {CHANGE_SQL} = 'same' THEN TIMESTAMP '{NOW1}' ELSE TIMESTAMP '{NOW2}' END AS "ETLModifiedDate",
 (SELECT count(*) FROM customer WHERE {CHANGE_SQL} = 'insert') AS inserted, (SELECT count(*) FROM customer WHERE {CHANGE_SQL} = 'update') AS updated FROM customer""")
def _(t):
    table = KeyedTable(t.spark, t.scratch("keyed"), ["c_custkey"], parts=16)
    table.create(_stored(t))
    counts = table.upsert(t.customer, 2, NOW2)
    return table.read().select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "ETLCreatedBatchID", "ETLModifiedDate",
                               F.lit(counts["RowsInserted"]).alias("inserted"), F.lit(counts["RowsUpdated"]).alias("updated"))


@query("load_keyed_few", f"""SELECT c_custkey, CASE WHEN c_custkey = k THEN 'changed' ELSE c_name END AS c_name, TRUE AS others_kept
 FROM customer, (SELECT min(c_custkey) AS k FROM customer)""")
def _(t):
    # One key changes: the files of all parts but its own stay in force under their names.
    table = KeyedTable(t.spark, t.scratch("keyed"), ["c_custkey"], parts=16)
    names = t.customer.select("c_custkey", "c_name")
    table.upsert(names, 1, NOW1)
    before = table.files().select("part", "file").collect()
    one = names.join(names.agg(F.min("c_custkey").alias("c_custkey")), "c_custkey").withColumn("c_name", F.lit("changed"))
    own = set(table.touched(one))
    table.upsert(one, 2, NOW2)
    after = {r[0] for r in table.files().select("file").collect()}
    kept = {r.file for r in before} & after == {r.file for r in before if r.part not in own}
    return table.read().select("c_custkey", "c_name", F.lit(kept).alias("others_kept"))


@query("cdc_base_delta", f"""WITH latest AS (SELECT k, arg_max(v, lsn) AS v, arg_max(op, lsn) AS op FROM {FEED_SQL} WHERE op <> 3 GROUP BY k)
 SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey NOT IN (SELECT k FROM latest)
 UNION ALL SELECT k, v FROM latest WHERE op IN (2, 4)""")
def _(t):
    table = KeyedTable(t.spark, t.scratch("feed"), ["c_custkey"], parts=8)
    table.create(t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal"))
    bounds = [bytearray(int(b).to_bytes(10, "big")) for b in t.orders.approxQuantile("o_orderkey", [0.25, 0.5, 0.75], 0.05)]
    changes = up.valid_changes(_feed(t)).withColumn("batch", range_bucket("__$start_lsn", bounds))
    for batch in (0, 1, 1, 2, 0, 3):  # repeated batches change nothing
        table.apply(changes.filter(F.col("batch") == batch), batch, ["__$start_lsn", "__$seqval"])
        if batch == 2:
            table.compact()
    return table.read()


@query("load_file_bounds", """SELECT event_id, ts, (SELECT max(ts) FROM events) AS high, TRUE AS skipped FROM events
 WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-12'""")
def _(t):
    # Events arrive in batches by time; the window's plan has only the files whose bounds overlap it.
    table = FileTable(t.spark, t.scratch("events"), "ts")
    rows = t.events.select("event_id", "ts").repartitionByRange(8, "ts")
    table.append(rows, 1)
    table.append(rows, 1)
    window = table.window("2024-01-10", "2024-01-12")
    skipped = len(window.inputFiles()) < table.files().count()
    return window.select("event_id", "ts", F.lit(table.high_water()).cast("timestamp_ntz").alias("high"), F.lit(skipped).alias("skipped"))


@query("load_at_once", """SELECT 'load' AS job, o_orderkey AS id, o_totalprice AS v, TRUE AS refused FROM orders UNION ALL
 SELECT 'zone', event_id, NULL, TRUE FROM events""")
def _(t):
    """Two runs of one object and of one zone, each pair started from the same state: one is refused, the other's rows stand once."""
    ledger, root = audit.Ledger(t.spark, t.scratch("ledger")), t.scratch("at_once")
    spec = loads.LoadSpec(1, "orders", keys=["o_orderkey"])
    orders = t.orders.select("o_orderkey", "o_totalprice")
    control = t.region.limit(1).select(F.lit(1).alias("Controlid"), F.lit("events").alias("SourceObjectName"), F.lit("gold").alias("DestinationZone"),
                                       F.lit("ts").alias("IncrementalColumn"), F.lit(None).cast("timestamp_ntz").alias("LastWatermarkValue"))
    sources = {"events": t.events.select("event_id", "ts")}
    refused = [_refused(ledger, lambda batch: loads.run_load(ledger, orders, spec, root, batch, NOW1)),
               _refused(ledger, lambda batch: loads.load_zone(control, sources, "gold", root, batch, ledger))]
    loaded = loads.current_table(ledger, spec).select(F.lit("load").alias("job"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"),
                                                     F.lit(refused[0]).alias("refused"))
    zone = loads.zone_table(ledger, "gold", "events")
    return loaded.union(zone.select(F.lit("zone"), "event_id", F.lit(None).cast("double"), F.lit(refused[1])))


def _refused(ledger, run):
    """Whether a run is refused that another one overtakes between its write and its commit."""
    complete = ledger.complete

    def overtaken(run_id, **counts):
        ledger.complete = complete
        run(2)
        return complete(run_id, **counts)

    ledger.complete = overtaken
    try:
        run(1)
        return False
    except Conflict:
        return True


@query("stream_base_delta", """SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS event_type FROM events GROUP BY user_id""")
def _(t):
    """Micro-batches as deltas of a keyed table, folded in at the end."""
    table = KeyedTable(t.spark, t.scratch("users"), ["user_id"], parts=4)
    rows = t.events.select("user_id", "event_type", "ts", "event_id")
    table.create(rows.select("user_id", "event_type").limit(0))
    folder, path = t.scratch("in"), t.scratch("checkpoint")
    first, second = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz")
    for part in (F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second):
        rows.where(part).coalesce(1).write.mode("append").parquet(folder)
    source = ingest.stream_source(t.spark, "parquet", rows.schema, folder, maxFilesPerTrigger="1")
    ingest.stream_into(source, table, ["ts", "event_id"], path, available_now=True).awaitTermination()
    table.compact()
    return table.read()


@query("src_new_files", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, 3 AS first, 0 AS again, 1 AS changed
 FROM orders""")
def _(t):
    """A tree of one file for each status, read three times: all files, none, and the one that has changed."""
    tree, schema = t.scratch("tree"), T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])

    def put(status, rows):
        rows.select("o_orderkey", "o_totalprice").coalesce(1).write.mode("overwrite").csv(f"{tree}/{status}", header=True)

    for status in ("F", "O", "P"):
        put(status, t.orders.filter(F.col("o_orderstatus") == status))
    table = FileIngest(t.spark, t.scratch("ingested"), schema)
    counts = [table.run(tree, "*.csv"), table.run(tree, "*.csv")]
    put("F", t.orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1))
    counts.append(table.run(tree, "*.csv", mirror=True))  # the old file is gone, the new one has another name
    return table.read().select("o_orderkey", "o_totalprice", *[F.lit(n).alias(c) for n, c in zip(counts, ("first", "again", "changed"))])


@query("dq_checked_load", """SELECT 'orders' AS part, o_orderkey, NULL AS failed_rules FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice >= 50000
 UNION ALL SELECT 'quarantine', o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'malformed' END,
 CASE WHEN o_orderstatus <> 'P' AND o_totalprice < 50000 OR o_orderstatus = 'P' THEN 'price' END) FROM orders WHERE o_orderstatus = 'P' OR o_totalprice < 50000""")
def _(t):
    # Pending orders land with text where the price belongs; small orders break a rule. One pass counts, routes and publishes.
    price = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.col("o_totalprice").cast("string"))
    path, wanted = t.scratch("dirty"), t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    wanted.withColumn("o_totalprice", price).write.csv(path, header=True)
    table = CheckedTable(t.spark, t.scratch("checked"))
    rules = Rules({"price": F.col("o_totalprice") >= 50000}, required=("o_orderkey",), limits={"o_orderstatus": 1}, unique=("o_orderkey",), budget=0.99)
    report = table.load(lines(t.spark, path, wanted.schema), rules, 1)
    assert table.load(wanted, rules, 1) is None and report["rows"] == sum(p.count() for p in (table.read(), table.quarantine(report)))
    good = table.read().select(F.lit("orders").alias("part"), "o_orderkey", F.lit(None).cast("string").alias("failed_rules"))
    return good.union(table.quarantine(report).select(F.lit("quarantine"), "o_orderkey", F.array_join("failed_rules", ",")))


@query("sink_refreshed_agg", """SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(DISTINCT o_orderpriority) AS priorities,
 min(o_orderpriority) AS first, max(o_orderpriority) AS last FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey""")
def _(t):
    # Loaded: finished and open orders. Then pending ones come and finished ones go.
    kept = RefreshedAggregate(t.spark, t.scratch("totals"), ["o_custkey"], Measures({"total": "o_totalprice"}, {"priority": "o_orderpriority"}), parts=8)
    orders = t.orders.select("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    none = orders.limit(0)
    kept.refresh(weighted(orders.filter("o_orderstatus <> 'P'"), none), 1)
    for batch in (2, 2):
        kept.refresh(weighted(orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus = 'F'")), batch)
    return kept.read().select("o_custkey", F.col("n_rows").alias("n"), as_double("total").alias("total"), F.col("priority_distinct").alias("priorities"),
                              F.col("priority_min").alias("first"), F.col("priority_max").alias("last"))


@query("sink_switched_ranges", """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN 0.0 ELSE o_totalprice END AS o_totalprice, TRUE AS others_kept
 FROM orders WHERE year(o_orderdate) <> 1997""")
def _(t):
    # 1996 is replaced, 1997 dropped; the files of the other ranges keep their names.
    bounds = [datetime(y, 1, 1) for y in (1996, 1997, 1998, 1999)]
    table = RangeTable(t.spark, t.scratch("ranges"), "o_orderdate", bounds)
    orders = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    table.append(orders, 1)
    before = table.files().select("part", "file").collect()
    table.switch(1, orders.filter("year(o_orderdate) = 1996").withColumn("o_totalprice", F.lit(0.0)))
    table.switch(2)
    after = {r[0] for r in table.files().select("file").collect()}
    kept = {r.file for r in before} & after == {r.file for r in before if r.part not in (1, 2)}
    return table.between().select("o_orderkey", "o_totalprice", F.lit(kept).alias("others_kept"))


@query("stream_unique_messages", MESSAGES_SQL + """ UNION ALL SELECT 'malformed', NULL, CAST(count(*) AS VARCHAR), NULL, NULL FROM events WHERE event_type = 'view'""")
def _(t):
    # Every message comes twice in the first run and once more after a restart; view events also send a cut-off body, in the first run alone.
    folder, path, checkpoint = t.scratch("in"), t.scratch("landed"), t.scratch("checkpoint")
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("messageid"), F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("device_id"),
                              F.col("event_type").alias("temperature"), F.col("user_id").cast("string").alias("humidity"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp")))
    whole = t.events.select(body.alias("body"))
    cut = t.events.filter("event_type = 'view'").select(F.lit('{"messageid": "1').alias("body"))
    for sent in (whole.union(whole).union(cut), whole):
        sent.write.mode("append").parquet(folder)
        source = ingest.stream_source(t.spark, "parquet", sent.schema, folder)
        for landing in ingest.land_messages(source, DEVICE_MESSAGES, "messageid", "timestamp", "60 days", path, checkpoint, available_now=True):
            landing.awaitTermination()
    good = t.spark.read.schema(DEVICE_MESSAGES).parquet(f"{path}/messages")
    bad = t.spark.read.schema("malformed_body string").parquet(f"{path}/malformed")
    nothing = F.lit(None).cast("string")
    return good.union(bad.agg(F.count("*").cast("string").alias("n")).select(F.lit("malformed"), nothing, "n", nothing, nothing))
