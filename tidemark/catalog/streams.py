"""Streams over the event files: each query runs what is available, then reads the result."""

from pyspark.sql import functions as F

from ..operators.upsert import stamp_audit_cols
from ..schemas import DEVICE_MESSAGES, TYPED_MESSAGES
from ..streaming import ingest
from .base import query

NOW1, NOW2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"

MESSAGES_SQL = """SELECT CAST(event_id AS VARCHAR) AS messageid, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS device_id,
 event_type AS temperature, CAST(user_id AS VARCHAR) AS humidity, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM events"""


def _events(t):
    """The event files as a stream; the pattern fits a single file as well as a folder of files."""
    return ingest.stream_source(t.spark, "parquet", t.events.schema, f"{t.folder}/event[s].parquet")


def _messages(t):
    """Events as JSON message bodies; errors carry no device."""
    body = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("messageid"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("device_id"),
        F.col("event_type").alias("temperature"), F.col("user_id").cast("string").alias("humidity"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp")))
    return _events(t).select("event_id", F.encode(body, "UTF-8").alias("body"))


def _landed(t, sdf, starts=1):
    """Run a stream to its end, ``starts`` times over one checkpoint, and read what it wrote."""
    path, checkpoint = t.scratch("landed"), t.scratch("checkpoint")
    for _ in range(starts):
        ingest.stream_to_parquet(sdf, path, checkpoint, available_now=True).awaitTermination()
    return t.spark.read.schema(sdf.schema).parquet(path)


@query("src_stream", "SELECT event_id, octet_length(encode(event_type)) > 0 AS has_body FROM events")
def _(t):
    return _landed(t, _messages(t)).select("event_id", (F.octet_length("body") > 0).alias("has_body"))


@query("sink_stream_parquet", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def _(t):
    return _landed(t, _events(t))


@query("stream_parse_json", MESSAGES_SQL + """ UNION ALL SELECT NULL, NULL, NULL, NULL, NULL FROM events WHERE event_type = 'view'""")
def _(t):
    # View events also send a cut-off message, which parses to NULL fields.
    whole = _messages(t).select("body")
    cut = _events(t).filter("event_type = 'view'").select(F.encode(F.lit('{"messageid": "1'), "UTF-8").alias("body"))
    return _landed(t, ingest.parse_stream(whole.union(cut), DEVICE_MESSAGES))


@query("stream_append_parquet", MESSAGES_SQL)
def _(t):
    # The second start finds the checkpoint and adds nothing.
    return _landed(t, ingest.parse_stream(_messages(t), DEVICE_MESSAGES), starts=2)


@query("stream_typed_read", """SELECT CAST(event_id AS VARCHAR) AS messageid, CAST(NULL AS DOUBLE) AS temperature,
 CAST(user_id AS DOUBLE) AS humidity, date_trunc('second', ts) AS timestamp FROM events""")
def _(t):
    landed = _landed(t, ingest.parse_stream(_messages(t), DEVICE_MESSAGES))
    return ingest.typed(landed, TYPED_MESSAGES).drop("device_id")


@query("stream_upsert", """WITH latest AS (SELECT user_id, arg_max(value, ROW(ts, event_id)) AS v FROM events GROUP BY user_id)
 SELECT coalesce(user_id, c_custkey) AS c_custkey, coalesce(v, c_acctbal) AS c_acctbal,
 CASE WHEN user_id IS NULL THEN 'kept' WHEN c_custkey IS NULL THEN 'insert' ELSE 'update' END AS change
 FROM (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') FULL JOIN latest ON user_id = c_custkey""")
def _(t):
    path, checkpoint = t.scratch("changes"), t.scratch("checkpoint")
    changes = _events(t).select(F.col("user_id").alias("c_custkey"), F.col("value").alias("c_acctbal"), "ts", "event_id")
    ingest.stream_changes(changes, path, ["c_custkey"], ["ts", "event_id"], checkpoint, available_now=True).awaitTermination()
    target = stamp_audit_cols(t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal"), 1, NOW1)
    merged = ingest.stream_upsert(target, t.spark.read.parquet(path), ["c_custkey"], ["ts", "event_id"], 2, NOW2, label="change")
    return merged.select("c_custkey", "c_acctbal", "change")
