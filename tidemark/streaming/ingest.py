"""Ingest of message streams and change streams.

Parsing is row by row, and a change stream lands as per-batch folders or deltas that a batch job merges, so the cost of a micro-batch
follows the batch and not the target. Only ``unique_messages`` keeps state, and forgets it as the watermark moves on.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import parse_json
from ..operators.project import cast_cols
from ..operators.upsert import hash_upsert, one_per_key


def stream_source(spark, fmt, schema=None, path=None, **options) -> DataFrame:
    """Subscribe to a stream: files here, any connector on the class path in production."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def parse_stream(sdf, schema, body="body") -> DataFrame:
    """JSON message bodies (bytes or text) to columns; malformed ones give NULL fields."""
    return sdf.select(parse_json(F.col(body), schema).alias("data")).select("data.*")


#: Column of a message that could not be read: its text.
MALFORMED = "malformed_body"


def split_stream(sdf, schema, body="body", id_col=None, time_col=None) -> tuple[DataFrame, DataFrame]:
    """(messages, malformed): JSON bodies that fit the schema as columns, and the others as they came.

    A body is malformed if it is no JSON of that schema, is NULL, lacks the ``id_col`` or has no readable time in ``time_col``.
    """
    full = T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])
    text = F.col(body).cast("string")
    read = sdf.select(F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}).alias("data"), text.alias("text"))
    whole = F.col("data").isNotNull() & F.col(f"data.{MALFORMED}").isNull()
    whole = whole & F.col(f"data.{id_col}").isNotNull() if id_col else whole
    whole = whole & F.col(f"data.{time_col}").try_cast("timestamp").isNotNull() if time_col else whole
    return read.where(whole).select("data.*").drop(MALFORMED), read.where(~F.coalesce(whole, F.lit(False))).select(F.col("text").alias(MALFORMED))


def unique_messages(sdf, id_col, time_col, delay) -> DataFrame:
    """Each message once, also when it comes again in a later micro-batch or after a restart.

    The ids are state that the checkpoint keeps for ``delay`` of event time past a message, which bounds it by the messages of that span. Messages
    that come more than ``delay`` behind the latest one may be left out by the watermark, so choose it above the source's lateness. ``time_col`` is cast to an
    instant where it is text or has no zone, and must be readable.
    """
    timed = sdf.withColumn("__at", F.col(time_col).cast("timestamp"))
    return timed.withWatermark("__at", delay).dropDuplicatesWithinWatermark([id_col]).select(sdf.columns)


def land_messages(sdf, schema, id_col, time_col, delay, path, checkpoint, body="body", available_now=False):
    """Two streams over one source: unique messages to ``<path>/messages``, malformed bodies to ``<path>/malformed``. Returns both queries."""
    good, bad = split_stream(sdf, schema, body, id_col, time_col)
    return (stream_to_parquet(unique_messages(good, id_col, time_col, delay), f"{path}/messages", f"{checkpoint}/messages", available_now),
            stream_to_parquet(bad, f"{path}/malformed", f"{checkpoint}/malformed", available_now))


def stream_to_parquet(sdf, path, checkpoint, available_now=False):
    """Append to parquet; the checkpoint and the sink's own log make a restart exactly-once."""
    writer = (sdf.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", path))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def typed(df, mapping) -> DataFrame:
    """Typed view of landed text columns; text that does not fit becomes NULL."""
    return cast_cols(df, mapping, safe=True)


def stream_changes(sdf, path, keys, order, checkpoint, available_now=False):
    """Land the last change per key of each micro-batch in its own folder.

    The folder is named by the batch id, so a batch that runs twice is stored once.
    """
    def land(batch, batch_id):
        last = one_per_key(batch, list(keys), list(order))
        last.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = sdf.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_into(sdf, table, order, checkpoint, op_col=None, source="stream", available_now=False):
    """Land each micro-batch as a delta of a ``tables.keyed.KeyedTable``.

    A batch costs what it holds: neither the table nor earlier batches are read. One that runs twice is stored once, also after
    ``table.compact`` has folded it in. ``order`` decides inside a batch; batches count in their order. ``source`` names the stream: give each
    stream that feeds a table its own, and a new one to a stream that starts from a new checkpoint.
    """
    def land(batch, batch_id):
        table.apply(batch, batch_id, list(order), op_col=op_col, source=source)

    writer = sdf.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_upsert(target, changes, keys, order, batch_id, now, **options) -> DataFrame:
    """Merge landed changes into a target: the last change per key over all micro-batches wins."""
    last = one_per_key(changes, list(keys), [*order, "batch_id"]).drop("batch_id")
    return hash_upsert(target, last, list(keys), batch_id, now, unique_source=True, **options)
