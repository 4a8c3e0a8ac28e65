"""Append-only audit events. A run's state is its last event."""

import time
from contextlib import contextmanager
from datetime import datetime, timezone
from decimal import Decimal
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import seconds_between, shift_days
from ..operators.incremental import FIRST_WATERMARK
from ..schemas import AUDIT_EVENTS
from ..session import settle
from ..sources.paths import exists
from ..tables.commits import CommitLog, Conflict

# Load states.
STARTED, COMPLETED, FAILED = "Started", "Completed", "Failed"


def _utc_now():
    return datetime.now(timezone.utc).replace(tzinfo=None)


def current_runs(events) -> DataFrame:
    """The last event of each run."""
    state = F.struct(*[c for c in events.columns if c != "ETLAuditLogID"])
    last = events.groupBy("ETLAuditLogID").agg(F.max_by(state, F.struct("EventTime", F.col("LoadStatus") != STARTED)).alias("s"))
    return last.select("ETLAuditLogID", "s.*")


def completed_fields(status, start, end, size_bytes=None):
    """Run time in seconds and throughput in kilobits per second of a finished run."""
    seconds = seconds_between(start, end)
    out = {"RunTimeInSecond": seconds, "LoadStatus": F.lit(status), "IsLoadSuccess": F.lit(status == COMPLETED)}
    if size_bytes is not None:
        rate = size_bytes * F.lit(8.0) / F.lit(1000.0) / F.nullif(seconds.cast("double"), F.lit(0.0))
        out["ThroughputInKbps"] = rate.try_cast("decimal(20,2)")
    return out


class Ledger:
    """Audit events of loads, kept as parquet files under ``path``, and for each object a log of commits that name what was published.

    The commit decides: it can be made once for each predecessor, so of two runs that build on the same state one is refused. The event that
    follows reports it.
    """

    def __init__(self, spark, path, clock=_utc_now):
        self.spark, self.path, self.clock = spark, path, clock

    def events(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], AUDIT_EVENTS)
        return self.spark.read.schema(AUDIT_EVENTS).parquet(self.path)

    def runs(self) -> DataFrame:
        return current_runs(self.events())

    def _write(self, event):
        row = [event.get(f.name) for f in AUDIT_EVENTS.fields]
        self.spark.createDataFrame([row], AUDIT_EVENTS).coalesce(1).write.mode("append").parquet(self.path)
        return event

    def start(self, **fields) -> int:
        now, run_id = self.clock(), time.time_ns()
        self._write({"ETLStartTime": now, **fields, "ETLAuditLogID": run_id, "LoadStatus": STARTED,
                     "IsLoadSuccess": False, "EventTime": now})
        return run_id

    def _finish(self, run_id, status, fields):
        # One control row; never data.
        begun = self.events().filter((F.col("ETLAuditLogID") == run_id) & (F.col("LoadStatus") == STARTED)).first()
        if begun is None:
            raise KeyError(f"no started run {run_id}")
        now = self.clock()
        event = {k: v for k, v in begun.asDict().items() if v is not None} | fields
        event |= {"ETLEndTime": now, "EventTime": now, "LoadStatus": status, "IsLoadSuccess": status == COMPLETED,
                  "RunTimeInSecond": int((now.replace(microsecond=0)
                                          - event["ETLStartTime"].replace(microsecond=0)).total_seconds())}
        if event.get("FileSizeInBytes") and event["RunTimeInSecond"]:
            rate = Decimal(event["FileSizeInBytes"]) * 8 / 1000 / event["RunTimeInSecond"]
            event["ThroughputInKbps"] = rate.quantize(Decimal("0.01"))
        return self._write(event)

    def complete(self, run_id, publish=None, **counts):
        """Publish, if there is something to publish (a function that commits), and record the end of the run."""
        if publish:
            publish()
        return self._finish(run_id, COMPLETED, {"IsStageLoaded": True, **counts})

    def fail(self, run_id, error):
        return self._finish(run_id, FAILED, {"ErrorMsg": str(error)})

    def commits(self, name) -> CommitLog:
        """The commits of one object: a control id or the name of a source."""
        return CommitLog(self.spark, f"{self.path}/_commits/{quote(str(name), safe='')}")

    def last_sink(self, control_id):
        """Folder the last commit of an object published, or None."""
        return (self.commits(control_id).last()[1] or {}).get("sink")

    def published(self, source):
        """Folders published for a named source, in order: all since it was last replaced. One short text for each run."""
        sinks = []
        for content in self.commits(source).backwards():
            sinks.append(content["sink"])
            if content.get("replaces"):
                break
        return sinks[::-1]

    def high_mark(self, source, dtype):
        """High bound of the last commit of a named source that had one, as ``dtype``, or None."""
        mark = next((c["high"] for c in self.commits(source).backwards() if c.get("high") is not None), None)
        return mark and self.spark.range(1).select(F.lit(mark).try_cast(dtype)).first()[0]


@contextmanager
def with_audit(ledger, **fields):
    """Wrap a job: start, then complete with the counts put in the yielded dict; an error is
    logged with its message and raised again. ``publish`` among the counts is called at the end and is what makes the result count."""
    run_id = ledger.start(**fields)
    counts = {}
    try:
        yield counts
    except Exception as error:
        ledger.fail(run_id, error)
        raise
    try:
        ledger.complete(run_id, **counts)
    except Conflict as error:
        ledger.fail(run_id, error)
        raise
    counts.pop("publish", None)


def successful(log) -> DataFrame:
    """Runs whose high bound counts: successful and with rows inserted."""
    return log.filter(F.col("IsLoadSuccess") & (F.col("RowsInserted") > 0))


def resolve_low(log, control, lookback_days=0) -> DataFrame:
    """Low and high bound of the next load of every control row.

    ``control`` has ETLControlID, LoadType, DeltaDetectType, DeltaDetect and the ETLMaxValue found
    at the source; AdhocMin/AdhocMax are used by ad-hoc loads. Full loads start from the beginning.
    Incremental ones continue at the highest bound of earlier successful runs; change-tracking
    versions count only since the last full load. A low bound not below the high bound resets.
    """
    dated = F.col("DeltaDetect").contains("DATE")
    full_start = F.max(F.when(F.col("LoadType") == "Full", F.col("ETLStartTime")))
    step_start = F.max(F.when(F.col("LoadType") == "Incremental", F.col("ETLStartTime")))
    anchors = log.groupBy("ETLControlID").agg(F.coalesce(full_start, step_start).alias("__since"))
    # Objects are few, their runs may be many: written first, the small side's size is known when the join is planned.
    anchors = settle(anchors, "anchors")
    good = successful(log).select("ETLControlID", "ETLMaxValue", "ETLStartTime").join(anchors, "ETLControlID", "left")
    version = F.when(F.col("ETLStartTime") >= F.col("__since"), F.col("ETLMaxValue").try_cast("bigint"))
    lows = good.groupBy("ETLControlID").agg(
        F.max(version).alias("__version"), F.max(F.col("ETLMaxValue").try_cast("timestamp_ntz")).alias("__time"),
        F.max(F.col("ETLMaxValue").try_cast("decimal(38,0)")).alias("__number"))
    text = "yyyy-MM-dd HH:mm:ss.SSS"
    first = F.lit(FIRST_WATERMARK).cast("timestamp_ntz")
    time_low = F.coalesce(F.date_format("__time", "yyyy-MM-dd HH:mm:ss").cast("timestamp_ntz"), first)
    time_low = F.when(F.col("__time").isNull(), first).otherwise(shift_days(time_low, -lookback_days))
    tracked, predicate = F.col("DeltaDetectType") == "ChangeTracking", F.col("DeltaDetectType") == "Predicate"
    full_low = F.when(tracked, "0").when(predicate, F.when(dated, F.date_format(first, text)).otherwise("0"))
    step_low = F.when(tracked, F.coalesce(F.col("__version"), F.lit(0)).cast("string")).when(
        predicate, F.when(dated, F.date_format(time_low, text))
        .otherwise(F.coalesce(F.col("__number").cast("string"), F.lit("0"))))
    low = F.when(F.col("LoadType") == "Full", full_low).otherwise(step_low)
    high = F.nullif(F.col("ETLMaxValue"), F.lit("-1"))
    guarded = F.when(reset_needed(low, high, dated & predicate), F.lit(FIRST_WATERMARK)).otherwise(low)
    adhoc = F.col("LoadType") == "Adhoc"
    adhoc_low, adhoc_high = (F.col(c) if c in control.columns else F.lit(None).cast("string")
                             for c in ("AdhocMin", "AdhocMax"))
    return control.join(lows, "ETLControlID", "left").select(
        "ETLControlID", "LoadType", "DeltaDetectType",
        F.when(adhoc, adhoc_low).otherwise(guarded).alias("ETLMinValue"),
        F.when(adhoc, adhoc_high).otherwise(high).alias("ETLMaxValue"))


def reset_needed(low, high, is_time):
    """Whether a low bound has reached its high bound, compared as times or as numbers."""
    return F.when(is_time, low.try_cast("timestamp_ntz") >= high.try_cast("timestamp_ntz")).otherwise(
        low.try_cast("decimal(38,0)") >= high.try_cast("decimal(38,0)"))
