"""Whole load jobs: write new content to a fresh folder, then publish it by a numbered commit and record the run.

Readers ask the ledger for the folder of the last commit, so a job that dies at any point leaves the
previous content in force, and running it again gives the same result. Of two runs that started from the same commit one is refused.

A source may be a ``tables.files.FileTable``: then bounds come from its zone map and a window opens only the files that overlap it.
"""

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ledger.audit import resolve_low, with_audit
from ..operators.incremental import advance, control_for, extract, high_water, incremental, metadata_columns, null_watermarks
from ..operators.quality import resolve_column
from ..operators.upsert import (
    business_columns,
    change_counts,
    full_reload,
    hash_upsert,
    one_per_key,
    stamp_audit_cols,
)
from ..sources.paths import exists, list_names
from ..sources.readers import read_parquet, run_entities
from ..tables.commits import Conflict
from ..tables.files import FileTable
from ..tables.keyed import KeyedTable

CHANGE = "_change"


@dataclass
class LoadSpec:
    """One object to load: its control id, key, watermark column and column list."""

    control_id: int
    name: str
    keys: list = field(default_factory=list)
    watermark: str | None = None
    columns: list | None = None
    blank_cols: tuple = ()
    order: list | None = None
    lookback_days: int = 0
    mark_deleted: bool = False
    parts: int | None = None  # store a keyed target in so many parts by key, of which a load rewrites those it touches


def keyed_target(ledger, spec, root):
    """The target of an object that is stored in parts."""
    return KeyedTable(ledger.spark, f"{root}/{spec.name}", spec.keys, spec.parts)


def current_table(ledger, spec):
    """Content published by the last commit, or None."""
    path = ledger.last_sink(spec.control_id)
    if path and spec.parts:
        return KeyedTable(ledger.spark, path, spec.keys, spec.parts).read()
    return read_parquet(ledger.spark, path).drop(CHANGE) if path else None


# A source's window: from the zone map of a table of files, else from a scan of the watermark column.


def _columns_of(source):
    return source.scan(source.files().limit(0)) if isinstance(source, FileTable) else source


def _high(source, column):
    return source.high_water() if isinstance(source, FileTable) else high_water(source, column)


def _unmarked(source, column):
    return source.null_watermarks() if isinstance(source, FileTable) else null_watermarks(source, column).count()


def _window(source, column, low, high, lookback_days=0):
    if isinstance(source, FileTable):
        return source.window(low, high, lookback_days=lookback_days)
    return incremental(source, column, low, high, lookback_days=lookback_days)


def _whole(source):
    return source.read() if isinstance(source, FileTable) else source


def last_bound(ledger, spec, dtype):
    """High bound of the last run with rows, compared as the watermark's type; None before the first. Both the runs and the commits are
    asked, as a run may die between its commit and its last event."""
    runs = ledger.runs().filter((F.col("ETLControlID") == spec.control_id) & F.col("IsLoadSuccess")
                                & (F.col("RowsInserted") + F.col("RowsUpdated") > 0))
    told = runs.agg(F.max(F.col("ETLMaxValue").try_cast(dtype))).first()[0]
    return max((b for b in (told, ledger.high_mark(spec.control_id, dtype)) if b is not None), default=None)


def wanted_columns(spec, rows):
    """Listed columns and, for choosing among repeated keys, the order columns."""
    if spec.columns is None:
        return None
    return list(dict.fromkeys([*spec.columns, *(spec.order or [])]))


def run_load(ledger, source, spec, root, batch_id, now, bounds=None, audit=None):
    """Extract, upsert or reload, publish, record. Returns the completed counts.

    ``bounds`` = (low, high) makes it an ad-hoc load of that window, a low bound of None being open. ``audit`` adds fields to the
    run's events, such as PipelineName, ActivityID and ActivityName. Objects without both key and
    other columns are reloaded whole, so their watermark is not used. The first load has no low bound. Rows without a
    watermark can never be picked by a window; their number is recorded with the run.
    A run publishes as the successor of the commit it started from, so a run that finds another one published since refuses. Its counts come from the
    write: from the written folder's own label column, read back as one column, or with ``spec.parts`` from metrics of the write.
    """
    spark, log = ledger.spark, ledger.commits(spec.control_id)
    version, _ = log.last()
    base = ledger.last_sink(spec.control_id)
    target = read_parquet(spark, base).drop(CHANGE) if base and not spec.parts else None
    columns = _columns_of(source)
    keep = spec.columns or columns.columns
    keyed = bool(spec.keys and set(business_columns(columns.select(*keep))) - set(spec.keys))
    windowed = bool(keyed and spec.watermark)
    if windowed and spec.mark_deleted:
        raise ValueError("a window of the source cannot tell which target rows were deleted")
    low = high = None
    if windowed:
        column = resolve_column(columns, spec.watermark)
        if column is None:
            raise KeyError(f"{spec.name} has no watermark column {spec.watermark!r}")
        if isinstance(source, FileTable) and source.watermark != column:
            raise ValueError(f"the zone map of {spec.name} is over {source.watermark!r}, not {column!r}")
        dtype = columns.schema[column].dataType
        if bounds:
            low, high = bounds
        else:
            low = last_bound(ledger, spec, dtype) if base else None
            high = _high(source, column)
    kind = "Adhoc" if windowed and bounds else "Incremental" if windowed else "Full"
    window = {k: None if v is None else str(v) for k, v in (("ETLMinValue", low), ("ETLMaxValue", high))}
    fields = {"ETLControlID": spec.control_id, "ETLBatchID": batch_id, "Source": spec.name, "LoadType": kind} | window | (audit or {})
    with with_audit(ledger, **fields) as counts:
        if windowed:
            counts["RowsWithoutWatermark"] = _unmarked(source, column)
            rows = _window(source, column, low, high, spec.lookback_days)
        else:
            rows = _whole(source)
        rows = extract(rows, columns=wanted_columns(spec, rows), blank_cols=spec.blank_cols)
        content = {"batch": batch_id, "high": window["ETLMaxValue"] if kind == "Incremental" else None}
        if keyed and spec.parts:
            table = keyed_target(ledger, spec, root)
            rows = rows.select(*dict.fromkeys([*keep, *(spec.order or [])]))
            path, found = table.path, table.upsert(rows, batch_id, now, order=spec.order, mark_deleted=spec.mark_deleted)
        else:
            # A folder of its own per attempt: a repeated batch never writes over the one it reads.
            path = f"{root}/{spec.name}/batch_{batch_id}-{uuid.uuid4().hex[:8]}"
            if not keyed:
                written = full_reload(rows.select(*keep), batch_id, now).withColumn(CHANGE, F.lit("insert"))
            elif target is None:
                first = one_per_key(rows, spec.keys, spec.order).select(*keep)
                written = stamp_audit_cols(first, batch_id, now).withColumn(CHANGE, F.lit("insert"))
            else:
                written = hash_upsert(target, rows, spec.keys, batch_id, now, order=spec.order,
                                      mark_deleted=spec.mark_deleted, label=CHANGE)
            written.write.mode("errorifexists").parquet(path)
            found = change_counts(spark.read.parquet(path).select(CHANGE), CHANGE).first().asDict()
        counts |= found | {"Sink": path, "publish": lambda: log.commit(version, content | {"sink": path, "rows": found})}
        if ledger.last_sink(spec.control_id) != base:
            raise Conflict(f"another run published {spec.name} in the meantime")
    return counts


def run_control(ledger, source, control, root, batch_id, now, keys=(), version=None, audit=None, **options):
    """Load one object as its control row says: bounds from the ledger, columns from its metadata, upsert, publish, record.

    ``control`` is one row in the form of ``ledger.control.control_rows`` with an ``ETLControlID``. Its DeltaDetect names the
    watermark column of a Predicate load; ``version`` is the column that holds the version of a ChangeTracking load.
    AdhocMin and AdhocMax of an Adhoc row are its window. An inactive row loads nothing and returns None.
    """
    row = control.first().asDict()
    if row.get("IsActive") is False:
        return None
    kind, watermark = row.get("DeltaDetectType"), None
    if kind == "Predicate":
        watermark = next((d["QueryPredicate"] for d in json.loads(row["DeltaDetect"]) if d.get("QueryPredicate")), None)
    elif kind == "ChangeTracking":
        watermark = version
    spec = LoadSpec(row["ETLControlID"], row.get("Name") or f"object_{row['ETLControlID']}", list(keys), watermark,
                    metadata_columns(row.get("ColumnMetaData")), **options)
    bounds = None
    if watermark:
        column = resolve_column(_columns_of(source), watermark)
        high = _high(source, column)
        asked = ledger.spark.createDataFrame([(row["ETLControlID"], row["LoadType"], kind, "DATE" if kind == "Predicate" and not isinstance(
            _columns_of(source).schema[column].dataType, T.NumericType) else "", None if high is None else str(high), row.get("AdhocMin"), row.get("AdhocMax"))],
            "ETLControlID bigint, LoadType string, DeltaDetectType string, DeltaDetect string, ETLMaxValue string, AdhocMin string, AdhocMax string")
        found = resolve_low(ledger.runs(), asked).first()
        # before any run and in a full load nothing is too old to load
        opened = row["LoadType"] != "Adhoc" and (row["LoadType"] == "Full" or ledger.last_sink(spec.control_id) is None)
        bounds = (None if opened else found["ETLMinValue"], high if row["LoadType"] != "Adhoc" else found["ETLMaxValue"])
    return run_load(ledger, source, spec, root, batch_id, now, bounds, {"DeltaDetectType": kind, "LoadType": row["LoadType"], **(audit or {})})


def bronze_to_silver(spark, base, silver, registry, batch_id, log=print):
    """Clean every file of the newest folder of every entity and store it as one batch. Returns rows per entity file.

    A file's batch lies under its entity folder and file name, so files of one stem do not replace each other. Each is scanned
    once: the count is taken while writing.
    """
    return {f"{entity}/{name}": observed_write(df, f"{silver}/{stem}/batch_id={batch_id}/entity={entity}/file={name}")["rows"]
            for entity, stem, name, df in run_entities(spark, base, registry, log)}


def read_batches(spark, path, batch_id=None):
    """All stored batches of an entity, or one, without the columns that name their folders."""
    rows = read_parquet(spark, path)
    rows = rows if batch_id is None else rows.filter(F.col("batch_id") == batch_id)
    return rows.drop("batch_id", "entity", "file")


def latest_batch(spark, path):
    """The last finished batch of an entity, for entities that arrive as whole snapshots. A batch without its writers' success
    marks does not count."""
    ids = sorted((int(n.partition("=")[2]) for n in list_names(spark, path) if n.startswith("batch_id=")), reverse=True)
    for batch_id in ids:
        folder = f"{path}/batch_id={batch_id}"
        files = [f"{folder}/{e}/{f}" for e in list_names(spark, folder) if e.startswith("entity=") for f in list_names(spark, f"{folder}/{e}")]
        if files and all(exists(spark, f"{f}/_SUCCESS") for f in files):
            return read_batches(spark, path, batch_id)
    raise FileNotFoundError(f"no finished batch under {path}")


def load_zone(control, sources, zone, root, batch_id, ledger, full=()):
    """Load all objects of a zone. Returns the advanced control rows and a report per object: status, rows, rows without watermark.

    Objects in ``full`` are replaced. The others load the window after their control row's watermark or the ledger's, whichever
    is later; one without a control row, watermark column or new rows is skipped and says why. Each object's folder counts from
    its commit, which also holds the watermark, so neither a crash between data and watermark nor a lost control table doubles rows. A run that
    finds another one's commit raises a ``Conflict`` and leaves that commit in force.
    """
    report = {}
    for name, df in sources.items():
        source, folder = f"{zone}.{name}", f"{root}/{name}/batch_{batch_id}-{uuid.uuid4().hex[:8]}"
        if name in full:
            report[name] = ("loaded", full_load(_whole(df), folder, batch_id, ledger, source)[1], 0)
            continue
        row, columns = control_for(control, name, zone), _columns_of(df)
        column = row and resolve_column(columns, row["IncrementalColumn"])
        if not column:
            report[name] = ("no control row" if row is None else f"no column {row['IncrementalColumn']}", 0, 0)
            continue
        dtype, log = columns.schema[column].dataType, ledger.commits(source)
        version, _ = log.last()  # read before the mark, so that a later commit is a conflict
        marks = [m for m in (row["LastWatermarkValue"], ledger.high_mark(source, dtype)) if m is not None]
        high, unmarked = _high(df, column), _unmarked(df, column)
        last = max(marks, default=None)
        fresh = None if high is None else _window(df, column, last, high)
        if fresh is None or fresh.isEmpty():
            report[name] = ("no new rows", 0, unmarked)
            continue
        with with_audit(ledger, ETLBatchID=batch_id, Source=source, LoadType="Incremental", ETLMinValue=None if last is None else str(last),
                        ETLMaxValue=str(high)) as counts:
            rows = observed_write(fresh, folder)["rows"]
            content = {"sink": folder, "high": str(high), "batch": batch_id, "rows": rows}
            counts |= {"RowsInserted": rows, "RowsWithoutWatermark": unmarked, "Sink": folder,
                       "publish": lambda log=log, version=version, content=content: log.commit(version, content)}
        control = advance(control, row["SourceObjectName"], high, "SourceObjectName", "LastWatermarkValue",
                          F.col("DestinationZone") == row["DestinationZone"])
        report[name] = ("loaded", rows, unmarked)
    return control, report


def zone_table(ledger, zone, name, whole=False):
    """What was published of a zone's object: all windows, or of an object that is replaced the last folder."""
    folders = ledger.published(f"{zone}.{name}")
    if not folders:
        raise FileNotFoundError(f"nothing published of {zone}.{name}")
    return ledger.spark.read.parquet(*(folders[-1:] if whole else folders))


def fold_zone(ledger, zone, name, root, batch_id):
    """Write all published windows of an object to one folder that replaces theirs, so that readers open one. Returns its rows."""
    source, log = f"{zone}.{name}", ledger.commits(f"{zone}.{name}")
    version, content = log.last()
    folder = f"{root}/{name}/folded_{batch_id}-{uuid.uuid4().hex[:8]}"
    with with_audit(ledger, ETLBatchID=batch_id, Source=source, LoadType="Fold") as counts:
        rows = observed_write(zone_table(ledger, zone, name), folder)["rows"]
        counts |= {"Sink": folder, "publish": lambda: log.commit(version, content | {"sink": folder, "replaces": True, "batch": batch_id, "rows": rows})}
    return rows


def observed_write(df, path, **metrics):
    """Write and count in the same job; returns the metric values."""
    watch = Observation()
    watched = df.observe(watch, *[m.alias(n) for n, m in ({"rows": F.count(F.lit(1))} | metrics).items()])
    watched.write.mode("overwrite").parquet(path)
    return watch.get


def full_load(df, path, batch_id, ledger=None, source=None):
    """Replace a table by the whole source: a folder of its own, counted while written, current once it is committed."""
    if ledger is None:
        return path, observed_write(df, path)["rows"]
    log = ledger.commits(source)
    version, _ = log.last()
    with with_audit(ledger, ETLBatchID=batch_id, Source=source, LoadType="Full") as counts:
        rows = observed_write(df, path)["rows"]
        counts |= {"RowsInserted": rows, "Sink": path,
                   "publish": lambda: log.commit(version, {"sink": path, "replaces": True, "batch": batch_id, "rows": rows})}
    return path, rows


__all__ = ["LoadSpec", "bronze_to_silver", "current_table", "fold_zone", "full_load", "keyed_target", "last_bound", "latest_batch", "load_zone",
           "observed_write", "read_batches", "run_control", "run_load", "zone_table"]
