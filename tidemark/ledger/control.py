"""Control rows: one per object to load."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditional import case
from ..functions.nested import build_json

# Parallelism units of a new control row, and the source type that means files.
DEFAULT_DIU = 2
FILE_SOURCE_TYPE = 3
# Notes by table type.
NOTES = {
    "Source": "Loading data from source to azure data lake storage",
    "Stage": "Loading data from azure data lake storage to staging tables",
    "Dimension": "Transformaing and Loading data from staging tables to Dimesnion tables",
    "Fact": "Transforming and Loading data from staging to fact tables",
}
# JSON groups and fields of a source and a sink description.
SOURCE_GROUPS = {
    "SQLSource": {"ServerName": "SourceServer", "DatabaseName": "SourceDatabase", "SchemaName": "SourceSchema",
                  "TableName": "SourceTable", "Host": "SourceHost", "ServiceName": "SourceServiceName"},
    "FileSource": {"FileServerHostName": "FileServerHostName", "FileRoot": "SourceFileRoot",
                   "FilePath": "SourceFilePath", "FileName": "SourceFileName", "FileDelimiter": "SourceFileDelimiter",
                   "FileQuoteCharacter": "SourceFileQuoteCharacter"},
    "APISource": {"HostName": "APISourceHost", "ServiceName": "APISourceServiceName",
                  "SourceFileName": "APISourceFileName"},
}
SINK_GROUPS = {
    "SQLSink": {"ServerName": "SinkServer", "DatabaseName": "SinkDatabase", "SinkSchema": "SinkSchema",
                "SinkTable": "SinkTable"},
    "FileSink": {"FileRoot": "SinkFileRoot", "FilePath": "SinkFilePath", "FileName": "SinkFileName"},
}
# Key of a control row, and what an update overwrites.
CONTROL_KEY = ["SourceSystem", "Source", "Sink"]
UPDATED_FIELDS = ["ColumnMetaData", "DeltaDetect", "DeltaDetectType", "MinExpression", "MaxExpression",
                  "SinkPreLoadScript", "SinkWriteBatchSize", "DIU", "SourceQuery", "TriggerType", "SourceTypeID",
                  "LoadType", "UpdatedDate", "IsDeletionRequired", "SourceTableCompositeKey", "SheetNames",
                  "ETLSourceTableID"]


def _opt(df, name):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def derive_control(spec, run_date) -> DataFrame:
    """Fill in load type, bound expressions, sink path and file name, and note."""
    kind = F.nullif(_opt(spec, "DeltaDetectType"), F.lit(""))
    table = F.coalesce(_opt(spec, "SourceTable"), _opt(spec, "SourceFileName"))
    plain = F.when(F.locate("/", table) > 0, F.expr("substring(replace(__table, '/', '_'), 2)")).otherwise(table)
    is_source = F.col("TableType") == "Source"
    files_from = F.coalesce(F.nullif(_opt(spec, "EarliestFileAvailableDate"), F.lit("")), F.lit(str(run_date)))
    out = spec.withColumn("__table", table).withColumns({
        "LoadType": F.when(kind.isNull(), "Full").otherwise("Incremental"),
        "MaxExpression": case([(kind == "Predicate", F.concat(F.lit("MAX("), _opt(spec, "QueryPredicate"), F.lit(")"))),
                               (kind == "ChangeTracking", "CHANGE_TRACKING_CURRENT_VERSION()"),
                               (kind.isNull(), "0")]),
        "MinExpression": F.when(is_source & (F.col("SourceTypeID") == FILE_SOURCE_TYPE),
                                F.date_format(files_from.cast("date"), "yyyy-MM-dd 00:00:00.000")),
        "SinkFilePath": F.when(is_source, F.coalesce(_opt(spec, "SinkFilePath"), F.concat(plain, F.lit("\\YYYY\\MM\\DD\\"))))
        .otherwise(_opt(spec, "SinkFilePath")),
        "SinkFileName": F.when(is_source, F.coalesce(_opt(spec, "SinkFileName"), F.concat(plain, F.lit("_*.parquet"))))
        .otherwise(_opt(spec, "SinkFileName")),
        "Note": case([(F.col("TableType") == k, v) for k, v in NOTES.items()]),
    })
    return out.drop("__table")


def _groups(df, groups):
    """JSON spec restricted to the fields the specification has."""
    present = {g: {k: c for k, c in fields.items() if c in df.columns} for g, fields in groups.items()}
    return {g: fields for g, fields in present.items() if fields}


def _once(spec) -> DataFrame:
    """The specification; reading it fails if it names a source and sink twice, which could not be merged."""
    names = [c for g in (SOURCE_GROUPS, SINK_GROUPS) for fields in g.values() for c in fields.values()]
    key = ["SourceSystem", *[c for c in [*dict.fromkeys(names), "SinkLoadProcedureName"] if c in spec.columns]]
    counts = spec.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.count("*").alias("__n"))
    same = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])
    repeated = F.raise_error(F.concat(F.lit("repeated specification of "), F.coalesce("SourceSystem", F.lit("NULL"))))
    checked = F.when(F.col("__n") > 1, repeated.cast("string")).otherwise(F.col("SourceSystem"))
    return spec.join(counts, same).select(*[checked.alias(c) if c == "SourceSystem" else F.col(c) for c in spec.columns])


def control_rows(spec, run_date, now) -> DataFrame:
    """Control rows with their Source, Sink and DeltaDetect JSON."""
    derived = derive_control(spec, run_date)
    derived = _once(derived.withColumns({c: _opt(derived, c) for c in ("DeltaDetectType", "SourceFileQuoteCharacter")}))
    # Fixed value: file sources without a quote character get an empty one.
    quote = F.when(F.col("SourceTypeID") == FILE_SOURCE_TYPE, F.coalesce("SourceFileQuoteCharacter", F.lit("")))
    derived = derived.withColumn("SourceFileQuoteCharacter", quote.otherwise(F.col("SourceFileQuoteCharacter")))
    predicate = F.col("DeltaDetectType") == "Predicate"
    delta = build_json({
        "QueryPredicate": F.when(predicate, _opt(derived, "QueryPredicate")),
        "QueryPredicateType": F.when(predicate, _opt(derived, "QueryPredicateType")),
        "CurrentVersion": F.when(F.col("DeltaDetectType") == "ChangeTracking", "CHANGE_TRACKING_CURRENT_VERSION()"),
        "No delta detect mechanism at source": F.when(F.col("DeltaDetectType").isNull(), ""),
    })
    system = F.when(F.col("TableType") == "DW", "Stage").otherwise(F.col("SourceSystem"))
    text = ["SinkLoadProcedureName", "ColumnMetaData", "TriggerType", "SourceQuery", "SourceTableCompositeKey", "SheetNames"]
    return derived.select(
        system.alias("SourceSystem"), build_json(_groups(derived, SOURCE_GROUPS)).alias("Source"),
        build_json(_groups(derived, SINK_GROUPS)).alias("Sink"), delta.alias("DeltaDetect"), "DeltaDetectType",
        *[_opt(derived, c).alias(c) for c in text],
        F.nullif(_opt(derived, "SinkPreLoadScript"), F.lit("")).alias("SinkPreLoadScript"),
        F.nullif(_opt(derived, "SinkWriteBatchSize").cast("int"), F.lit(0)).alias("SinkWriteBatchSize"),
        F.lit(DEFAULT_DIU).cast("short").alias("DIU"), "MinExpression", "MaxExpression", "LoadType", "TableType",
        F.col("SourceTypeID").cast("int").alias("SourceTypeID"),
        F.coalesce(_opt(derived, "IsActive").cast("boolean"), F.lit(True)).alias("IsActive"), "Note",
        F.lit(str(now)).cast("timestamp_ntz").alias("UpdatedDate"),
        _opt(derived, "IsDeletionRequired").cast("boolean").alias("IsDeletionRequired"),
        _opt(derived, "ETLSourceTableID").cast("long").alias("ETLSourceTableID"))


def register_source(control, rows, label=None) -> DataFrame:
    """MERGE control rows on (SourceSystem, Source, Sink, procedure), a missing procedure matching a missing one."""
    def prefixed(df, p):
        return df.select(*[F.col(c).alias(p + c) for c in df.columns], F.lit(True).alias(p + "_here"))

    t, s = prefixed(control, "t_"), prefixed(rows, "s_")
    proc = [F.coalesce(F.col(f"{p}_SinkLoadProcedureName"), F.lit("")) for p in "ts"]
    match = proc[0] == proc[1]
    for k in CONTROL_KEY:
        match = match & (F.col(f"t_{k}") == F.col(f"s_{k}"))
    joined = t.join(s, match, "full_outer")
    old, new = F.col("t__here").isNotNull(), F.col("s__here").isNotNull()
    out = [(F.when(new, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")) if c in UPDATED_FIELDS
            else F.when(old, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}"))).alias(c) for c in control.columns]
    state = F.when(~old, "insert").when(new, "update").otherwise("kept")
    return joined.select(*out, *([state.alias(label)] if label else []))
