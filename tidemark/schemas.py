"""Declared schemas and the audit column suffix shared by the loaders."""

from pyspark.sql import types as T

# Audit columns every loaded table carries, in this order.
AUDIT_COLUMNS = [
    "ETLCreatedDate",
    "ETLCreatedBatchID",
    "ETLModifiedDate",
    "ETLModifiedBatchID",
    "HashValue",
    "IsDeleted",
]
# Columns that never enter a row hash.
UNHASHED_COLUMNS = AUDIT_COLUMNS + ["ETLCurrentRow", "ETLEffectiveFromDate", "ETLEffectiveToDate"]

AUDIT_FIELDS = [
    T.StructField("ETLCreatedDate", T.TimestampNTZType()),
    T.StructField("ETLCreatedBatchID", T.LongType()),
    T.StructField("ETLModifiedDate", T.TimestampNTZType()),
    T.StructField("ETLModifiedBatchID", T.LongType()),
    T.StructField("HashValue", T.StringType()),
    T.StructField("IsDeleted", T.BooleanType()),
]

TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType(),
         "timestamp_ntz": T.TimestampNTZType(), "decimal(20,2)": T.DecimalType(20, 2)}


def struct(**fields) -> T.StructType:
    """Schema from ``name="type"`` pairs; needs no running session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields.items()])


# Device messages arrive as text in every field; TYPED_MESSAGES is their typed view.
DEVICE_MESSAGES = struct(messageid="string", device_id="string", temperature="string", humidity="string",
                         timestamp="string")
TYPED_MESSAGES = {"temperature": "double", "humidity": "double", "timestamp": "timestamp_ntz"}

AUDIT_EVENTS = struct(
    ETLAuditLogID="bigint", ETLBatchID="bigint", ETLControlID="bigint", SourceSystem="string", Source="string",
    Sink="string", DeltaDetectType="string", ETLMinValue="string", ETLMaxValue="string", SourceQuery="string",
    RowsInserted="bigint", RowsUpdated="bigint", RowsMarkedAsDeleted="bigint", ETLStartTime="timestamp_ntz",
    ETLEndTime="timestamp_ntz", RunTimeInSecond="bigint", FileSizeInBytes="bigint", ThroughputInKbps="decimal(20,2)",
    TableType="string", LoadType="string", LoadStatus="string", IsLoadSuccess="boolean", IsStageLoaded="boolean",
    ErrorMsg="string", EventTime="timestamp_ntz", RowsWithoutWatermark="bigint", PipelineName="string", ActivityID="string",
    ActivityName="string")


def with_audit_fields(schema: T.StructType) -> T.StructType:
    """``schema`` followed by the audit suffix."""
    names = {f.name for f in schema.fields}
    return T.StructType(schema.fields + [f for f in AUDIT_FIELDS if f.name not in names])
