"""Batch readers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import paths

CORRUPT = "_corrupt_record"


def read_csv(spark, path, infer=False) -> DataFrame:
    """CSV with a header; all strings unless ``infer`` asks for an extra typing pass."""
    return spark.read.csv(path, header=True, inferSchema=infer)


def read_delimited(spark, path, schema, sep=",", quote='"', header=True, escape="\\") -> DataFrame:
    """Delimited text under a declared schema."""
    return spark.read.schema(schema).csv(path, sep=sep, quote=quote, header=header, escape=escape)


class TooManyRejects(ValueError):
    """A file held more malformed rows than its load tolerates."""


def read_with_reject_limit(spark, path, schema, max_errors=0, **options):
    """(good rows, rejected lines) of a CSV, or ``TooManyRejects`` past ``max_errors``.

    Rejects are counted where they are read: each task sends one number.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    settings = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} | options
    rows = spark.read.schema(full).options(**settings).option("columnPruning", False).csv(path)
    # Spark refuses to read the corrupt column alone, hence the mention of a data column.
    marked = F.coalesce(F.col(CORRUPT), F.col(schema.names[0]).cast("string")).isNotNull() & F.col(CORRUPT).isNotNull()
    bad = rows.filter(marked)
    found = bad.count()
    if found > max_errors:
        raise TooManyRejects(f"{found} malformed rows in {path}, more than {max_errors}")
    return rows.filter(~marked).drop(CORRUPT), bad.select(CORRUPT)


def read_parquet(spark, path, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_table(spark, path, fmt="delta") -> DataFrame:
    """Read ``fmt``; without its connector on the class path, read the folder as parquet."""
    if fmt == "delta" and not has_format(spark, "io.delta.sql.DeltaSparkSessionExtension"):
        fmt = "parquet"
    return spark.read.format(fmt).load(path)


def has_format(spark, class_name) -> bool:
    try:
        spark._jvm.java.lang.Class.forName(class_name)
        return True
    except Exception:
        return False


def sql_on_path(spark, path, query, fmt="parquet") -> DataFrame:
    """Run SQL that reads ``{source}`` straight from a path, with no table registered."""
    if "`" in path:
        raise ValueError("a path may not hold a backtick")
    return spark.sql(query.format(source=f"{fmt}.`{path}`"))


def register_external(spark, name, schema, path, fmt="parquet") -> DataFrame:
    """Register a declared schema over a folder; the files stay where they are."""
    spark.catalog.createTable(name, path=path, source=fmt, schema=schema)
    return spark.table(name)


def read_json_array(spark, path, schema=None) -> DataFrame:
    """Files that each hold one JSON array of objects."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", True).json(path)


def read_tree(spark, path, glob="*.csv", schema=None, **options) -> DataFrame:
    """All matching files of a folder tree as one DataFrame, with their paths in ``file_path``."""
    reader = spark.read.options(**({"header": True} | options))
    if schema:
        reader = reader.schema(schema)
    rows = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob).csv(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file_path"))


def from_rows(spark, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def run_entities(spark, base, registry, log=print):
    """Yield ``(entity folder, file stem, file name, cleaned DataFrame)`` for the newest folder of every entity under ``base``.

    Files are routed by name to a cleaner in ``registry``; entities without a dated folder and
    files without a cleaner are reported and skipped. Several folders may hold files of one stem.
    """
    for entity in paths.list_names(spark, base, folders_only=True):
        folder = paths.latest_partition(spark, f"{base}/{entity}")
        if folder is None:
            log(f"no dated folder for {entity}")
            continue
        for name in paths.list_names(spark, folder):
            stem, _, kind = name.lower().rpartition(".")
            if stem not in registry or kind not in BY_SUFFIX:
                log(f"no cleaner for {name}")
                continue
            yield entity, stem, name, registry[stem](BY_SUFFIX[kind](spark, f"{folder}/{name}"))


# Reader by file suffix.
BY_SUFFIX = {"parquet": read_parquet, "json": read_json_array, "csv": read_csv}
