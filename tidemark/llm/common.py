"""Small helpers that the corpus operators share."""

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from ..session import scratch_path

#: Most bytes of rows that go to a worker at once, so that long texts do not add up.
BATCH_BYTES = 8 << 20
_shipped = {}


def ship(spark):
    """Hand this package's code to the workers, once per application, so that it need not be installed there, and bound the batches they get."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="code-"), "tidemark_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(root):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        context.addPyFile(path)
        _shipped[context.applicationId] = path


def table(spark, folder, name):
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bare(df, **columns):
    """Only the named input columns under the names the operator uses, so extra or clashing columns play no part."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


def rows_of(batch, *names):
    """Rows of an Arrow batch one at a time; only one row's Python objects live at once."""
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def batch_of(schema, rows):
    """An Arrow batch from row tuples, by an Arrow schema."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def flushed(rows, schema, size=2000):
    """Row tuples grouped into Arrow batches of at most ``size`` rows."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch_of(schema, held)
            held = []
    if held:
        yield batch_of(schema, held)


def settle_text(df, label):
    """``settle`` for tables that hold texts: the files are compressed harder, as they may be as large as the input."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id, text):
    """Digest column that tells rows apart by id and text; NULLs count as values of their own."""
    return F.unhex(F.sha2(F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit("|"), F.coalesce(F.sha2(text, 256), F.lit("-"))), 256))


def unused(names, stem):
    """A name stem with which no column starts, so internal columns cannot clash with the caller's."""
    while any(n.lower().startswith(stem) for n in names):
        stem += "_"
    return stem
