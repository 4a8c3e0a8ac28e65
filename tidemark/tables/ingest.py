"""Folders of files of which each is read once: what was read is kept with the table that holds its rows."""

import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import FileTable, plain

SEEN = "path string, size bigint, time timestamp"
#: Columns of stored rows that say which version of which file they come from.
PATH, TIME = "file_path", "file_time"


def listing(spark, folder, glob="*") -> DataFrame:
    """``path, size, time`` of all files of a tree that match ``glob``, as a DataFrame; no file is opened. Sizes and times are asked for in tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return files.select(F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("time"))


class FileIngest(FileTable):
    """Rows of the files of a folder tree, each file read once; a file whose size or time has changed is read again and replaces its rows.

    ``path`` holds the rows and, beside the manifest of the table, the list of files seen: one row (path, size, time) for each file in force. Both are named by the
    same commit, so a run that dies leaves neither.
    """

    def __init__(self, spark, path, schema, reader=None):
        super().__init__(spark, path)
        self.row_schema, self.reader = schema, reader or (lambda r, names: r.option("header", True).csv(names))

    def seen(self, state=None) -> DataFrame:
        """The files whose rows are in force."""
        stored = (state or self.state()).get("seen")
        return self.spark.read.schema(SEEN).parquet(f"{self.path}/{stored}") if stored else self.spark.createDataFrame([], SEEN)

    def news(self, folder, glob="*", state=None) -> DataFrame:
        """Files that were not read in their present version."""
        found = listing(self.spark, folder, glob)
        return found.join(self.seen(state), ["path", "size", "time"], "left_anti")

    def run(self, folder, glob="*", mirror=False):
        """Read the new and changed files of ``folder``. Returns how many were read; 0 publishes nothing. Of two runs at once one gets a ``Conflict``.

        Rows of a file are stored with its path and time. Of a file that was replaced the old rows no longer count from the commit on. With ``mirror``
        neither do those of files under ``folder`` that are gone, once something new is read.
        The names of the new files go through the driver, as they do in every read of files.
        """
        state = self.state()
        files = [tuple(r) for r in self.news(folder, glob, state).select("path", "size", "time").collect()]
        if not files:
            return 0
        rows = self.reader(self.spark.read.schema(self.row_schema), [f[0] for f in files])
        # The path as the listing gives it: the reader's is escaped.
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        rows = rows.select("*", path.alias(PATH), F.col("_metadata.file_modification_time").alias(TIME))
        stored = self.write_files(rows)
        schema = plain(T.StructType([*self.row_schema.fields, T.StructField(PATH, T.StringType()), T.StructField(TIME, T.TimestampType())]))
        fresh = self.spark.createDataFrame(files, SEEN)
        seen = f"_seen/{uuid.uuid4().hex}"
        kept = self.seen(state).join(fresh.select("path"), "path", "left_anti")
        if mirror:
            inside = F.regexp_replace("path", "^[^:/]+:/+", "/").startswith(re.sub("^[^:/]+:/+", "/", folder.rstrip("/")) + "/")
            kept = kept.where(~inside).unionByName(kept.where(inside).join(listing(self.spark, folder, glob).select("path"), "path", "left_semi"))
        kept = kept.select("path", "size", "time")
        kept.unionByName(fresh).coalesce(1).write.parquet(f"{self.path}/{seen}")
        self.publish(state, schema, self.measured(stored, schema), changes_base=True, seen=seen)
        return len(files)

    def read(self, state=None) -> DataFrame:
        """Rows of the files in force, with ``file_path`` and ``file_time``."""
        state = state or self.state()
        names = self.seen(state).select(F.col("path").alias(PATH), F.col("time").alias(TIME))
        return super().read(state).join(names, [PATH, TIME], "left_semi")
