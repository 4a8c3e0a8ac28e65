"""A table as a set of parquet files named by a manifest, with the bounds of a watermark for each file.

A commit names the folder of its manifest, which Spark writes and reads as a table: one row for each file in force. Files lie under
``data/load__=<id>/part__=<number>/``, so a filter on ``part__`` prunes folders in the plan. Nothing is ever overwritten, so a reader of an earlier commit
keeps its files until ``vacuum``.
"""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import literal, shift_days
from ..operators.layout import balanced
from ..sources.paths import _fs, exists
from .commits import CommitLog, Conflict

LOAD, PART = "load__", "part__"
BASE, DELTA = "base", "delta"
MANIFEST = "kind string, part int, seq bigint, file string, rows bigint, nulls bigint, low string, high string"
#: Attempts to publish a change that does not depend on what other runs published meanwhile.
ATTEMPTS = 20


def plain(schema):
    """The schema with every column nullable and without annotations, as parquet gives it back."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _in_folders(schema):
    return T.StructType([*schema.fields, T.StructField(LOAD, T.StringType()), T.StructField(PART, T.IntegerType())])


class FileTable:
    """Append-only by itself; other tables of this package build on it. ``watermark`` names the column whose bounds are kept for each file."""

    def __init__(self, spark, path, watermark=None):
        self.spark, self.path, self.watermark = spark, path.rstrip("/"), watermark
        self.log = CommitLog(spark, f"{self.path}/_commits")

    # state

    def state(self) -> dict:
        """The commit in force, with its number; before the first one an empty state."""
        version, content = self.log.last()
        return {"marks": {}, "manifest": None, "schema": None, "base_version": -1} | (content or {}) | {"version": version}

    def files(self, state=None) -> DataFrame:
        """The manifest: kind, part, sequence number, name, rows, rows without a watermark and its bounds, for each file in force."""
        manifest = (state or self.state())["manifest"]
        if manifest is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/{manifest}")

    def schema(self, state=None):
        stored = (state or self.state())["schema"]
        return T.StructType.fromJson(stored) if stored else None

    def scan(self, files, state=None, extra=(), folders=False) -> DataFrame:
        """Rows of the files of a manifest. The names are the plan's own list of files, one short text each. ``extra`` fields stand in the
        files beside the table's; ``folders`` keeps the columns that name a row's folders."""
        schema = self.schema(state)
        if schema is None:
            raise FileNotFoundError(f"nothing was published under {self.path}")
        names = [f"{self.path}/{r[0]}" for r in files.select("file").collect()]
        full = _in_folders(T.StructType([*schema.fields, *extra]))
        rows = self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*names) if names else self.spark.createDataFrame([], full)
        return rows if folders else rows.drop(LOAD, PART)

    def read(self, state=None) -> DataFrame:
        state = state or self.state()
        return self.scan(self.files(state), state)

    # writing

    def write_files(self, df, part=None, sort=()):
        """Write rows to a new folder; returns its name. ``part`` is a column that deals rows to part folders, few files each, sorted by ``sort``."""
        folder = f"data/{LOAD}={uuid.uuid4().hex}"
        if part is None:
            rows = df.withColumn(PART, F.lit(0))
        else:
            rows = balanced(df.withColumn(PART, part), PART).sortWithinPartitions(PART, *sort)
        rows.write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        return folder

    def measured(self, folder, schema, kind=BASE) -> DataFrame:
        """Manifest rows of a new folder, without their number, from a scan of the watermark column of the new files alone."""
        rows = self.spark.read.schema(_in_folders(schema)).option("basePath", f"{self.path}/data").parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.element_at(F.split(F.col("_metadata.file_path"), f"{folder}/"), -1))
        mark = F.col(f"`{self.watermark}`") if self.watermark else F.lit(None).cast("string")
        found = rows.select(F.col(PART).alias("part"), name.alias("file"), mark.alias("mark")).groupBy("part", "file").agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("mark").isNull(), 1)).alias("nulls"),
            F.min("mark").cast("string").alias("low"), F.max("mark").cast("string").alias("high"))
        return found.select(F.lit(kind).alias("kind"), "part", F.lit(None).cast("bigint").alias("seq"), "file", "rows", "nulls", "low", "high")

    def publish(self, base, schema, added, removed=None, marks=None, changes_base=False, **info) -> int:
        """Commit a new manifest: the files in force without those that ``removed`` names (column ``file``), and ``added``.

        A change that reads base files (``changes_base``) fails with a ``Conflict`` if another run changed base files since commit ``base["version"]``. Changes
        that commute with it, such as appended files, are kept: the manifest is built again from the state they left.
        """
        new = [tuple(r) for r in added.collect()]  # names of the files this run wrote
        for _ in range(ATTEMPTS):
            state = self.state()
            if changes_base and state["base_version"] > base["version"]:
                raise Conflict(f"another run changed {self.path} in the meantime")
            if marks and any(state["marks"].get(k) is not None and state["marks"][k] >= v for k, v in marks.items()):
                raise Conflict(f"a batch of {marks} is already part of {self.path}")
            if self.schema(state) is not None and self.schema(state) != schema:
                raise ValueError(f"the columns of {self.path} are {self.schema(state).simpleString()}, not {schema.simpleString()}")
            files = self.files(state)
            if removed is not None:
                files = files.join(removed.select("file"), "file", "left_anti").select(files.columns)
            number, manifest = state["version"] + 1, f"_manifests/{uuid.uuid4().hex}"
            rows = self.spark.createDataFrame([(kind, part, number, *rest) for kind, part, _, *rest in new], MANIFEST)
            files.unionByName(rows).coalesce(1).write.parquet(f"{self.path}/{manifest}")
            content = {"manifest": manifest, "schema": schema.jsonValue(), "marks": state["marks"] | (marks or {}),
                       "base_version": number if changes_base else state["base_version"], **info}
            try:
                return self.log.commit(state["version"], content)
            except Conflict:
                continue
        raise Conflict(f"{self.path} is published too often by others")

    def append(self, df, batch=None, source="append"):
        """Add rows. A ``batch`` number that is not above the last one of its ``source`` was added before and adds nothing (returns None)."""
        state = self.state()
        if batch is not None and state["marks"].get(source, -1) >= batch:
            return None
        folder = self.write_files(df)
        schema = plain(df.schema)
        return self.publish(state, schema, self.measured(folder, schema), marks=None if batch is None else {source: batch})

    # zone map

    def _dtype(self, state):
        return self.schema(state)[self.watermark].dataType

    def high_water(self, state=None):
        """Greatest watermark, from the manifest: no data file is opened."""
        state = state or self.state()
        if self.schema(state) is None:
            return None
        return self.files(state).agg(F.max(F.col("high").cast(self._dtype(state)))).first()[0]

    def null_watermarks(self, state=None) -> int:
        """Rows without a watermark, from the manifest."""
        return self.files(state).agg(F.coalesce(F.sum("nulls"), F.lit(0))).first()[0]

    def window(self, low=None, high=None, inclusive=False, lookback_days=0, state=None) -> DataFrame:
        """Rows with a watermark in ``(low, high]``, or ``[low, high]``; an open bound is None. Only files whose bounds overlap are in the plan."""
        state = state or self.state()
        dtype, mark = self._dtype(state), F.col(f"`{self.watermark}`")
        files, keep = self.files(state), mark.isNotNull()
        if low is not None:
            bound = literal(low, dtype)
            bound = shift_days(bound, -lookback_days).cast(dtype) if lookback_days else bound
            keep &= mark >= bound if inclusive else mark > bound
            top = F.col("high").cast(dtype)
            files = files.where(top >= bound if inclusive else top > bound)
        if high is not None:
            keep &= mark <= literal(high, dtype)
            files = files.where(F.col("low").cast(dtype) <= literal(high, dtype))
        return self.scan(files.where("high IS NOT NULL"), state).where(keep)

    # housekeeping

    def vacuum(self, keep=2) -> int:
        """Remove data folders and manifests that none of the last ``keep`` commits names; returns how many. Not to be run beside a writer."""
        used, manifests = set(), set()
        for version in self.log.versions()[-keep:]:
            content = self.log.read(version)
            manifests.add(content["manifest"].rpartition("/")[2])
            folders = self.files(content).select(F.element_at(F.split("file", "/"), 2)).distinct()
            used |= {r[0] for r in folders.collect()}
        removed = 0
        for parent, kept in ((f"{self.path}/data", used), (f"{self.path}/_manifests", manifests)):
            if not exists(self.spark, parent):
                continue
            fs, root = _fs(self.spark, parent)
            for status in fs.listStatus(root):
                if status.getPath().getName() not in kept:
                    removed += bool(fs.delete(status.getPath(), True))
        return removed
