"""Checks inside the write: one pass over the source measures all rules, routes failing rows to quarantine, and is published only within its budget."""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import resolve_column
from ..sources.readers import CORRUPT
from .files import PART, FileTable, plain

#: Part folders of a checked load: rows that passed, rows that failed.
GOOD, BAD = 0, 1
REASONS, FILE = "failed_rules", "source_file"


class RulesBroken(ValueError):
    """A load broke more rules than it may; ``report`` holds the measured numbers."""

    def __init__(self, message, report):
        super().__init__(message)
        self.report = report


@dataclass
class Rules:
    """What rows of a table must hold.

    ``checks`` maps a rule's name to a condition that a good row meets; a condition that is NULL is not met. ``required`` columns must be
    there and not NULL, ``limits`` gives the longest text of a column, ``unique`` is a key that no two good rows share. ``budget`` is the number of failing rows
    that a load tolerates, or with a fraction below 1 their share; ``least`` is the smallest number of good rows.
    """

    checks: dict[str, Column] | None = None
    required: tuple = ()
    limits: dict[str, int] | None = None
    unique: tuple = ()
    budget: float = 0
    least: int = 0

    def conditions(self, columns) -> dict[str, Column]:
        out = {f"{c} is missing": F.col(f"`{c}`").isNotNull() for c in self.required}
        out |= {f"{c} is longer than {n}": F.coalesce(F.length(F.col(f"`{c}`")) <= n, F.lit(True)) for c, n in (self.limits or {}).items()}
        if CORRUPT in columns:
            out["malformed"] = F.col(CORRUPT).isNull()
        return out | (self.checks or {})


def lines(spark, path, schema, **options) -> DataFrame:
    """A CSV with its malformed lines kept as such and the name of each row's file, for a checked load."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    settings = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} | options
    rows = spark.read.schema(full).options(**settings).option("columnPruning", False).csv(path)
    return rows.select("*", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias(FILE))


class CheckedTable(FileTable):
    """Loads are published if their rows keep the rules; failing rows lie in quarantine with the names of the rules they failed."""

    def load(self, df, rules, batch=None, source="load"):
        """Write ``df`` once, good rows and failing ones to folders of their own, count while writing, then publish or refuse.

        Returns the report: rows, failed rows, failures of each rule, repeated keys. Past the budget nothing is published and ``RulesBroken`` is raised; the
        folder of the refused rows stays and is named by the error's report. Missing columns are told before anything is read. Uniqueness is measured over the key columns
        of the written good rows, with repeats collapsed before they are moved. A batch that is part of the table already returns None.
        """
        lacking = [c for c in (*rules.required, *rules.unique) if resolve_column(df, c) is None]
        if lacking:
            raise RulesBroken(f"missing columns {lacking}", {"missing": lacking})
        state = self.state()
        if batch is not None and state["marks"].get(source, -1) >= batch:
            return None
        conditions = rules.conditions(df.columns)
        failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in conditions.items()])) if conditions else F.array().cast("array<string>")
        watch, marked = Observation(), df.withColumn(REASONS, failed)
        numbers = {f"rule_{k}": F.count(F.when(F.array_contains(REASONS, name), 1)) for k, name in enumerate(conditions)}
        marked = marked.observe(watch, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.size(REASONS) > 0, 1)).alias("failed"),
                                *[c.alias(n) for n, c in numbers.items()])
        folder = f"data/load__={uuid.uuid4().hex}"
        marked.withColumn(PART, F.when(F.size(REASONS) > 0, BAD).otherwise(GOOD)).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        found = watch.get
        report = {"rows": found["rows"], "failed": found["failed"], "folder": folder,
                  "rules": {name: found[f"rule_{k}"] for k, name in enumerate(conditions)}, "repeated_keys": 0}
        schema = plain(df.drop(CORRUPT, FILE).schema)
        new = self.measured(folder, schema)
        if rules.unique and found["rows"] > found["failed"]:
            keys = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}/{PART}={GOOD}").select(*rules.unique)
            report["repeated_keys"] = keys.groupBy(*rules.unique).agg(F.count("*").alias("n")).where("n > 1").count()
        allowed = rules.budget * found["rows"] if 0 < rules.budget < 1 else rules.budget
        if report["failed"] > allowed:
            raise RulesBroken(f"{report['failed']} of {report['rows']} rows fail: {report['rules']}", report)
        if report["repeated_keys"]:
            raise RulesBroken(f"{report['repeated_keys']} keys are repeated", report)
        if found["rows"] - found["failed"] < rules.least:
            raise RulesBroken(f"{found['rows'] - found['failed']} good rows, fewer than {rules.least}", report)
        marks = None if batch is None else {source: batch}
        report["version"] = self.publish(state, schema, new.where(F.col("part") == GOOD), marks=marks, report=report)
        return report

    def quarantine(self, report, schema=None) -> DataFrame:
        """Failing rows of one load, published or refused, with ``failed_rules`` and what the source says about them."""
        return self.spark.read.option("basePath", f"{self.path}/{report['folder']}").parquet(f"{self.path}/{report['folder']}").where(F.col(PART) == BAD).drop(PART)
