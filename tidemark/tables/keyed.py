"""Tables with a key: loads that rewrite only what they touch, and change feeds kept as deltas until they are folded in."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import one_per_key
from ..operators.upsert import FEED_OPS, business_columns, hash_upsert, refuse_null_keys, stamp_audit_cols
from ..session import settle
from .files import BASE, DELTA, LOAD, FileTable, plain

CHANGE = "_change"
#: True in a delta where the key's row is written, False where it is deleted.
WRITE = "write__"
#: Part folders of a delta. A small number, as deltas are many and small; each holds neighbouring parts of the table.
DELTA_PARTS = 8


class KeyedTable(FileTable):
    """One row for each key, in ``parts`` parts by the hash of the key.

    ``upsert`` and ``rewrite`` are copy on write: they read and write only the parts that the incoming keys fall into, and the manifest keeps the
    other parts' files. ``apply`` is merge on read: it stores the last change of each key of a batch and reads nothing of the table;
    ``read`` lays the deltas over the base, ``compact`` folds them in and forgets them. Choose ``parts`` so that one holds what a task can sort.
    The key and the number of parts must stay what they were when the table was made.
    """

    def __init__(self, spark, path, keys, parts=64, watermark=None):
        super().__init__(spark, path, watermark)
        self.keys, self.parts = list(keys), parts

    def part(self, schema):
        """Number of the part a key falls into. NULL and blank text share one, so that either reading of NULL keys finds its row."""
        keys = [F.coalesce(F.col(f"`{k}`"), F.lit("")) if isinstance(schema[k].dataType, T.StringType) else F.col(f"`{k}`") for k in self.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.parts)).cast("int")

    def _as_stored(self, rows, schema):
        """The incoming keys in the stored types, as the hash depends on them."""
        return rows.withColumns({k: F.col(f"`{k}`").cast(schema[k].dataType) for k in self.keys})

    def touched(self, rows) -> list[int]:
        """Parts that keys of ``rows`` fall into; at most as many numbers as the table has parts."""
        return [r[0] for r in rows.select(self.part(rows.schema)).distinct().collect()]

    # copy on write

    def rewrite(self, rows, merge, marks=None, every=False, label=None):
        """Replace the touched parts by ``merge(their rows, rows)``. Deltas are folded in first. Returns the tally of ``label``, a column of the result that
        is counted while it is written and not stored.

        Fails with a ``Conflict`` if another run changed base files in the meantime. ``every`` touches all parts.
        """
        self.compact()
        state = self.state()
        rows = settle(self._as_stored(rows, self.schema(state)), "incoming")
        files = self.files(state).where(F.col("kind") == BASE)
        if not every:
            files = files.where(F.col("part").isin(self.touched(rows)))
        merged = merge(self.scan(files, state), rows)
        return self._store(state, merged, files, marks, label)

    def _store(self, state, merged, removed, marks=None, label=None, schema=None):
        watch = None
        if label:
            watch = Observation()
            tally = F.col(label)
            merged = merged.observe(watch, *[F.count(F.when(tally == s, 1)).alias(n) for s, n in
                                             (("insert", "RowsInserted"), ("update", "RowsUpdated"), ("delete", "RowsMarkedAsDeleted"))]).drop(label)
        schema = schema or self.schema(state)
        folder = self.write_files(merged.select(schema.names), self.part(schema), self.keys)
        self.publish(state, schema, self.measured(folder, schema), removed, marks, changes_base=True)
        return watch.get if watch else None

    def create(self, rows, marks=None, label=None):
        """First content; the keys must be distinct. A ``Conflict`` if another run made the table in the meantime."""
        schema = plain(rows.drop(label).schema if label else rows.schema)
        return self._store(self.state(), rows, None, marks, label, schema)

    def upsert(self, source, batch_id, now, order=None, mark_deleted=False, marks=None, **options):
        """Type-1 upsert by row hash, as ``operators.upsert.hash_upsert`` does it, of the touched parts. Returns the counts of changed rows.

        With ``mark_deleted`` the source is a whole snapshot, so every part is touched.
        """
        if self.schema() is None:
            keep = [c for c in source.columns if c in business_columns(source)]
            blank = options.get("null_keys", "error") == "error"
            rows = one_per_key(refuse_null_keys(source, self.keys) if blank else source, self.keys, order).select(keep)
            return self.create(stamp_audit_cols(rows, batch_id, now).withColumn(CHANGE, F.lit("insert")), marks, CHANGE)
        def merge(current, rows):
            return hash_upsert(current, rows, self.keys, batch_id, now, order=order, mark_deleted=mark_deleted, label=CHANGE, **options)

        return self.rewrite(source, merge, marks, mark_deleted, CHANGE)

    # merge on read

    def apply(self, changes, batch, order, ops=None, op_col="__$operation", source="feed"):
        """Store the last change of each key of a batch as a delta; returns the commit, or None for a batch that is part of the table already.

        ``order`` decides inside a batch, batches count in the order of their commits. A batch number is remembered for its ``source`` also after
        compaction. Codes not in ``ops`` are skipped; without an ``op_col`` every row is written. A NULL in a key is an error. Only the batch is read.
        """
        state = self.state()
        if state["marks"].get(source, -1) >= batch:
            return None
        schema = self.schema(state)
        if schema is None:
            raise FileNotFoundError(f"{self.path} has no base; create it first")
        ops = FEED_OPS if ops is None else ops
        write = F.lit(True)
        if op_col:
            changes = changes.where(F.col(op_col).isin(list(ops)))
            write = F.col(op_col).isin([c for c, verb in ops.items() if verb != "delete"])
        rows = refuse_null_keys(self._as_stored(changes, schema), self.keys).withColumn(WRITE, write)
        last = one_per_key(rows.select(*dict.fromkeys([*schema.names, WRITE, *order])), self.keys, order)
        cells = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]
        group = F.floor(self.part(schema) * DELTA_PARTS / self.parts).cast("int")
        folder = self.write_files(last.select(*cells, WRITE), group, self.keys)
        return self.publish(state, schema, self.measured(folder, schema, DELTA), marks={source: batch})

    def _last(self, deltas, state) -> DataFrame:
        """The last change of each key in the deltas."""
        rows = self.scan(deltas, state, [T.StructField(WRITE, T.BooleanType())], folders=True)
        numbers = deltas.select(F.regexp_extract("file", f"{LOAD}=([^/]+)", 1).alias(LOAD), "seq").distinct()
        return one_per_key(rows.join(numbers, LOAD).drop(LOAD, "part__"), self.keys, ["seq"]).drop("seq")

    def _laid_over(self, base, last):
        names = base.columns
        return base.join(last.select(self.keys), self.keys, "left_anti").select(names).unionByName(last.where(WRITE).select(names))

    def read(self, state=None) -> DataFrame:
        state = state or self.state()
        files = self.files(state)
        base, deltas = self.scan(files.where(F.col("kind") == BASE), state), files.where(F.col("kind") == DELTA)
        return base if deltas.isEmpty() else self._laid_over(base, self._last(deltas, state))

    def compact(self) -> int:
        """Fold all deltas into the parts they touch and forget them; returns how many files were folded. Deltas that arrive meanwhile stay."""
        state = self.state()
        files = self.files(state)
        deltas = files.where(F.col("kind") == DELTA)
        n = deltas.count()
        if n:
            last = settle(self._last(deltas, state), "last")
            base = files.where((F.col("kind") == BASE) & F.col("part").isin(self.touched(last)))
            self._store(state, self._laid_over(self.scan(base, state), last), base.unionByName(deltas))
        return n
