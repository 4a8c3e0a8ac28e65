"""Hash-diff upserts, full reloads, dimension loads and change-feed application.

Results are new table contents; ``plans.loads`` writes them to a fresh folder and publishes it.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import stamp
from ..functions.hashing import row_hash
from ..schemas import AUDIT_COLUMNS, UNHASHED_COLUMNS
from .joins import all_of, one_per_key


def business_columns(df) -> list[str]:
    return [c for c in df.columns if c not in UNHASHED_COLUMNS]


def with_hash(df, cols=None, mode="sha2") -> DataFrame:
    """Stage a source: not deleted, and hashed over its business columns."""
    cols = cols or business_columns(df)
    return df.withColumns({"IsDeleted": F.lit(False), "HashValue": row_hash(cols, mode)})


def stamp_audit_cols(df, batch_id, now, mode="sha2") -> DataFrame:
    """Append the audit suffix of a first load."""
    when, batch = stamp(now), F.lit(batch_id).cast("long")
    staged = with_hash(df, mode=mode)
    return staged.withColumns({"ETLCreatedDate": when, "ETLCreatedBatchID": batch, "ETLModifiedDate": when,
                               "ETLModifiedBatchID": batch}).select(*business_columns(df), *AUDIT_COLUMNS)


def stamp_loaded(df, now=None, name="loaddatetime") -> DataFrame:
    return df.withColumn(name, stamp(now))


def stamp_client(df, client_id, name="Client_Id") -> DataFrame:
    """Tenant column that completes the ``(id, Client_Id)`` key."""
    return df.withColumn(name, F.lit(client_id))


def refuse_null_keys(df, keys) -> DataFrame:
    """The same rows; reading them fails with a message if one has a NULL in its key."""
    missing = F.raise_error(F.concat(F.lit("NULL in the source key "), F.lit(", ".join(keys))))
    first, kind = keys[0], df.schema[keys[0]].dataType
    some = reduce(lambda p, q: p | q, [F.col(k).isNull() for k in keys])
    return df.withColumn(first, F.when(some, missing.cast(kind)).otherwise(F.col(first)))


def _key_match(schema, keys, null_safe=False, blank_null=False):
    """Equality of ``t_`` and ``s_`` keys. ``blank_null`` reads NULL text as blank and lets other NULLs match."""
    def same(k):
        t, s = F.col(f"t_{k}"), F.col(f"s_{k}")
        if blank_null and isinstance(schema[k].dataType, T.StringType):
            return F.coalesce(t, F.lit("")) == F.coalesce(s, F.lit(""))
        return t.eqNullSafe(s) if null_safe or blank_null else t == s

    return all_of([same(k) for k in keys])


def _prefixed(df, prefix):
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(prefix + "_here"))


def hash_upsert(target, source, keys, batch_id, now, order=None, blank_null_keys=False, mark_deleted=False,
                mode="sha2", label=None, unique_source=False, null_keys="error") -> DataFrame:
    """Type-1 upsert by row hash.

    A NULL in a source key is an error, because it would be inserted again by every load; ``null_keys="match"`` lets NULL meet
    NULL, and ``blank_null_keys`` also reads NULL text keys as blank.

    Matched with another hash: business columns, hash and modified stamps come from the source,
    created stamps stay. Unmatched source rows are inserted. Unchanged rows are not touched. With
    ``mark_deleted`` the source is a full snapshot and target rows missing in it are flagged.
    ``label`` names an optional column telling insert, update, same, kept or delete.
    """
    business = [c for c in business_columns(target)]
    if null_keys not in ("error", "match"):
        raise ValueError(f"unknown treatment of NULL keys {null_keys!r}")
    if null_keys == "error" and not blank_null_keys:
        source = refuse_null_keys(source, keys)
    elif blank_null_keys:  # keys that meet the same target row are one key
        source = source.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys if isinstance(source.schema[k].dataType, T.StringType)})
    staged = with_hash(source.select(*business), business, mode)
    if not unique_source:
        wanted = source.select(*business, *[c for c in (order or []) if c not in business])
        staged = with_hash(one_per_key(wanted, keys, order).select(*business), business, mode)
    t, s = _prefixed(target, "t_"), _prefixed(staged, "s_")
    joined = t.join(s, _key_match(target.schema, keys, null_keys == "match", blank_null_keys), "full_outer")
    here_t, here_s = F.col("t__here").isNotNull(), F.col("s__here").isNotNull()
    missing = ~here_s & ~F.col("t_IsDeleted")
    # A flagged row that the snapshot holds again is an update even under an unchanged hash.
    differs = (F.col("t_HashValue") != F.col("s_HashValue")) | F.col("t_IsDeleted")
    state = (F.when(~here_t, "insert").when(~here_s, F.when(missing, "delete").otherwise("kept") if mark_deleted
                                            else F.lit("kept"))
             .when(differs, "update").otherwise("same"))
    joined = joined.withColumn("__state", state)
    taken = F.col("__state").isin("insert", "update")
    when, batch = stamp(now), F.lit(batch_id).cast("long")
    touched = taken | (F.col("__state") == "delete")
    audit = {
        "ETLCreatedDate": F.when(here_t, F.col("t_ETLCreatedDate")).otherwise(when),
        "ETLCreatedBatchID": F.when(here_t, F.col("t_ETLCreatedBatchID")).otherwise(batch),
        "ETLModifiedDate": F.when(touched, when).otherwise(F.col("t_ETLModifiedDate")),
        "ETLModifiedBatchID": F.when(touched, batch).otherwise(F.col("t_ETLModifiedBatchID")),
        "HashValue": F.when(taken, F.col("s_HashValue")).otherwise(F.col("t_HashValue")),
        "IsDeleted": F.when(taken, F.lit(False)).when(F.col("__state") == "delete", F.lit(True))
        .otherwise(F.col("t_IsDeleted")),
    }
    out = [F.when(taken, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in business]
    out += [audit[c].alias(c) for c in AUDIT_COLUMNS]
    return joined.select(*out, *([F.col("__state").alias(label)] if label else []))


def change_counts(labelled, label) -> DataFrame:
    """(RowsInserted, RowsUpdated, RowsMarkedAsDeleted) of a labelled upsert."""
    def tally(state):
        return F.count(F.when(F.col(label) == state, 1))

    return labelled.agg(tally("insert").alias("RowsInserted"), tally("update").alias("RowsUpdated"),
                        tally("delete").alias("RowsMarkedAsDeleted"))


def upsert_counts(source, target, keys, **options) -> DataFrame:
    """Counts an upsert of ``source`` would report: the upsert's own states, its result columns pruned away."""
    states = hash_upsert(target, source, keys, 0, "1970-01-01 00:00:00", label="__state_of", **options)
    return change_counts(states.select("__state_of"), "__state_of").select("RowsUpdated", "RowsInserted")


def full_reload(source, batch_id, now) -> DataFrame:
    """Replace a keyless table: constant hash, fresh stamps."""
    fresh = stamp_audit_cols(source, batch_id, now)
    return fresh.withColumn("HashValue", F.lit("0"))


def load_table(source, target, keys, batch_id, now, **options) -> DataFrame:
    """Upsert when the table has both key and non-key columns, else reload it whole."""
    rest = [c for c in business_columns(source) if c not in keys]
    if keys and rest:
        return hash_upsert(target, source, list(keys), batch_id, now, **options)
    return full_reload(source.select(*business_columns(source)), batch_id, now)


def dim_upsert(dim, source, keys, mapping, order=None, label=None, null_keys="error") -> DataFrame:
    """Type-1 dimension load: overwrite matched rows, insert new ones, keep the rest.

    A NULL in a source key is an error, or with ``null_keys="match"`` the key of one row.

    ``keys`` maps dimension key to source key, ``mapping`` dimension column to source column.
    A matched source value overwrites even when it is NULL.
    """
    wanted = [F.col(s).alias(d) for d, s in {**keys, **mapping}.items()]
    extra = [c for c in (order or []) if c not in {**keys, **mapping}]
    rows = source.select(*wanted, *extra)
    rows = rows if null_keys == "match" else refuse_null_keys(rows, list(keys))
    src = one_per_key(rows, list(keys), order).drop(*extra)
    t, s = _prefixed(dim, "t_"), _prefixed(src, "s_")
    joined = t.join(s, _key_match(dim.schema, keys, null_keys == "match"), "full_outer")
    new, hit = F.col("t__here").isNull(), F.col("s__here").isNotNull()
    loaded = {**keys, **mapping}
    out = [F.when(hit, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) if c in loaded else F.col(f"t_{c}").alias(c)
           for c in dim.columns]
    state = F.when(new, "insert").when(hit, "update").otherwise("kept")
    return joined.select(*out, *([state.alias(label)] if label else []))


# Change-feed operation codes and what each one does to the target.
FEED_OPS = {1: "delete", 2: "insert", 4: "update"}
# The reading of the codes in which 3 updates a matched row and 2 inserts an unmatched one.
COMPAT_OPS = {2: "insert", 3: "update"}


def valid_changes(changes, lsn="__$start_lsn") -> DataFrame:
    return changes.filter(F.col(lsn).isNotNull())


def apply_cdc(target, changes, keys, order, ops=None, op_col="__$operation", strict=False) -> DataFrame:
    """Bring a target up to date with a change feed, read in ``order``.

    Codes not in ``ops`` are skipped. Without ``strict`` the last change per key decides and both insert and update write the
    row, so replaying a batch changes nothing. With ``strict`` an update needs the row to be there and an insert needs it
    missing, at its place in the feed: an insert and a later update of a new key both count. A NULL in a key is an error.
    """
    ops = FEED_OPS if ops is None else ops
    verb = F.create_map(*[x for code, name in ops.items() for x in (F.lit(code), F.lit(name))])
    known = changes.filter(F.col(op_col).isin(list(ops))).withColumn("__verb", F.element_at(verb, F.col(op_col)))
    cols = [c for c in target.columns]
    known = refuse_null_keys(known.select(*dict.fromkeys([*cols, "__verb", *order])), keys)
    if strict:
        return _apply_strictly(target, known, keys, order, cols)
    last = one_per_key(known, keys, order).select(*cols, "__verb")
    t, s = _prefixed(target, "t_"), _prefixed(last, "s_")
    joined = t.join(s, _key_match(target.schema, keys), "full_outer")
    here_t, act = F.col("t__here").isNotNull(), F.col("s___verb")
    write = F.coalesce(act.isin("update", "insert"), F.lit(False))
    keep = write | (here_t & F.coalesce(act != "delete", F.lit(True)))
    return joined.filter(keep).select(
        *[F.when(write, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols])


def _apply_strictly(target, known, keys, order, cols):
    """A key's last delete makes the row missing; from there the first insert and the last update after it count."""
    change = F.struct(F.struct(*order).alias("at"), F.struct(*cols).alias("row"))
    marked = known.select(*keys, "__verb", change.alias("__change"))
    gone = marked.filter("__verb = 'delete'").groupBy(*keys).agg(F.max("__change.at").alias("__gone"))
    after = marked.join(gone, keys, "left").filter("__gone IS NULL OR __change.at > __gone")
    found = after.groupBy(*keys).agg(F.min(F.when(F.col("__verb") == "insert", F.col("__change"))).alias("__insert"),
                                     F.max(F.when(F.col("__verb") == "update", F.col("__change"))).alias("__update"))
    per_key = found.join(gone, keys, "full_outer")
    t, s = _prefixed(target, "t_"), _prefixed(per_key, "s_")
    joined = t.join(s, _key_match(target.schema, keys), "full_outer")
    there = F.col("t__here").isNotNull() & F.col("s___gone").isNull()
    insert, update = F.col("s___insert"), F.col("s___update")
    created = F.when(update["at"] > insert["at"], update["row"]).otherwise(insert["row"])
    row = F.when(there, update["row"]).when(insert.isNotNull(), created)
    return joined.withColumn("__row", row).filter(there | F.col("__row").isNotNull()).select(
        *[F.when(F.col("__row").isNotNull(), F.col(f"__row.{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols])
