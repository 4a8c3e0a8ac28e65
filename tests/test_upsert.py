"""Upsert, dimension, change-feed and reload laws."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import upsert as up

T1, T2, T3 = "2025-01-01 00:00:00", "2025-01-02 00:00:00", "2025-01-03 00:00:00"
SCHEMA = "id int, name string, qty int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def first_load(spark, rows, schema=SCHEMA, **kw):
    return up.stamp_audit_cols(frame(spark, rows, schema), 1, T1, **kw)


def test_upsert_states_and_stamps(spark, rows):
    target = first_load(spark, [(1, "a", 1), (2, "b", 2), (3, None, 3)])
    source = frame(spark, [(1, "a", 1), (2, "B", 2), (4, "d", 4)])
    out = up.hash_upsert(target, source, ["id"], 2, T2, label="change")
    got = {r["id"]: r for r in out.collect()}
    assert {k: r["change"] for k, r in got.items()} == {1: "same", 2: "update", 3: "kept", 4: "insert"}
    assert got[2]["name"] == "B" and got[2]["ETLCreatedBatchID"] == 1 and got[2]["ETLModifiedBatchID"] == 2
    assert str(got[2]["ETLCreatedDate"]) == T1 and str(got[2]["ETLModifiedDate"]) == T2
    assert got[1]["ETLModifiedBatchID"] == 1 and got[4]["ETLCreatedBatchID"] == 2
    assert rows(up.change_counts(out, "change")) == [(1, 1, 0)]
    assert rows(up.upsert_counts(source, target, ["id"])) == [(1, 1)]


def test_upsert_twice_changes_nothing(spark):
    target = first_load(spark, [(1, "a", 1), (2, "b", 2)])
    source = frame(spark, [(2, "c", 2), (3, "d", 3)])
    once = up.hash_upsert(target, source, ["id"], 2, T2)
    twice = up.hash_upsert(once, source, ["id"], 3, T3, label="change")
    assert {r[0] for r in twice.select("change").collect()} == {"same", "kept"}
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.drop("change").collect()))


def test_revert_is_seen(spark):
    target = first_load(spark, [(1, "a", 1)])
    changed = up.hash_upsert(target, frame(spark, [(1, "b", 1)]), ["id"], 2, T2)
    back = up.hash_upsert(changed, frame(spark, [(1, "a", 1)]), ["id"], 3, T3, label="change")
    assert back.first()["change"] == "update" and back.first()["name"] == "a"


def test_null_and_na_are_different_values(spark):
    target = first_load(spark, [(1, None, 1)])
    out = up.hash_upsert(target, frame(spark, [(1, "NA", 1)]), ["id"], 2, T2, label="change")
    assert out.first()["change"] == "update"


def test_repeated_source_key_raises_or_takes_the_last(spark, rows):
    target = first_load(spark, [(1, "a", 1)])
    source = frame(spark, [(1, "x", 5), (1, "y", 6)])
    with pytest.raises(PySparkException, match="repeated source key"):
        up.hash_upsert(target, source, ["id"], 2, T2).collect()
    assert rows(up.hash_upsert(target, source, ["id"], 2, T2, order=["qty"]), *SCHEMA.replace(" int", "").replace(" string", "").split(", ")) == [(1, "y", 6)]


def test_mark_deleted_and_return(spark):
    target = first_load(spark, [(1, "a", 1), (2, "b", 2)])
    gone = up.hash_upsert(target, frame(spark, [(1, "a", 1)]), ["id"], 2, T2, mark_deleted=True, label="c")
    got = {r["id"]: (r["c"], r["IsDeleted"]) for r in gone.collect()}
    assert got == {1: ("same", False), 2: ("delete", True)}
    again = up.hash_upsert(gone.drop("c"), frame(spark, [(1, "a", 1)]), ["id"], 3, T3, mark_deleted=True, label="c")
    assert {r["id"]: r["c"] for r in again.collect()} == {1: "same", 2: "kept"}
    back = up.hash_upsert(gone.drop("c"), frame(spark, [(1, "a", 1), (2, "b", 2)]), ["id"], 4, T3, label="c")
    assert {r["id"]: (r["c"], r["IsDeleted"]) for r in back.collect()} == {1: ("same", False), 2: ("update", False)}


def test_composite_and_blank_null_keys(spark, rows):
    schema = "a string, b int, v int"
    target = first_load(spark, [(None, 1, 10), ("x", 1, 20)], schema)
    source = frame(spark, [("", 1, 11), ("x", 2, 30)], schema)
    out = up.hash_upsert(target.withColumn("b", F.col("b")), source.withColumn("b", F.col("b").cast("int")), ["a"], 2, T2,
                         blank_null_keys=True, order=["v"], label="c")
    assert {r["c"] for r in out.collect()} == {"update"}
    both = up.hash_upsert(target, source, ["a", "b"], 2, T2, label="c")
    assert sorted(r["c"] for r in both.collect()) == ["insert", "insert", "kept", "kept"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_any_number_of_business_columns(spark, n):
    cols = [f"c{i}" for i in range(n)]
    schema = "id int, " + ", ".join(f"{c} string" for c in cols)
    target = first_load(spark, [(1, *"v" * n)], schema)
    for i in range(n):
        row = (1, *["w" if j == i else "v" for j in range(n)])
        out = up.hash_upsert(target, frame(spark, [row], schema), ["id"], 2, T2, label="c")
        assert out.first()["c"] == "update"


def test_load_table_chooses_by_keys(spark):
    target = first_load(spark, [(1, "a", 1), (9, "z", 9)])
    source = frame(spark, [(1, "b", 1)])
    assert up.load_table(source, target, ["id"], 2, T2).count() == 2
    for keys in ([], ["id", "name", "qty"]):
        out = up.load_table(source, target, keys, 2, T2)
        assert out.count() == 1 and out.first()["HashValue"] == "0" and out.first()["IsDeleted"] is False


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.sampled_from(["", "NA", "x", "x|y"])), max_size=8),
       st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.sampled_from(["", "NA", "x", "x|y"])), max_size=8))
def test_upsert_equals_dictionary_update(spark, old, new):
    schema = "id int, v string"
    target = first_load(spark, list(old.items()), schema)
    out = up.hash_upsert(target, frame(spark, list(new.items()), schema), ["id"], 2, T2, label="c")
    got = out.collect()
    assert {r["id"]: r["v"] for r in got} == old | new
    counts = {s: sum(r["c"] == s for r in got) for s in ("insert", "update", "same")}
    assert counts["insert"] == len(new.keys() - old.keys())
    assert counts["update"] == sum(old[k] != new[k] for k in old.keys() & new.keys())
    assert sum(counts.values()) == len(new)


def test_dimension_null_attribute_overwrites(spark, rows):
    dim = frame(spark, [(1, "old", 1), (2, "keep", 2)], "k int, n string, t int")
    src = frame(spark, [(1, None, 7), (3, "new", None)], "sk int, sn string, st int")
    out = up.dim_upsert(dim, src, {"k": "sk"}, {"n": "sn", "t": "st"}, label="c")
    assert rows(out) == [(1, None, 7, "update"), (2, "keep", 2, "kept"), (3, "new", None, "insert")]


CHANGES = "id int, name string, `__$operation` int, `__$start_lsn` binary, `__$seqval` binary"


def feed(spark, rows):
    return frame(spark, [(i, n, op, lsn, seq) for i, n, op, lsn, seq in rows], CHANGES)


ORDER = ["__$start_lsn", "__$seqval"]


def test_change_feed_last_change_decides(spark, rows):
    target = frame(spark, [(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    changes = feed(spark, [
        (9, "n", 2, b"\x01", b"\x01"), (9, "m", 3, b"\x02", b"\x01"), (9, "m", 4, b"\x02", b"\x02"),  # insert, then update
        (1, None, 1, b"\x03", b"\x01"),                                                              # delete
        (2, "x", 4, b"\x04", b"\x01"), (2, "y", 4, b"\x04", b"\x02"),                               # one LSN, two steps
        (5, "u", 4, b"\x05", b"\x01"),                                                               # update of an unknown key
        (3, "no", 3, b"\x06", b"\x01"),                                                              # before-image only
        (3, "null lsn", 4, None, b"\x01")])
    valid = up.valid_changes(changes)
    once = up.apply_cdc(target, valid, ["id"], ORDER)
    assert rows(once) == [(2, "y"), (3, "c"), (5, "u"), (9, "m")]
    assert rows(up.apply_cdc(once, valid, ["id"], ORDER)) == rows(once)


def test_change_feed_compatible_codes(spark, rows):
    target = frame(spark, [(1, "a"), (2, "b")], "id int, name string")
    changes = feed(spark, [(1, "x", 3, b"\x01", b"\x01"), (2, "y", 2, b"\x02", b"\x01"), (3, "z", 2, b"\x03", b"\x01"),
                           (4, "w", 3, b"\x04", b"\x01"), (1, "d", 1, b"\x05", b"\x01")])
    out = up.apply_cdc(target, changes, ["id"], ORDER, ops=up.COMPAT_OPS, strict=True)
    assert rows(out) == [(1, "x"), (2, "b"), (3, "z")]


def test_strict_feed_keeps_a_new_key_that_is_updated_at_once(spark, rows):
    target = frame(spark, [(1, "a"), (2, "b")], "id int, name string")
    steps = [(9, "i", 2), (9, "u", 3), (8, "u", 3), (8, "i", 2), (1, "i", 2), (2, "x", 3), (2, "y", 3)]
    changes = feed(spark, [(k, n, op, bytes([at]), b"\x00") for at, (k, n, op) in enumerate(steps)])
    out = up.apply_cdc(target, changes, ["id"], ORDER, ops=up.COMPAT_OPS, strict=True)
    assert rows(out) == [(1, "a"), (2, "y"), (8, "i"), (9, "u")]
    full = [(1, None, 1), (1, "n", 2), (2, "z", 4), (2, None, 1), (7, "u", 4), (6, "i", 2), (6, None, 1)]
    changes = feed(spark, [(k, n, op, bytes([at]), b"\x00") for at, (k, n, op) in enumerate(full)])
    assert rows(up.apply_cdc(target, changes, ["id"], ORDER, strict=True)) == [(1, "n")]


def test_null_keys_are_refused_or_matched(spark, rows):
    schema = "a int, b int, v string"
    target, source = first_load(spark, [], schema), frame(spark, [(1, None, "x"), (1, 2, "y")], schema)
    for load in (lambda: up.hash_upsert(target, source, ["a", "b"], 2, T2), lambda: up.upsert_counts(source, target, ["a", "b"]),
                 lambda: up.dim_upsert(source, source, {"a": "a", "b": "b"}, {"v": "v"}),
                 lambda: up.apply_cdc(source, source.withColumn("__$operation", F.lit(2)), ["a", "b"], ["v"])):
        with pytest.raises(PySparkException, match="NULL in the source key"):
            load().collect()
    for _ in range(3):
        target = up.hash_upsert(target, source, ["a", "b"], 2, T2, null_keys="match")
    assert target.count() == 2
    assert rows(up.upsert_counts(source, target, ["a", "b"], null_keys="match")) == [(0, 0)]
    blank = up.hash_upsert(first_load(spark, [(None, None, "p")], "a string, b bigint, v string"), frame(spark, [("", None, "q")], "a string, b bigint, v string"),
                           ["a", "b"], 2, T2, blank_null_keys=True, label="c")
    assert [r["c"] for r in blank.collect()] == ["update"]


def test_counts_agree_when_a_flagged_row_returns(spark, rows):
    gone = up.hash_upsert(first_load(spark, [(1, "a", 1)]), frame(spark, []), ["id"], 2, T2, mark_deleted=True)
    assert rows(up.upsert_counts(frame(spark, [(1, "a", 1)]), gone, ["id"])) == [(1, 0)]


def test_hash_tells_microseconds_apart_and_ignores_the_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.000100' AS a, timestamp'2024-01-01 00:00:00.000900 UTC' AS b")
    other = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.000101' AS a, timestamp'2024-01-01 00:00:00.000900 UTC' AS b")
    zone, seen = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            seen.add(df.select(up.row_hash(["a", "b"])).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(seen) == 1 and other.select(up.row_hash(["a", "b"])).first()[0] not in seen


def test_hot_key_collapses_before_the_shuffle(spark, plan):
    changes = spark.range(1000).select(F.lit(1).alias("id"), F.col("id").alias("v"))
    text = plan(up.one_per_key(changes, ["id"], ["v"]))
    assert "partial_max_by" in text


def test_full_reload(spark, rows):
    out = up.full_reload(frame(spark, [(1, "a", 1)]), 5, T2)
    row = out.first()
    assert (row["HashValue"], row["IsDeleted"], row["ETLCreatedBatchID"], row["ETLModifiedBatchID"]) == ("0", False, 5, 5)
