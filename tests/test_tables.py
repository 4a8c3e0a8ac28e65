import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import apply_cdc, hash_upsert, stamp_audit_cols
from tidemark.session import scratch_path
from tidemark.streaming import ingest
from tidemark.tables.aggregates import Measures, RefreshedAggregate
from tidemark.tables.checked import CheckedTable, Rules, RulesBroken, lines
from tidemark.tables.commits import CommitLog, Conflict
from tidemark.tables.files import FileTable
from tidemark.tables.ingest import FileIngest
from tidemark.tables.keyed import KeyedTable
from tidemark.tables.ranges import RangeTable

T1, T2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"


def names(table):
    return {r[0] for r in table.files().select("file").collect()}


def spoil(table, files):
    """Overwrite files, so that a read of one would fail."""
    for name in files:
        with open(f"{table.path}/{name}", "wb") as f:
            f.write(b"not parquet")


def test_a_commit_number_is_given_once(spark):
    log = CommitLog(spark, scratch_path(spark, "log"))
    assert log.last() == (-1, None)
    assert log.commit(-1, {"a": 1}) == 0 and log.commit(0, {"a": 2}) == 1
    with pytest.raises(Conflict):
        log.commit(0, {"a": 3})
    assert log.last() == (1, {"a": 2}) and list(log.backwards()) == [{"a": 2}, {"a": 1}]


def test_commits_of_many_threads_exclude_each_other(spark):
    from concurrent.futures import ThreadPoolExecutor

    log = CommitLog(spark, scratch_path(spark, "log"))
    log.commit(-1, {})

    def attempt(k):
        try:
            return log.commit(0, {"k": k})
        except Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [k for k, v in enumerate(pool.map(attempt, range(16))) if v is not None]
    assert len(won) == 1 and log.last() == (1, {"k": won[0]})


def events(spark, days, first=1):
    return spark.createDataFrame([(100 * d + i, dt.datetime(2024, 1, d, i)) for d in days for i in range(3)] + [(100 * days[0] + 99, None)],
                                 "id int, at timestamp_ntz")


def test_zone_map_bounds_windows_without_a_scan(spark, rows):
    table = FileTable(spark, scratch_path(spark, "t"), "at")
    assert table.high_water() is None and table.null_watermarks() == 0
    for batch, days in enumerate(([1, 2], [3], [4, 5])):
        table.append(events(spark, days).coalesce(1), batch)
    assert table.append(events(spark, [9]), 2) is None  # a replay adds nothing
    assert table.read().count() == 3 * 5 + 3
    outside = {r.file for r in table.files().collect() if r.high < "2024-01-03" or r.low >= "2024-01-04"}
    middle = names(table) - outside
    spoil(table, outside)
    assert table.high_water() == dt.datetime(2024, 1, 5, 2) and table.null_watermarks() == 3
    window = table.window("2024-01-02 02:00:00", "2024-01-03 01:00:00")
    assert rows(window, "id") == [(300,), (301,)]
    assert {f.rpartition("/")[2] for f in window.inputFiles()} == {f.rpartition("/")[2] for f in middle}
    assert rows(table.window("2024-01-03 00:00:00", "2024-01-03 01:00:00", inclusive=True), "id") == [(300,), (301,)]
    assert table.window("2024-01-06", "2024-01-07").count() == 0


def test_window_moves_back_by_days(spark, rows):
    table = FileTable(spark, scratch_path(spark, "t"), "at")
    table.append(events(spark, [1, 2, 3]))
    assert rows(table.window("2024-01-03 01:00:00", lookback_days=1), "id") == [(202,), (300,), (301,), (302,)]


def customers(spark, ids, v="a"):
    return spark.createDataFrame([(i, f"{v}{i}") for i in ids], "id int, v string")


def test_upsert_leaves_untouched_parts_alone_and_equals_a_full_rewrite(spark, rows):
    table = KeyedTable(spark, scratch_path(spark, "t"), ["id"], parts=50)
    assert table.upsert(customers(spark, range(500)), 1, T1)["RowsInserted"] == 500
    before = table.files().select("part", "file").collect()
    source = customers(spark, [7], "b").union(customers(spark, [7000]))
    touched = set(table.touched(source))
    spoil(table, [r.file for r in before if r.part not in touched])  # not even read
    counts = table.upsert(source, 2, T2)
    assert (counts["RowsInserted"], counts["RowsUpdated"]) == (1, 1)
    after = {r.file for r in table.files().collect()}
    assert {r.file for r in before if r.part not in touched} <= after
    assert not {r.file for r in before if r.part in touched} & after


@pytest.mark.parametrize("mark_deleted", [False, True])
def test_upserts_equal_full_rewrites(spark, rows, mark_deleted):
    table, full = KeyedTable(spark, scratch_path(spark, "t"), ["id"], parts=7), None
    draw = random.Random(3)
    for batch in range(1, 4):
        source = customers(spark, draw.sample(range(100), 60), draw.choice("ab"))
        now = f"2025-0{batch}-01 00:00:00"
        table.upsert(source, batch, now, mark_deleted=mark_deleted)
        full = stamp_audit_cols(source, batch, now) if full is None else hash_upsert(full, source, ["id"], batch, now, mark_deleted=mark_deleted)
        assert rows(table.read()) == rows(full)


def feed(spark, data):
    return spark.createDataFrame(data, "id int, v string, op int, at int")


def test_deltas_read_nothing_of_the_table_and_compaction_forgets_them(spark, rows):
    table = KeyedTable(spark, scratch_path(spark, "t"), ["id"], parts=5)
    base = customers(spark, range(40))
    table.create(base)
    draw, want = random.Random(1), base
    backup = {f: open(f"{table.path}/{f}", "rb").read() for f in names(table)}
    spoil(table, backup)
    for batch in range(4):
        data = [(draw.randrange(60), f"n{batch}.{k}", draw.choice([1, 2, 4, 3]), k) for k in range(30)]
        sizes = table.files().where("kind = 'base'").count()
        assert table.apply(feed(spark, data), batch, ["at"], op_col="op") is not None
        assert table.apply(feed(spark, data), batch, ["at"], op_col="op") is None
        assert table.files().where("kind = 'base'").count() == sizes
        want = apply_cdc(want, feed(spark, data), ["id"], ["at"], op_col="op")
    for f, data in backup.items():
        with open(f"{table.path}/{f}", "wb") as out:
            out.write(data)
    merged = rows(want)
    assert rows(table.read()) == merged
    assert table.compact() > 0 and table.compact() == 0
    assert table.files().where("kind = 'delta'").isEmpty() and rows(table.read()) == merged
    assert table.apply(feed(spark, [(1, "late", 2, 1)]), 3, ["at"], op_col="op") is None  # remembered after compaction


def test_a_delta_that_arrives_during_compaction_stays(spark, rows, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "t"), ["id"], parts=3)
    table.create(customers(spark, range(6)))
    table.apply(feed(spark, [(1, "x", 4, 1)]), 0, ["at"], op_col="op")
    other, store = KeyedTable(spark, table.path, ["id"], parts=3), table.write_files

    def meanwhile(*args):
        monkeypatch.setattr(table, "write_files", store)
        other.apply(feed(spark, [(1, "y", 4, 1), (2, None, 1, 1)]), 1, ["at"], op_col="op")
        return store(*args)

    monkeypatch.setattr(table, "write_files", meanwhile)
    table.compact()
    assert rows(table.read()) == [(0, "a0"), (1, "y"), (3, "a3"), (4, "a4"), (5, "a5")]
    assert not table.files().where("kind = 'delta'").isEmpty()


def test_two_upserts_at_once_conflict(spark, rows, monkeypatch):
    table = KeyedTable(spark, scratch_path(spark, "t"), ["id"], parts=3)
    table.upsert(customers(spark, range(6)), 1, T1)
    other, store = KeyedTable(spark, table.path, ["id"], parts=3), table.write_files

    def meanwhile(*args):
        monkeypatch.setattr(table, "write_files", store)
        other.upsert(customers(spark, [1], "b"), 2, T2)
        return store(*args)

    monkeypatch.setattr(table, "write_files", meanwhile)
    with pytest.raises(Conflict):
        table.upsert(customers(spark, [1], "c"), 3, T2)
    assert rows(table.read(), "id", "v")[1] == (1, "b1")


def test_vacuum_keeps_the_files_in_force(spark, rows):
    table = KeyedTable(spark, scratch_path(spark, "t"), ["id"], parts=3)
    for batch in range(1, 5):
        table.upsert(customers(spark, range(9), "abcd"[batch - 1]), batch, T1)
    before = rows(table.read())
    assert table.vacuum(keep=1) > 0 and rows(table.read()) == before and table.vacuum(keep=1) == 0


def test_null_and_blank_text_keys_share_a_part(spark):
    table = KeyedTable(spark, "unused", ["k"], parts=64)
    assert len(table.touched(spark.createDataFrame([("",), (None,)], "k string"))) == 1


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_each_file_is_read_once_and_a_changed_one_again(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "id int, v string").schema
    tree, table = tmp_path / "in", FileIngest(spark, scratch_path(spark, "t"), schema)
    put(tree / "a" / "x.csv", "id,v\n1,a\n")
    put(tree / "b c" / "y+z.csv", "id,v\n2,b\n3,c\n")
    put(tree / "b c" / "other.txt", "no")
    assert table.run(str(tree), "*.csv") == 2 and table.run(str(tree), "*.csv") == 0
    version, opened = table.state()["version"], []
    table.reader = lambda r, names: opened.extend(names) or r.option("header", True).csv(names)
    put(tree / "a" / "x.csv", "id,v\n1,changed\n4,d\n")
    put(tree / "new" / "w.csv", "id,v\n5,e\n")
    assert table.run(str(tree), "*.csv") == 2
    assert sorted(n.rpartition("/")[2] for n in opened) == ["w.csv", "x.csv"]
    assert rows(table.read(), "id", "v") == [(1, "changed"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]
    assert rows(table.read(table.log.read(version)), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]  # the earlier commit still reads as it was


def test_two_ingests_at_once_conflict(spark, rows, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "id int, v string").schema
    put(tmp_path / "x.csv", "id,v\n1,a\n")
    table, other = (FileIngest(spark, scratch_path(spark, "t") if k else "", schema) for k in (1, 0))
    other.path, other.log = table.path, table.log
    write = table.write_files
    monkeypatch.setattr(table, "write_files", lambda df: (other.run(str(tmp_path), "*.csv"), write(df))[1])
    with pytest.raises(Conflict):
        table.run(str(tmp_path), "*.csv")
    assert rows(table.read(), "id", "v") == [(1, "a")]


def test_checks_are_measured_and_routed_in_one_pass(spark, rows, tmp_path, plan):
    put(tmp_path / "x.csv", "id,v,n\n1,a,5\n2,toolong,6\nbad,b,7\n3,,-1\n4,d,8,9\n")
    schema = spark.createDataFrame([], "id int, v string, n int").schema
    rules = Rules({"positive": F.col("n") > 0}, required=("v",), limits={"v": 3}, unique=("id",), budget=4)
    table = CheckedTable(spark, scratch_path(spark, "t"))
    report = table.load(lines(spark, str(tmp_path), schema), rules)
    assert (report["rows"], report["failed"]) == (5, 4)
    assert report["rules"] == {"v is missing": 1, "v is longer than 3": 1, "malformed": 2, "positive": 1}
    assert rows(table.read()) == [(1, "a", 5)]
    bad = table.quarantine(report)
    assert {r["source_file"] for r in bad.collect()} == {"x.csv"}
    assert sorted(r["failed_rules"] for r in bad.collect()) == [["malformed"], ["malformed"], ["v is longer than 3"], ["v is missing", "positive"]]
    assert sorted(r["_corrupt_record"] for r in bad.collect() if r["_corrupt_record"]) == ["4,d,8,9", "bad,b,7"]
    assert plan(lines(spark, str(tmp_path), schema)).count("Scan csv") == 2  # one node, named in the tree and in the details


@pytest.mark.parametrize("rules, data, message", [
    (Rules(required=("v",), budget=1), [(1, None), (2, None)], "2 of 2 rows fail"),
    (Rules(required=("v",), budget=0.4), [(1, None), (2, "b")], "1 of 2 rows fail"),
    (Rules(unique=("id",)), [(1, "a"), (1, "b")], "keys are repeated"),
    (Rules(least=3), [(1, "a")], "fewer than 3"),
    (Rules(required=("w",)), [(1, "a")], "missing columns")])
def test_a_load_past_its_budget_is_not_published(spark, rules, data, message):
    table = CheckedTable(spark, scratch_path(spark, "t"))
    table.load(spark.createDataFrame([(0, "kept")], "id int, v string"), Rules())
    with pytest.raises(RulesBroken, match=message):
        table.load(spark.createDataFrame(data, "id int, v string"), rules)
    assert table.read().collect() == [(0, "kept")]


def test_refreshed_aggregates_equal_recomputation(spark, rows):
    kept = RefreshedAggregate(spark, scratch_path(spark, "t"), ["g"], Measures({"s": "x"}, {"v": "v"}), parts=3)
    draw, live = random.Random(4), []
    for batch in range(1, 5):
        gone = draw.sample(live, len(live) // 2)
        new = [(draw.choice(["a", "b", None, f"only{batch}"]), draw.choice([1.5, -2.25, None, 7.0]), draw.choice(["p", "q", "r", None])) for _ in range(12)]
        for r in gone:
            live.remove(r)
        live += new
        feed = [(*r, 1) for r in new] + [(*r, -1) for r in gone]
        kept.refresh(spark.createDataFrame(feed, "g string, x double, v string, weight int"), batch)
        kept.refresh(spark.createDataFrame(feed, "g string, x double, v string, weight int"), batch)  # a replay
        want = spark.createDataFrame(live, "g string, x double, v string").groupBy("g").agg(
            F.count("*"), F.sum(F.col("x").cast("decimal(38,4)")).cast("double"), F.count("x"), F.countDistinct("v"), F.min("v"), F.max("v"))
        assert rows(kept.read().withColumn("s", F.col("s").cast("double"))) == rows(want)


def test_a_refresh_leaves_other_parts_alone(spark):
    kept = RefreshedAggregate(spark, scratch_path(spark, "t"), ["g"], Measures({"s": "x"}), parts=40)
    kept.refresh(spark.createDataFrame([(g, 1.0, 1) for g in range(300)], "g int, x double, weight int"), 1)
    change = spark.createDataFrame([(7, 2.0, 1)], "g int, x double, weight int")
    own = set(kept.groups.touched(change))
    others = {r.file for r in kept.groups.files().collect() if r.part not in own}
    spoil(kept.groups, others)
    kept.refresh(change, 2)
    assert others <= names(kept.groups) and len(own) == 1


def test_ranges_are_pruned_replaced_and_dropped(spark, rows, plan):
    bounds = [dt.date(2024, m, 1) for m in (2, 3, 4)]
    table = RangeTable(spark, scratch_path(spark, "t"), "day", bounds)
    data = spark.createDataFrame([(m, dt.date(2024, m, 15)) for m in range(1, 6)] + [(0, None)], "id int, day date")
    table.append(data, 1)
    assert table.append(data, 1) is None
    window = table.between(dt.date(2024, 2, 10), dt.date(2024, 3, 20))
    assert rows(window, "id") == [(2,), (3,)]
    assert "part__" in plan(window).split("PartitionFilters")[1].split("\n")[0]
    assert {r.part for r in table.files().collect()} == {0, 1, 2, 3}
    others = {r.file for r in table.files().collect() if r.part != 1}
    table.switch(1, spark.createDataFrame([(20, dt.date(2024, 2, 1))], "id int, day date"))
    assert others <= names(table) and sorted(r.id for r in table.between().collect()) == [0, 1, 3, 4, 5, 20]
    with pytest.raises(Exception, match="lies in range"):
        table.switch(1, spark.createDataFrame([(20, dt.date(2024, 3, 1))], "id int, day date"))
    table.switch(0)
    assert sorted(r.id for r in table.read().collect()) == [3, 4, 5, 20]


def test_messages_are_unique_over_batches_and_restarts(spark, rows, tmp_path):
    schema = spark.createDataFrame([], "messageid string, v string, timestamp string").schema
    sent = [['{"messageid":"1","v":"a","timestamp":"2024-01-01 00:00:00"}', '{"messageid":"1","v":"a","timestamp":"2024-01-01 00:00:00"}', '{"messageid":'],
            ['{"messageid":"2","v":"b","timestamp":"2024-01-01 00:01:00"}', '{"messageid":"1","v":"a","timestamp":"2024-01-01 00:00:00"}', '{"v":"no id"}'],
            ['{"messageid":"2","v":"b","timestamp":"2024-01-01 00:01:00"}', None, '{"messageid":"3","v":"c"}', '{"messageid":"4","v":"d","timestamp":"2024-01-01 00:02:00"}']]
    folder, path, checkpoint = str(tmp_path / "in"), scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    for batch in sent:
        spark.createDataFrame([(b,) for b in batch], "body string").coalesce(1).write.mode("append").parquet(folder)
        source = ingest.stream_source(spark, "parquet", spark.createDataFrame([], "body string").schema, folder)
        for landing in ingest.land_messages(source, schema, "messageid", "timestamp", "1 day", path, checkpoint, available_now=True):
            landing.awaitTermination()
    assert rows(spark.read.schema(schema).parquet(f"{path}/messages"), "messageid", "v") == [("1", "a"), ("2", "b"), ("4", "d")]
    assert rows(spark.read.schema("malformed_body string").parquet(f"{path}/malformed")) == [('{"messageid":',), ('{"messageid":"3","v":"c"}',), ('{"v":"no id"}',), (None,)]
