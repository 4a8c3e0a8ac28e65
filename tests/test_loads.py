"""Watermarks, ledger, control rows, whole load jobs and crash recovery."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.ledger import audit, control
from tidemark.operators import incremental as inc
from tidemark.plans import loads
from tidemark.session import scratch_path
from tidemark.tables.commits import Conflict
from tidemark.tables.files import FileTable

T1, T2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"


def ticking():
    moment = [dt.datetime(2025, 1, 1)]

    def clock():
        moment[0] += dt.timedelta(seconds=2)
        return moment[0]

    return clock


@pytest.fixture
def ledger(spark):
    return audit.Ledger(spark, scratch_path(spark, "ledger"), clock=ticking())


@pytest.fixture
def source(spark):
    data = [(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 1, 2)), (3, "c", dt.datetime(2024, 1, 2)),
            (4, "d", dt.datetime(2024, 1, 3)), (5, "e", None)]
    return spark.createDataFrame(data, "id int, v string, `Last Modified` timestamp_ntz")


def test_window_bounds(source, rows):
    low, high = "2024-01-01", "2024-01-02"
    assert rows(inc.incremental(source, "last_modified", low, high), "id") == [(2,), (3,)]
    assert rows(inc.incremental(source, "Last_Modified", low, high, inclusive=True), "id") == [(1,), (2,), (3,)]
    assert rows(inc.incremental(source, "Last Modified", "2024-01-02"), "id") == [(4,)]
    assert rows(inc.incremental(source, "Last Modified", "2024-01-03"), "id") == []
    assert rows(inc.incremental(source, "Last Modified", "2024-01-03", "2024-01-03", lookback_days=1), "id") == [(4,)]
    with pytest.raises(KeyError):
        inc.incremental(source, "absent", low)
    assert rows(inc.null_watermarks(source, "Last Modified"), "id") == [(5,)]


def test_bounds_reach_the_scan(tables, plan):
    text = plan(inc.incremental(tables.events, "ts", "2024-01-10", "2024-01-20"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in text


def test_split_increments_equal_one_load(tables):
    whole = inc.incremental(tables.events, "ts", "1900-01-01", "2024-01-30")
    steps = ["1900-01-01", "2024-01-05", "2024-01-06 12:00:00", "2024-01-30"]
    parts = [inc.incremental(tables.events, "ts", a, b) for a, b in zip(steps, steps[1:])]
    assert sum(p.count() for p in parts) == whole.count()
    assert parts[0].unionByName(parts[1]).unionByName(parts[2]).exceptAll(whole).isEmpty()


def test_bounds_do_not_shift_with_the_session_zone(spark, source, rows):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows(inc.incremental(source, "Last Modified", dt.datetime(2024, 1, 1)), "id") == [(2,), (3,), (4,)]
        assert inc.high_water(source, "Last Modified") == dt.datetime(2024, 1, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_advance_touches_one_object(spark, rows):
    marks = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1))],
                                  "table_name string, last_loaded_ts timestamp_ntz")
    out = inc.advance(marks, "a", dt.datetime(2024, 6, 1))
    assert rows(out) == [("a", dt.datetime(2024, 6, 1)), ("b", dt.datetime(2024, 1, 1))]


def test_control_lookup_ignores_case(spark):
    rows = spark.createDataFrame([(1, "encounters", "Bronze"), (2, "patients", "Bronze")],
                                 "Controlid int, SourceObjectName string, DestinationZone string")
    assert inc.control_for(rows, "Patients", "bronze")["Controlid"] == 2
    assert inc.control_for(rows, "Patients", "Gold") is None


def test_extract_blanks_unsupported_columns(source, rows):
    out = inc.extract(source, ("2024-01-01", "2024-01-02"), ["id", "v"], ["V"], "Last Modified")
    assert rows(out) == [(2, ""), (3, "")]


def test_ledger_states(ledger):
    one = ledger.start(ETLControlID=1, Source="s")
    two = ledger.start(ETLControlID=1, Source="s")
    three = ledger.start(ETLControlID=1, Source="s")
    ledger.complete(one, RowsInserted=3, RowsUpdated=0)
    ledger.fail(two, "boom")
    runs = {r["ETLAuditLogID"]: r for r in ledger.runs().collect()}
    assert (runs[one]["LoadStatus"], runs[one]["IsLoadSuccess"], runs[one]["RowsInserted"]) == ("Completed", True, 3)
    assert (runs[two]["LoadStatus"], runs[two]["ErrorMsg"]) == ("Failed", "boom")
    assert runs[three]["LoadStatus"] == "Started"
    assert runs[one]["RunTimeInSecond"] == 6 and runs[one]["ETLStartTime"] < runs[one]["ETLEndTime"]
    with pytest.raises(KeyError):
        ledger.complete(123)


def test_audit_wrapper_logs_and_rethrows(ledger):
    with pytest.raises(ZeroDivisionError):
        with audit.with_audit(ledger, ETLControlID=1):
            1 / 0
    with audit.with_audit(ledger, ETLControlID=1) as counts:
        counts["RowsInserted"] = 7
    states = sorted((r["LoadStatus"], r["ErrorMsg"], r["RowsInserted"]) for r in ledger.runs().collect())
    assert states == [("Completed", None, 7), ("Failed", "division by zero", None)]


LOG = ("ETLControlID int, LoadType string, IsLoadSuccess boolean, RowsInserted bigint, ETLMaxValue string, "
       "ETLStartTime timestamp_ntz")


def day(n):
    return dt.datetime(2025, 1, n)


def low(spark, log, load_type, kind, high, detect="LOAD_DATE", lookback=0, **extra):
    logs = spark.createDataFrame(log, LOG)
    row = {"ETLControlID": 1, "LoadType": load_type, "DeltaDetectType": kind, "DeltaDetect": detect, "ETLMaxValue": high} | extra
    ctl = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'int' if k == 'ETLControlID' else 'string'}" for k in row))
    out = audit.resolve_low(logs, ctl, lookback).first()
    return out["ETLMinValue"], out["ETLMaxValue"]


HISTORY = [(1, "Incremental", True, 5, "2025-01-03 00:00:00.000", day(3)),
           (1, "Incremental", True, 0, "2025-01-08 00:00:00.000", day(8)),    # no rows: ignored
           (1, "Incremental", False, 9, "2025-01-09 00:00:00.000", day(9)),   # failed: ignored
           (2, "Incremental", True, 9, "2025-01-20 00:00:00.000", day(20))]   # another object


def test_low_bound_of_predicate_loads(spark):
    assert low(spark, HISTORY, "Incremental", "Predicate", "2025-02-01")[0] == "2025-01-03 00:00:00.000"
    assert low(spark, [], "Incremental", "Predicate", "2025-02-01")[0] == "1900-01-01 00:00:00.000"
    assert low(spark, HISTORY, "Full", "Predicate", "2025-02-01")[0] == "1900-01-01 00:00:00.000"
    assert low(spark, HISTORY, "Incremental", "Predicate", "2025-02-01", lookback=2)[0] == "2025-01-01 00:00:00.000"
    numbers = [(1, "Incremental", True, 5, v, day(3)) for v in ("9", "10")]
    assert low(spark, numbers, "Incremental", "Predicate", "11", detect="ROW_ID")[0] == "10"
    assert low(spark, [], "Full", "Predicate", "11", detect="ROW_ID")[0] == "0"


def test_low_bound_resets_when_not_below_high(spark):
    assert low(spark, HISTORY, "Incremental", "Predicate", "2025-01-03")[0] == "1900-01-01"
    numbers = [(1, "Incremental", True, 5, "10", day(3))]
    assert low(spark, numbers, "Incremental", "Predicate", "9", detect="ROW_ID")[0] == "1900-01-01"
    # As text "10" < "9" and the reset would be missed the other way round.
    assert low(spark, [(1, "Incremental", True, 5, "9", day(3))], "Incremental", "Predicate", "10", detect="ROW_ID")[0] == "9"


def test_low_bound_of_change_tracking(spark):
    log = [(1, "Incremental", True, 5, "90", day(1)), (1, "Full", True, 5, "40", day(2)), (1, "Incremental", True, 5, "50", day(3))]
    assert low(spark, log, "Incremental", "ChangeTracking", "100")[0] == "50"
    assert low(spark, log[:1], "Incremental", "ChangeTracking", "100")[0] == "90"
    assert low(spark, [], "Incremental", "ChangeTracking", "100")[0] == "0"
    assert low(spark, log, "Full", "ChangeTracking", "100")[0] == "0"


def test_adhoc_bounds_and_missing_high(spark):
    assert low(spark, HISTORY, "Adhoc", "Predicate", "x", AdhocMin="2020-01-01", AdhocMax="2020-02-01") == ("2020-01-01", "2020-02-01")
    assert low(spark, HISTORY, "Incremental", "Predicate", "-1") == ("2025-01-03 00:00:00.000", None)


def test_control_rows_are_registered_once(spark):
    spec = spark.createDataFrame([("CRM", "dbo", "/a/b", "Source", 1, "Predicate", "LOAD_DATE"), ("CRM", "dbo", "t", "Fact", 1, None, None)],
                                 "SourceSystem string, SourceSchema string, SourceTable string, TableType string, SourceTypeID int, "
                                 "DeltaDetectType string, QueryPredicate string")
    rows = control.control_rows(spec, "2025-01-01", T1)
    assert rows.filter("TableType = 'Source'").first()["Sink"] == \
        '[{"FileSink":{"FilePath":"a_b\\\\YYYY\\\\MM\\\\DD\\\\","FileName":"a_b_*.parquet"}}]'
    empty = spark.createDataFrame([], rows.schema)
    once = control.register_source(empty, rows, "c")
    twice = control.register_source(once.drop("c"), control.control_rows(spec, "2025-01-01", T2), "c")
    assert [r[0] for r in once.select("c").collect()] == ["insert"] * 2
    assert [r[0] for r in twice.select("c").collect()] == ["update"] * 2
    assert {str(r[0]) for r in twice.select("UpdatedDate").collect()} == {T2}


SPEC = dict(control_id=1, name="things", keys=["id"], watermark="last_modified", columns=["id", "v"])


def later(spark, source):
    more = spark.createDataFrame([(2, "B", dt.datetime(2024, 1, 5)), (6, "f", dt.datetime(2024, 1, 6))], source.schema)
    return source.filter("id <> 2").unionByName(more)


def test_load_job_runs_increments(spark, source, ledger, rows):
    root = scratch_path(spark, "root")
    spec = loads.LoadSpec(**SPEC)
    assert loads.run_load(ledger, source, spec, root, 1, T1)["RowsInserted"] == 4
    second = loads.run_load(ledger, later(spark, source), spec, root, 2, T2)
    assert (second["RowsInserted"], second["RowsUpdated"]) == (1, 1)
    out = loads.current_table(ledger, spec)
    assert rows(out, "id", "v", "ETLCreatedBatchID") == [(1, "a", 1), (2, "B", 1), (3, "c", 1), (4, "d", 1), (6, "f", 2)]
    third = loads.run_load(ledger, later(spark, source), spec, root, 3, T2)
    assert (third["RowsInserted"], third["RowsUpdated"]) == (0, 0)


def test_crash_between_write_and_record_loses_and_doubles_nothing(spark, source, ledger, rows, monkeypatch):
    root = scratch_path(spark, "root")
    spec = loads.LoadSpec(**SPEC)
    loads.run_load(ledger, source, spec, root, 1, T1)
    before = rows(loads.current_table(ledger, spec))
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "complete", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loads.run_load(ledger, later(spark, source), spec, root, 2, T2)
    assert rows(loads.current_table(ledger, spec)) == before
    again = loads.run_load(ledger, later(spark, source), spec, root, 2, T2)
    assert (again["RowsInserted"], again["RowsUpdated"]) == (1, 1)
    assert loads.current_table(ledger, spec).count() == 5


def test_failed_job_keeps_the_published_table(spark, source, ledger, rows):
    root = scratch_path(spark, "root")
    spec = loads.LoadSpec(**SPEC)
    loads.run_load(ledger, source, spec, root, 1, T1)
    doubled = later(spark, source).unionByName(later(spark, source))
    with pytest.raises(Exception, match="repeated source key"):
        loads.run_load(ledger, doubled, spec, root, 2, T2)
    assert loads.current_table(ledger, spec).count() == 4
    failed = ledger.runs().filter("LoadStatus = 'Failed'").first()
    assert "repeated source key" in failed["ErrorMsg"]


def test_adhoc_window(spark, source, ledger, rows):
    root = scratch_path(spark, "root")
    spec = loads.LoadSpec(**SPEC)
    loads.run_load(ledger, source.filter("id = 1"), spec, root, 1, T1)
    loads.run_load(ledger, source, spec, root, 2, T2, bounds=("2024-01-01", "2024-01-02"))
    assert rows(loads.current_table(ledger, spec), "id") == [(1,), (2,), (3,)]
    run = ledger.runs().filter("LoadType = 'Adhoc'").first()
    assert (run["ETLMinValue"], run["ETLMaxValue"], run["LoadStatus"]) == ("2024-01-01", "2024-01-02", "Completed")


def test_throughput_is_recorded(ledger):
    run = ledger.start(ETLControlID=1)
    event = ledger.complete(run, FileSizeInBytes=1_000_000, RowsInserted=1)
    assert event["RunTimeInSecond"] == 2 and str(event["ThroughputInKbps"]) == "4000.00"
    assert str(ledger.runs().first()["ThroughputInKbps"]) == "4000.00"


def test_deletion_marks_need_a_whole_source(spark, source, ledger):
    spec = loads.LoadSpec(**SPEC, mark_deleted=True)
    with pytest.raises(ValueError):
        loads.run_load(ledger, source, spec, "unused", 1, T1)
    whole = loads.LoadSpec(3, "whole", keys=["id"], columns=["id", "v"], mark_deleted=True)
    root = scratch_path(spark, "root")
    loads.run_load(ledger, source, whole, root, 1, T1)
    assert loads.run_load(ledger, source.filter("id > 1"), whole, root, 2, T2)["RowsMarkedAsDeleted"] == 1
    assert loads.current_table(ledger, whole).filter("IsDeleted").first()["id"] == 1


def test_keyless_job_reloads(spark, source, ledger):
    spec = loads.LoadSpec(2, "keyless", columns=["id", "v"], watermark="last_modified")
    root = scratch_path(spark, "root")
    for batch in (1, 2):
        loads.run_load(ledger, source, spec, root, batch, T1)
    assert loads.current_table(ledger, spec).count() == source.count()


def test_observed_write_counts_in_the_same_job(spark):
    got = loads.observed_write(spark.range(10), scratch_path(spark, "o"), top=F.max("id"))
    assert got == {"rows": 10, "top": 9}


def test_zone_load_resumes_after_a_crash(spark, source, ledger, rows, monkeypatch):
    control_rows = spark.createDataFrame(
        [(1, "Things", "Gold", "Last_Modified", dt.datetime(2024, 1, 1)), (2, "Odd", "Gold", "absent", None),
         (1, "Things", "Bronze", "x", dt.datetime(2000, 1, 1))],
        "Controlid int, SourceObjectName string, DestinationZone string, IncrementalColumn string, LastWatermarkValue timestamp_ntz")
    root = scratch_path(spark, "zone")
    sources = {"things": source, "odd": source, "none": source, "all": source}
    # The data of the first run are written, but neither recorded nor marked; the next run has another batch id.
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "complete", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loads.load_zone(control_rows, sources, "Gold", root, 1, ledger, full=["all"])
    after, report = loads.load_zone(control_rows, sources, "Gold", root, 2, ledger, full=["all"])
    assert report == {"things": ("loaded", 3, 1), "odd": ("no column absent", 0, 0), "none": ("no control row", 0, 0), "all": ("loaded", 5, 0)}
    assert rows(loads.zone_table(ledger, "Gold", "things"), "id") == [(2,), (3,), (4,)]
    assert loads.zone_table(ledger, "Gold", "all", whole=True).count() == 5
    marks = {(r["SourceObjectName"], r["DestinationZone"]): r["LastWatermarkValue"] for r in after.collect()}
    assert marks["Things", "Gold"] == dt.datetime(2024, 1, 3) and marks["Things", "Bronze"] == dt.datetime(2000, 1, 1)
    # With the old control rows, as if the advanced ones were lost, nothing is loaded twice either.
    for rows_of in (after, control_rows):
        assert loads.load_zone(rows_of, {"things": source}, "Gold", root, 3, ledger)[1] == {"things": ("no new rows", 0, 1)}


def test_first_load_has_no_low_bound_and_reports_rows_without_watermark(spark, ledger, rows):
    odd = spark.createDataFrame([(1, dt.datetime(1800, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 1))], "id int, t timestamp_ntz")
    spec = loads.LoadSpec(4, "odd", keys=["id"], watermark="t")
    counts = loads.run_load(ledger, odd, spec, scratch_path(spark, "root"), 1, T1, audit={"PipelineName": "p", "ActivityName": "a"})
    assert (counts["RowsInserted"], counts["RowsWithoutWatermark"]) == (2, 1)
    run = ledger.runs().filter("ETLControlID = 4").first()
    assert (run["RowsWithoutWatermark"], run["PipelineName"], run["ActivityName"]) == (1, "p", "a")
    numbers = spark.createDataFrame([(1, -5), (2, 0), (3, 7)], "id int, n int")
    assert loads.run_load(ledger, numbers, loads.LoadSpec(6, "n", keys=["id"], watermark="n"), scratch_path(spark, "root"), 1, T1)["RowsInserted"] == 3


def test_a_run_refuses_to_publish_over_another(spark, source, ledger):
    spec, root = loads.LoadSpec(**SPEC), scratch_path(spark, "root")
    loads.run_load(ledger, source, spec, root, 1, T1)
    started, last = [], ledger.last_sink

    def meanwhile(control_id):
        started.append(last(control_id))
        if len(started) == 2:  # asked again before publishing: another run was faster
            ledger.last_sink = last
            loads.run_load(ledger, later(spark, source), spec, root, 3, T2)
        return last(control_id)

    ledger.last_sink = meanwhile
    with pytest.raises(RuntimeError, match="another run"):
        loads.run_load(ledger, later(spark, source), spec, root, 2, T2)
    assert loads.current_table(ledger, spec).count() == 5


def during(monkeypatch, ledger, other):
    """Run ``other`` when the next run of ``ledger`` is about to publish."""
    complete = ledger.complete

    def meanwhile(run_id, **counts):
        monkeypatch.setattr(ledger, "complete", complete)
        other()
        return complete(run_id, **counts)

    monkeypatch.setattr(ledger, "complete", meanwhile)


@pytest.mark.parametrize("parts", [None, 4])
def test_of_two_runs_of_an_object_one_publishes(spark, source, ledger, rows, monkeypatch, parts):
    spec, root = loads.LoadSpec(**SPEC, parts=parts), scratch_path(spark, "root")
    during(monkeypatch, ledger, lambda: loads.run_load(ledger, source, spec, root, 2, T1))
    with pytest.raises(Conflict):
        loads.run_load(ledger, source, spec, root, 1, T1)
    assert rows(loads.current_table(ledger, spec), "id") == [(1,), (2,), (3,), (4,)]
    assert sorted(r["LoadStatus"] for r in ledger.runs().collect()) == ["Completed", "Failed"]


def test_of_two_runs_of_a_zone_one_publishes(spark, source, ledger, rows, monkeypatch):
    control_rows = spark.createDataFrame([(1, "things", "gold", "last_modified", None)],
                                         "Controlid int, SourceObjectName string, DestinationZone string, IncrementalColumn string, LastWatermarkValue timestamp_ntz")
    root = scratch_path(spark, "zone")
    during(monkeypatch, ledger, lambda: loads.load_zone(control_rows, {"things": source}, "gold", root, 2, ledger))
    with pytest.raises(Conflict):
        loads.load_zone(control_rows, {"things": source}, "gold", root, 1, ledger)
    assert rows(loads.zone_table(ledger, "gold", "things"), "id") == [(1,), (2,), (3,), (4,)]
    during(monkeypatch, ledger, lambda: loads.load_zone(control_rows, {"all": source}, "gold", root, 4, ledger, full=["all"]))
    with pytest.raises(Conflict):
        loads.load_zone(control_rows, {"all": source}, "gold", root, 3, ledger, full=["all"])
    assert loads.zone_table(ledger, "gold", "all").count() == source.count()


def test_a_run_that_dies_after_its_commit_counts(spark, source, ledger, rows, monkeypatch):
    control_rows = spark.createDataFrame([(1, "things", "gold", "last_modified", None)],
                                         "Controlid int, SourceObjectName string, DestinationZone string, IncrementalColumn string, LastWatermarkValue timestamp_ntz")
    root, spec = scratch_path(spark, "zone"), loads.LoadSpec(**SPEC)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "_finish", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loads.load_zone(control_rows, {"things": source}, "gold", root, 1, ledger)
        with pytest.raises(OSError):
            loads.run_load(ledger, source, spec, root, 1, T1)
    assert loads.load_zone(control_rows, {"things": source}, "gold", root, 2, ledger)[1] == {"things": ("no new rows", 0, 1)}
    assert loads.zone_table(ledger, "gold", "things").count() == 4
    assert loads.run_load(ledger, source, spec, root, 2, T1)["RowsInserted"] == 0 and loads.current_table(ledger, spec).count() == 4


def test_windows_are_folded_into_one_folder(spark, source, ledger, rows):
    control_rows = spark.createDataFrame([(1, "things", "gold", "last_modified", None)],
                                         "Controlid int, SourceObjectName string, DestinationZone string, IncrementalColumn string, LastWatermarkValue timestamp_ntz")
    root = scratch_path(spark, "zone")
    for batch, part in enumerate((source.filter("id < 2"), source)):
        loads.load_zone(control_rows, {"things": part}, "gold", root, batch, ledger)
    assert len(ledger.published("gold.things")) == 2 and loads.fold_zone(ledger, "gold", "things", root, 2) == 4
    assert len(ledger.published("gold.things")) == 1
    assert rows(loads.zone_table(ledger, "gold", "things"), "id") == [(1,), (2,), (3,), (4,)]
    assert loads.load_zone(control_rows, {"things": source}, "gold", root, 3, ledger)[1] == {"things": ("no new rows", 0, 1)}


@pytest.mark.parametrize("parts", [None, 4])
def test_a_source_with_a_zone_map_is_loaded_from_the_files_of_its_window(spark, source, ledger, rows, parts):
    table, spec, root = FileTable(spark, scratch_path(spark, "source"), "Last Modified"), loads.LoadSpec(**SPEC, parts=parts), scratch_path(spark, "root")
    table.append(source.coalesce(1))
    assert loads.run_load(ledger, table, spec, root, 1, T1)["RowsWithoutWatermark"] == 1
    for name in [r[0] for r in table.files().select("file").collect()]:
        with open(f"{table.path}/{name}", "wb") as f:
            f.write(b"spoilt: a later window must not read it")
    table.append(later(spark, source).filter("`Last Modified` > TIMESTAMP_NTZ '2024-01-04 00:00:00'"))
    second = loads.run_load(ledger, table, spec, root, 2, T2)
    assert (second["RowsInserted"], second["RowsUpdated"]) == (1, 1)
    assert rows(loads.current_table(ledger, spec), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d"), (6, "f")]


def test_inactive_control_rows_and_metadata(spark):
    rows = spark.createDataFrame([(1, "a", "Gold", False), (2, "a", "Gold", None)], "Controlid int, SourceObjectName string, DestinationZone string, IsActive boolean")
    assert inc.control_for(rows, "A", "gold")["Controlid"] == 2
    df = spark.createDataFrame([(1, "x", 5), (2, "y", None)], "id int, v string, n int")
    assert inc.extract(df, (None, None), '[{"ColumnName": "v"}]', (), "n").columns == ["v"] and inc.extract(df, (None, 4), None, (), "n").count() == 0


def test_error_text_is_kept_whole(ledger):
    ledger.fail(ledger.start(ETLControlID=1), "x" * 9000)
    assert len(ledger.runs().first()["ErrorMsg"]) == 9000


def test_control_rows_refuse_a_repeated_specification(spark):
    spec = spark.createDataFrame([("CRM", "t", "Source", 3), ("CRM", "u", "Source", 3)], "SourceSystem string, SourceTable string, TableType string, SourceTypeID int")
    assert "FileQuoteCharacter" in control.control_rows(spec, "2025-01-01", T1).first()["Source"]
    with pytest.raises(Exception, match="repeated specification"):
        control.control_rows(spec.union(spec.limit(1)), "2025-01-01", T1).collect()


def test_target_tables_choose_a_load_per_table(spark, rows):
    from tidemark.ledger.catalogue import table_sizes, target_tables

    data = [("s", "a/b", "id", "int", 1, "Yes"), ("s", "a/b", "v", "string", 2, "No"), ("s", "nokey", "x", "int", 1, None),
            ("s", "allkey", "k", "int", 1, "Yes"), ("s", "old", "k", "int", 1, "Yes")]
    cat = spark.createDataFrame(data, "CustomSchemaName string, TableName string, ColumnName string, DataType string, ColumnId int, IsPrimaryKey string")
    out = target_tables(cat, cat.filter("TableName = 'old'"))
    assert rows(out) == [("s", "a_b", "id int, v string", "id", "upsert"), ("s", "allkey", "k int", "k", "reload"),
                         ("s", "nokey", "x int", None, "reload")]
    assert rows(table_sizes(cat).filter("TableName = 'a/b'")) == [("s", "a/b", 2, 1)]
