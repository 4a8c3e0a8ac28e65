"""Cleaners on edge rows, marts in both formulations, streams over restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.upsert import stamp_audit_cols
from tidemark.plans import clean, marts
from tidemark.schemas import DEVICE_MESSAGES, TYPED_MESSAGES
from tidemark.session import scratch_path
from tidemark.streaming import ingest

NOW = "2025-01-15 08:00:00"


def test_patients(spark):
    schema = ("Id string, BIRTHDATE string, DEATHDATE string, PREFIX string, FIRST string, MAIDEN string, SUFFIX string, "
              "MARITAL string, `CITY` string, ZIP double, LAT double, LON double")
    data = [("AAAABBBB-CCCC-DDDD-EEEE-0123456789AB", "2000-02-29", None, " mr. ", "o'neil ", "  ", None, "m", "new\t  york", 1234.0, None, 2.5),
            (None, "2000-13-01", "garbage", None, "josé", "x", "jr", " ", None, None, 1.0, None)]
    a, b = clean.clean_patients(spark.createDataFrame(data, schema), "2024-02-29", NOW).collect()
    assert (a.prefix, a["first"], a.maiden, a.suffix, a.marital) == ("Mr.", "O'neil", "N/A", "N/A", "M")
    assert (a.city, a.zip, a.lat, a.lon, a.valid_uuid) == ("New York", "01234", 0.0, 2.5, "Valid")
    assert (a.birthdate, a.age) == (dt.datetime(2000, 2, 29), 24)
    assert (b.prefix, b["first"], b.marital, b.city, b.zip, b.valid_uuid) == ("Not Provided", "Jos", "UNKNOWN", "Unknown", "00000", "Invalid")
    assert b.birthdate is None and b.deathdate is None and b.age is None
    assert str(a.Last_Modified) == NOW


def test_cleaners_accept_missing_columns(spark):
    one = spark.createDataFrame([(1,)], "`Other Column` int")
    assert clean.clean_patients(one, "2024-01-01", NOW).columns == ["other_column", "Last_Modified"]
    assert clean.clean_payers(one).columns == ["OTHER COLUMN"]
    assert clean.clean_encounters(one).columns == clean.clean_organizations(one).columns == ["other_column"]


def test_cleaner_is_one_projection(spark, plan):
    raw = spark.range(3).select(F.col("id").cast("string").alias("First"), F.lit("x").alias("city"), F.lit(1.0).alias("zip"))
    text = plan(clean.clean_patients(raw, "2024-01-01", NOW))
    assert text.split("(1)")[0].count("Project") <= 2


def test_payers(spark):
    schema = "Id string, NAME string, ADDRESS string, CITY string, STATE_HEADQUARTERED string, ZIP double, PHONE string"
    data = [("x", "Plan  One", None, None, None, None, None), ("y", "Plan Two", "1 St", " New  York ", "NY", 6156.0, "1-555-010-0199")]
    a, b = clean.clean_payers(spark.createDataFrame(data, schema)).collect()
    assert tuple(a) == ("x", "Plan One", "Not Provided", "Unknown", "Unknown", "00000", "Not Provided", "Invalid")
    assert tuple(b)[1:7] == ("Plan Two", "1 St", "New York", "NY", "06156", "15550100199")


def test_procedures_and_encounters(spark):
    schema = "START string, STOP string, DESCRIPTION string, BASE_COST double, REASONCODE bigint, REASONDESCRIPTION string"
    data = [("2020-01-01T00:00:00Z", "2020-01-01T00:30:30Z", " knee – SURGERY ", -5.0, None, None),
            ("2020-01-01T01:00:00Z", None, None, None, 7, "pain"), ("2020-01-01T01:00:00Z", "2020-01-01T00:00:00Z", "x", 3.0, 1, "y")]
    df = spark.createDataFrame(data, schema)
    a, b, c = clean.clean_procedures(df).collect()
    assert (a.duration_minutes, a.base_cost, a.reasoncode, a.reasondescription) == (30.5, 0.0, 0, "Unknown Reason")
    assert a.description == "Knee  Surgery"
    assert b.duration_minutes is None and b.base_cost is None and b.description is None
    assert c.duration_minutes == -60.0
    again = {r.Procedure_Id for r in clean.clean_procedures(df.repartition(3)).collect()}
    assert again == {r.Procedure_Id for r in (a, b, c)} and len(again) == 3
    costs = clean.clean_encounters(df.withColumn("TOTAL_CLAIM_COST", F.lit(None).cast("double"))).collect()
    assert {r.total_claim_cost for r in costs} == {0.0}


def test_generic_retail(spark):
    df = spark.createDataFrame([("ball", "BA-8327", 1234.5, 0.99)], "Name string, ProductNumber string, ListPrice double, AverageRate double")
    assert tuple(clean.clean_generic(df).first()) == ("BALL", "BALL-8327", "1,234.50", 74, "BAL")


@pytest.fixture
def model(tables):
    from tidemark.catalog.base import products, sales_fact

    return sales_fact(tables), products(tables)


def test_filter_first_and_filter_last_agree(model):
    fact, prods = model
    cols = ["region", "month_bucket", "category", "revenue", "total_quantity", "customer_count"]
    early = marts.category_month_top(fact, prods, "1998-01-01").select(cols)
    late = marts.category_month_top_late(fact, prods, "1998-01-01").select(cols)
    assert early.count() > 0 and early.exceptAll(late).isEmpty() and late.exceptAll(early).isEmpty()


def test_filter_is_pushed_in_both_forms(model, plan):
    fact, prods = model
    for form in (marts.category_month_top, marts.category_month_top_late):
        assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in plan(form(fact, prods, "1998-01-01"))


def test_territory_totals_agree_at_both_grains(spark, rows):
    territory = spark.createDataFrame([(1, "NW"), (2, "SE")], "TerritoryID int, Name string")
    header = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "SalesOrderID int, TerritoryID int")
    detail = spark.createDataFrame([(10, 1, 2, 5.0), (10, 2, 1, 1.0), (11, 1, 1, 2.0), (12, 1, 4, 8.0)],
                                   "SalesOrderID int, SpecialOfferID int, OrderQty int, LineTotal double")
    offer = spark.createDataFrame([(1, 0.0), (2, 0.1)], "SpecialOfferID int, DiscountPct double")
    assert rows(marts.territory_sales(territory, header, detail)) == [(1, "NW", 4, 8.0), (2, "SE", 4, 8.0)]
    assert rows(marts.territory_offer(territory, header, detail, offer)) == [
        (1, "NW", 1, 0.0, 3, 7.0), (1, "NW", 2, 0.1, 1, 1.0), (2, "SE", 1, 0.0, 4, 8.0)]


def test_employee_ranks_with_ties(spark, rows):
    people = spark.createDataFrame([(1, "HR", 5), (2, "HR", 5), (3, "HR", 1), (4, "IT", 9)], "id int, department string, salary int")
    for options in ({}, {"split": 3}):
        assert rows(marts.employee_ranks(people, **options)) == [
            (1, "HR", 5, 1, 1, 1, 1), (2, "HR", 5, 2, 1, 1, 1), (3, "HR", 1, 3, 3, 2, 2), (4, "IT", 9, 1, 1, 1, 1)]


BODY = "body binary"


def drop_file(spark, folder, bodies):
    spark.createDataFrame([(b.encode(),) for b in bodies], BODY).coalesce(1).write.mode("append").parquet(folder)


def test_stream_restart_adds_only_new_messages(spark, rows):
    folder, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))

    def run():
        stream = ingest.stream_source(spark, "parquet", spark.createDataFrame([], BODY).schema, folder)
        ingest.stream_to_parquet(ingest.parse_stream(stream, DEVICE_MESSAGES), out, ckpt, available_now=True).awaitTermination()
        return spark.read.schema(DEVICE_MESSAGES).parquet(out)

    drop_file(spark, folder, ['{"messageid":"1","temperature":"20.5","timestamp":"2024-01-01 00:00:00"}', "{broken", '{"messageid":"2","temperature":"hot"}'])
    assert run().count() == 3
    assert run().count() == 3
    drop_file(spark, folder, ['{"messageid":"3"}'])
    landed = run()
    assert rows(landed, "messageid") == [("1",), ("2",), ("3",), (None,)]
    typed = ingest.typed(landed, TYPED_MESSAGES)
    assert rows(typed, "messageid", "temperature") == [("1", 20.5), ("2", None), ("3", None), (None, None)]
    assert typed.schema["timestamp"].dataType.simpleString() == "timestamp_ntz"


def test_stream_changes_merge_across_batches(spark, rows):
    folder, changes, ckpt = (scratch_path(spark, x) for x in ("in", "changes", "ckpt"))
    schema = "id int, v string, at int"

    def run(batch):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = ingest.stream_source(spark, "parquet", spark.createDataFrame([], schema).schema, folder)
        ingest.stream_changes(stream, changes, ["id"], ["at"], ckpt, available_now=True).awaitTermination()

    run([(1, "a", 1), (1, "b", 2), (2, "x", 1)])
    run([(1, "c", 3), (3, "n", 1), (2, "late", 0)])
    target = stamp_audit_cols(spark.createDataFrame([(1, "old"), (9, "kept")], "id int, v string"), 1, NOW)
    out = ingest.stream_upsert(target, spark.read.parquet(changes), ["id"], ["at"], 2, NOW, label="c")
    assert rows(out, "id", "v", "c") == [(1, "c", "update"), (2, "x", "insert"), (3, "n", "insert"), (9, "kept", "kept")]
