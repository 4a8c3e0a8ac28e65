"""Readers, writers, paths and JDBC options."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path, shared_dir
from tidemark.sources import jdbc, paths, readers, writers


@pytest.fixture
def fresh(spark):
    return lambda label="t": scratch_path(spark, label)


def lines(path, text):
    import os

    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as out:
        out.write(text)
    return path


def test_reject_budget(spark, fresh, rows):
    path = lines(fresh(), "id,v\n1,a\nx,b\n3,c\n4\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType())])
    with pytest.raises(readers.TooManyRejects):
        readers.read_with_reject_limit(spark, path, schema)
    with pytest.raises(readers.TooManyRejects):
        readers.read_with_reject_limit(spark, path, schema, max_errors=1)
    good, bad = readers.read_with_reject_limit(spark, path, schema, max_errors=2)
    assert rows(good) == [(1, "a"), (3, "c")]
    assert rows(bad) == [("4",), ("x,b",)]
    assert rows(good, "id") == [(1,), (3,)]
    assert good.count() == 2


def test_strings_unless_inferred(spark, fresh):
    path = lines(fresh(), "id,d\n1,2.5\n")
    assert [f.dataType.simpleString() for f in readers.read_csv(spark, path).schema] == ["string", "string"]
    assert [f.dataType.simpleString() for f in readers.read_csv(spark, path, infer=True).schema] == ["int", "double"]


def test_delimited_with_quotes(spark, fresh, rows):
    path = lines(fresh(), "k|v\n1|'a|b'\n")
    assert rows(readers.read_delimited(spark, path, "k int, v string", sep="|", quote="'")) == [(1, "a|b")]


def test_quoted_text_round_trip(spark, fresh, rows):
    data = [("say \"hi\"", "a,b"), ("back\\slash", "x"), (" pad ", "")]
    path = fresh()
    writers.write_delimited(spark.createDataFrame(data, "a string, b string"), path)
    back = spark.read.csv(path, header=True, escape="\\", schema="a string, b string")
    # Spark reads an empty quoted value of a written file as missing text.
    assert sorted((a, b or "") for a, b in rows(back)) == sorted(data)


def test_json_array(spark, fresh, rows):
    import os

    path = fresh()
    os.makedirs(path)
    with open(f"{path}/payers.json", "w") as out:
        out.write('[\n {"Id": "1", "ZIP": 21244.0},\n {"Id": "2", "ZIP": null}\n]')
    assert rows(readers.read_json_array(spark, path)) == [("1", 21244.0), ("2", None)]


def test_latest_folder(spark, fresh):
    base = fresh()
    assert paths.latest_partition(spark, base) is None
    for day in ("2024/12/31", "2025/02/10", "2025/11/07", "2025/11/11"):
        spark.range(1).write.parquet(f"{base}/{day}/x.parquet")
    assert paths.latest_partition(spark, base) == f"{base}/2025/11/11"
    assert paths.list_names(spark, base) == ["2024", "2025"]


def test_run_path_moves_zone_and_stamp():
    source = "lake/BRONZE/Sales/Orders/2024-02-21T11-03-01.375/Orders.csv"
    utc = dt.datetime(2024, 2, 21, 20, 0, 0, 45_000)
    assert paths.run_path(source, "Silver", utc) == "lake/Silver/Sales/Orders/2024-02-22T01-30-00.045/Orders.csv"


def test_template():
    now = dt.datetime(2025, 3, 4, 5, 6, 7)
    assert paths.expand_template("t\\YYYY\\MM\\DD\\", "t_*.parquet", now) == ("t\\2025\\03\\04\\", "t_20250304_050607.parquet")


def test_batches_are_idempotent(spark, fresh, rows):
    path = fresh()
    for batch in (1, 2, 2):
        writers.append(spark.range(5), path, batch)
    assert rows(readers.read_parquet(spark, path).groupBy("batch_id").count()) == [(1, 5), (2, 5)]


def test_csv_is_a_folder_of_parts(spark, fresh):
    path = fresh()
    writers.write_csv(spark.range(100).repartition(4), path)
    assert len([n for n in paths.list_names(spark, path) if n.endswith(".csv")]) == 4 and readers.read_csv(spark, path).count() == 100


def test_range_partitions_at_the_bounds(spark, fresh, rows):
    days = ["2022-12-31", "2023-01-01", "2023-01-31", "2023-02-01", "2023-04-01", "2023-09-09", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.to_date("d"))
    path = fresh()
    writers.write_range_partitioned(df, path, "d", ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01"])
    back = readers.read_parquet(spark, path).select(F.col("d").cast("string"), "range_id")
    assert rows(back) == [("2022-12-31", 0), ("2023-01-01", 1), ("2023-01-31", 1), ("2023-02-01", 2),
                          ("2023-04-01", 4), ("2023-09-09", 4), (None, 0)]


def test_partition_filter_prunes(spark, fresh, plan):
    from tidemark.operators.filters import month_pruned

    path = fresh()
    df = spark.sql("SELECT timestamp_ntz'2024-01-15' AS d UNION ALL SELECT timestamp_ntz'2024-03-15'")
    writers.write_parquet(df.withColumn("ym", F.date_format("d", "yyyy-MM")), path, ["ym"])
    back = spark.read.schema("d timestamp_ntz, ym string").parquet(path)
    out = month_pruned(back, "d", "2024-01-01", "2024-02-01")
    assert "PartitionFilters: [isnotnull(ym" in plan(out) and out.count() == 1


def test_bucketed_join_has_no_shuffle(spark, fresh, plan):
    data = spark.range(1000).select((F.col("id") % 100).alias("k"), "id")
    a = writers.write_bucketed(data, "bucket_a", 4, "k", "k", fresh())
    b = writers.write_bucketed(data, "bucket_b", 4, "k", "k", fresh())
    joined = a.hint("merge").join(b, "k").groupBy("k").count()
    assert "Exchange" not in plan(joined) and joined.count() == 100


def test_existing_table_is_kept(spark, fresh):
    path = fresh()
    schema = spark.range(1).schema
    writers.ensure_table(spark, "kept_table", schema, path, ["id"])
    spark.sql("INSERT INTO kept_table VALUES (1, timestamp_ntz'2024-01-01', 1, timestamp_ntz'2024-01-01', 1, 'h', false)")
    assert writers.ensure_table(spark, "kept_table", schema, path).count() == 1


def test_entities_without_folder_or_cleaner_are_reported(spark, fresh):
    base, said = fresh(), []
    spark.range(2).write.parquet(f"{base}/Known/2025/01/02/known.parquet")
    spark.range(3).write.parquet(f"{base}/Other/2025/01/02/other.parquet")
    spark.range(3).write.parquet(f"{base}/Flat")
    got = {n: d.count() for _, n, _, d in readers.run_entities(spark, base, {"known": lambda d: d}, said.append)}
    assert got == {"known": 2} and sorted(said) == ["no cleaner for other.parquet", "no dated folder for Flat"]


def test_path_with_backtick_is_refused(spark):
    with pytest.raises(ValueError):
        readers.sql_on_path(spark, "/x`; DROP", "SELECT * FROM {source}")


def test_jdbc_options():
    plain = jdbc.read_options("jdbc:x", "SELECT 1", {"user": "u"})
    assert plain == {"url": "jdbc:x", "user": "u", "query": "SELECT 1"}
    split = jdbc.read_options("jdbc:x", "SELECT * FROM t", partition=("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT * FROM t) src" and split["numPartitions"] == "8" and "query" not in split
    with pytest.raises(ValueError):
        jdbc.write_jdbc(None, "jdbc:x", "t", mode="merge")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")
