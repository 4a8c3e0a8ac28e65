"""Rankings and frames: the split form equals the plain window, whatever the skew and the ties."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import windows as w

KINDS = {"rn": "row_number", "rk": "rank", "dr": "dense_rank", "nt": "ntile"}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, and a third of those under one value."""
    i = F.col("id")
    return spark.range(3000).select(
        i.alias("id"), F.when(i % 3 == 0, 0).otherwise(i % 50).cast("int").alias("g"),
        F.when(i % 9 == 0, 5).when(i % 7 == 1, None).otherwise(i * 31 % 40).cast("int").alias("v"))


@pytest.mark.parametrize("part, order, tiles", [(["g"], ["-v"], 2), (["g"], ["v"], 400), ([], ["-v"], 7), ([], ["v"], 4000)])
def test_split_ranks_equal_plain(skewed, part, order, tiles):
    plain = w.rank_rows(skewed, part, order, ["id"], tiles=tiles, **KINDS)
    split = w.rank_rows(skewed, part, order, ["id"], tiles=tiles, split=31, **KINDS)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 4))), min_size=12, max_size=60))
def test_split_ranks_on_random_rows(spark, data):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id int, g int, v int")
    plain = w.rank_rows(df, ["g"], ["v"], ["id"], tiles=3, **KINDS)
    split = w.rank_rows(df, ["g"], ["v"], ["id"], tiles=3, split=9, **KINDS)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_null_groups_are_ranked_when_split(spark):
    df = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, 1).cast("int").alias("g"))
    split = w.rank_rows(df, ["g"], ["id"], split=6, rn="row_number")
    assert split.filter("g is null").agg(F.max("rn"), F.count_distinct("rn")).first() == (30, 30)


def test_plain_form_needs_no_pass_before_the_plan(skewed, plan):
    assert "ranges" not in plan(w.rank_rows(skewed, ["g"], ["v"], rk="rank"))


def test_rows_that_tie_are_spread_over_the_ranges(spark):
    tied = spark.range(20_000).select("id", F.lit(1).alias("g"), F.lit(7).alias("v"))
    sizes = [r["count"] for r in w.place_in_ranges(tied, ["g"], ["v"], 10).groupBy("__range").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 20_000 / 10
    split = w.rank_rows(tied, ["g"], ["v"], ["id"], split=10, **KINDS)
    assert split.agg(F.max("rk"), F.max("dr"), F.max("rn"), F.count_distinct("rn")).first() == (1, 1, 20_000, 20_000)


@pytest.mark.parametrize("n, block", [(5, 100), (8, 3), (40, 7)])
def test_moving_average_over_blocks(skewed, n, block):
    df = skewed.withColumn("v", F.coalesce("v", F.lit(0)))
    plain = w.moving_avg(df, ["g"], ["id"], "v", n)
    split = w.moving_avg(df, ["g"], ["id"], "v", n, split=20, block=block)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_sequences_are_dense(skewed):
    for out in (w.sequence(skewed, ["id"], split=31), w.arbitrary_sequence(skewed.repartition(7))):
        assert out.agg(F.min("seq"), F.max("seq"), F.count_distinct("seq")).first() == (1, 3000, 3000)
    ordered = w.sequence(skewed, ["-id"], split=31).orderBy("id").first()
    assert ordered["seq"] == 3000


def test_top_k_keeps_ties_and_prunes_before_the_shuffle(spark, rows, plan):
    df = spark.createDataFrame([("a", 9), ("a", 9), ("a", 8), ("a", 1), ("b", 2)], "g string, v int")
    out = w.top_k(df, ["g"], ["-v"], 2)
    assert rows(out) == [("a", 9, 1), ("a", 9, 1), ("b", 2, 1)]
    text = plan(out)
    assert text.count("WindowGroupLimit") >= 2


def test_top_n_plans_no_full_sort(spark, plan):
    assert "TakeOrderedAndProject" in plan(w.top(spark.range(100), 3, "-id"))


def test_ranked_groups(spark, rows):
    df = spark.createDataFrame([("r", "p", 1), ("r", "p", 4), ("r", "q", 5), ("r", "s", 1)], "r string, p string, v int")
    out = w.rank_groups(df, ["r", "p"], F.sum("v"), ["r"], "k", "t")
    assert rows(out, "p", "t", "k") == [("p", 5, 1), ("q", 5, 1), ("s", 1, 3)]
