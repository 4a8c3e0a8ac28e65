"""Joins, projections, aggregates, mutations, checks, masks: edge rows and plan shapes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import aggregate as agg
from tidemark.operators import filters, govern, joins, layout, mutate, project, quality


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def sides(spark):
    return (frame(spark, [("a", 1), (None, 2), ("", 3), ("z", 4)], "k string, v int"),
            frame(spark, [("a", 10), (None, 20)], "k string, w int"))


def test_null_key_rules(sides, rows):
    left, right = sides
    assert rows(joins.inner(left, right, ["k"]), "v", "w") == [(1, 10)]
    assert rows(joins.inner(left, right, ["k"], null_safe=True), "v", "w") == [(1, 10), (2, 20)]
    assert rows(joins.inner(left, right, ["k"], blank_null=True), "v", "w") == [(1, 10), (2, 20), (3, 20)]


def test_anti_and_semi(sides, rows):
    left, right = sides
    assert rows(joins.anti(left, right, ["k"]), "v") == [(2,), (3,), (4,)]
    assert rows(joins.semi(left, right, ["k"]), "v") == [(1,)]
    assert joins.exists_any(left, F.col("v") == 4) and not joins.exists_any(left, F.col("v") == 9)


def test_a_table_can_meet_itself(spark, rows):
    df = frame(spark, [(1, 2), (2, 3), (3, 9)], "k int, p int")
    assert rows(joins.inner(df, df.select("k", F.col("p").alias("pp")), {"p": "k"})) == [(1, 2, 3), (2, 3, 9)]
    assert rows(joins.anti(df, df, {"p": "k"}), "k") == [(3,)]
    assert rows(joins.semi(df, df, {"p": "k"}), "k") == [(1,), (2,)]
    assert rows(joins.lookup(df, df, {"p": "k"}, [F.col("p").alias("next")]), "k", "next") == [(1, 3), (2, 9), (3, None)]


def test_text_lengths(spark, rows):
    df = frame(spark, [("abc", None), ("a", None)], "a string, b string")
    assert rows(quality.check_lengths(df, {"a": 2, "b": 5})) == [("a", 3, 2, "failed"), ("b", 0, 5, "passed")]


def test_no_join_gathers_a_side_to_size_it(tables, plan):
    import __spark_entry__ as contract

    for name in ("join_broadcast", "num_fx_convert", "sink_distributed", "audit_resolve_min"):
        text = plan(contract.queries()[name](tables.spark, tables.folder))
        assert "GlobalLimit" not in text and "Cartesian" not in text, name


def test_lookup_keeps_unmatched_rows(sides, rows):
    left, right = sides
    assert rows(joins.lookup(left, right, ["k"], ["w"]), "v", "w") == [(1, 10), (2, None), (3, None), (4, None)]


def test_update_from_takes_the_last_of_a_repeated_key(spark, rows):
    target = frame(spark, [(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    source = frame(spark, [(1, "x", 1), (1, "y", 2), (None, "z", 3)], "k int, v string, o int")
    assert sorted(rows(joins.update_from(target, source, ["k"], {"v": "v"}, order=["o"])), key=str) == [(1, "y"), (2, "b"), (None, "c")]
    with pytest.raises(Exception, match="repeated source key"):
        joins.update_from(target, source, ["k"], {"v": "v"}).collect()


def test_blank_null_leaves_other_types_alone(spark, rows):
    left = frame(spark, [("", None, 1), (None, 4, 2)], "a string, b bigint, v int")
    right = frame(spark, [(None, None, 10), ("", 4, 20), ("", 5, 30)], "a string, b bigint, w int")
    assert rows(joins.inner(left, right, ["a", "b"], blank_null=True), "v", "w") == [(1, 10), (2, 20)]


def test_update_from_null_overwrites(spark, rows):
    target = frame(spark, [(1, "a"), (2, "b")], "k int, v string")
    source = frame(spark, [(1, None)], "k int, v string")
    assert rows(joins.update_from(target, source, ["k"], {"v": "v"})) == [(1, None), (2, "b")]


def test_lateral_json(spark, rows):
    df = frame(spark, [(1, '[{"ColumnName":"a"},{"ColumnName":"b"}]'), (2, "[]"), (3, None)], "id int, doc string")
    out = joins.lateral_json(df, "doc", "array<struct<ColumnName: string>>")
    assert rows(out, "id", "ColumnName") == [(1, "a"), (1, "b")]


def test_struct_operators(spark, rows):
    df = frame(spark, [(("J", "", "S"), 5), (None, -1)], "name struct<firstname: string, middlename: string, lastname: string>, salary int")
    renamed = project.cast_struct(df, "name", "struct<f: string, m: string, l: string>")
    assert renamed.schema["name"].dataType.names == ["f", "m", "l"]
    assert rows(project.flatten(renamed, "name", {"f": "first", "l": "last"})) == [(-1, None, None), (5, "J", "S")]


def test_names_and_defaults(spark, rows):
    df = frame(spark, [(None, None, "x")], "`Last Modified ` int, `Id` string, `c` string")
    snake = project.standardize_names(df)
    assert snake.columns == ["last_modified", "id", "c"]
    assert project.standardize_names(df, "upper").columns == ["LAST MODIFIED ", "ID", "C"]
    assert rows(project.fill_defaults(snake, {"last_modified": 0, "id": 0, "gone": 1})) == [(0, "0", "x")]


def test_by_type_is_one_projection(spark, plan):
    df = spark.range(3).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(6)])
    out = project.apply_by_type(df, T.StringType, F.upper)
    assert plan(out).count("Project") <= 2 and out.columns == df.columns


def test_safe_cast(spark, rows):
    df = frame(spark, [("1",), ("x",), (None,)], "v string")
    assert rows(project.cast_cols(df, {"v": "int"})) == [(1,), (None,), (None,)]
    with pytest.raises(Exception):
        project.cast_cols(df, {"v": "int"}, safe=False).collect()


def test_column_pruning_and_pushdown(tables, plan):
    out = filters.where(tables.lineitem, "l_quantity > 49").select("l_orderkey")
    text = plan(out)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    assert "GreaterThan(l_quantity,49.0)" in text


def test_delete_keeps_unknown(spark, rows):
    df = frame(spark, [(1,), (None,), (5,)], "v int")
    assert rows(mutate.delete_where(df, F.col("v") > 3)) == [(1,), (None,)]


def test_update_sees_old_values(spark, rows):
    df = frame(spark, [(1, 2), (3, 4)], "a int, b int")
    assert rows(mutate.update_where(df, F.col("a") == 1, {"a": F.col("b"), "b": F.col("a")})) == [(2, 1), (3, 4)]


def test_insert_matches_by_name_and_casts(spark, rows):
    target = frame(spark, [(1, "a", None)], "i bigint, s string, extra int")
    assert rows(mutate.insert_into(target, frame(spark, [("b", 2)], "s string, i int"))) == [(1, "a", None), (2, "b", None)]
    assert mutate.truncate(target).count() == 0 and mutate.truncate(target).schema == target.schema


def test_pivot_and_back(spark, rows):
    df = frame(spark, [("ann", "HR", 1), ("ann", "HR", 2), ("bob", "IT", 5)], "name string, department string, salary int")
    wide = agg.pivot(df, ["name"], "department", ["HR", "Sales", "IT"], F.sum("salary"))
    assert rows(wide) == [("ann", 3, None, None), ("bob", None, None, 5)]
    assert rows(agg.unpivot(wide, ["name"], ["HR", "Sales", "IT"], "department", "salary")) == [("ann", "HR", 3), ("bob", "IT", 5)]
    assert agg.unpivot(wide, ["name"], ["HR", "Sales", "IT"], drop_nulls=False).count() == 6


def test_concat_group_is_ordered_and_keeps_repeats(spark, rows):
    df = frame(spark, [("t", "b", 2), ("t", "a", 1), ("t", "b", 2), ("u", "z", 1)], "t string, c string, ord int")
    assert rows(agg.concat_group(df, ["t"], "c", "ord", "|")) == [("t", "a|b|b"), ("u", "z")]
    assert rows(agg.concat_group(df, ["t"], "c", "ord", "|", distinct=True)) == [("t", "a|b"), ("u", "z")]


def test_flag_and_ratio(spark, rows):
    df = frame(spark, [("a", "Yes", 4.0, 0.0), ("a", None, 1.0, 0.0), ("b", "No", 3.0, 2.0)], "g string, p string, x double, y double")
    assert rows(agg.flag_any(df, ["g"], F.col("p") == "Yes")) == [("a", 1), ("b", 0)]
    assert rows(agg.ratio_of_sums(df, ["g"], "x", "y")) == [("a", None), ("b", 1.5)]


def test_distinct_count_is_partial_first(tables, plan):
    out = agg.summarize(tables.lineitem, ["l_returnflag"], n=F.count_distinct("l_partkey"))
    assert "partial_count(distinct l_partkey" in plan(out)


def test_key_report(spark, rows):
    df = frame(spark, [(1, 1), (1, 1), (2, None), (3, 1)], "a int, b int")
    assert rows(quality.check_key(df, ["a", "b"])) == [(1, 1, "failed")]
    assert rows(quality.check_key(df.filter("a = 3"), ["a", "b"])) == [(0, 0, "passed")]
    assert rows(quality.check_count(df, 4)) == [(4, 4, "passed")]
    assert rows(quality.check_count(df, 5)) == [(4, 5, "failed")]
    assert rows(quality.duplicate_keys(df, ["a"])) == [(1, 2)]


def test_columns_are_found_up_to_case_and_spaces(spark):
    df = frame(spark, [(1, 2)], "`Last Modified` int, START int")
    assert quality.resolve_column(df, "Last_Modified") == "Last Modified"
    assert quality.require(df, ["start", "stop"]) == ["stop"]


def test_masks(spark, rows):
    import datetime as dt

    df = frame(spark, [("secret", "ab", None, 7, dt.date(2024, 1, 1), True)], "a string, b string, c string, n int, d date, f boolean")
    masked = govern.mask(df, df.columns)
    assert rows(masked) == [("XXXX", "XXXX", None, 0, dt.date(1900, 1, 1), False)]
    assert govern.mask(df, ["b"], widths={"b": 2}).first()["b"] == "XX"
    assert masked.schema == df.schema or [f.dataType for f in masked.schema] == [f.dataType for f in df.schema]
    assert govern.mask(df, df.columns, unmasked=True) is df


def test_row_filter_as_view_and_as_function(spark, tables, rows, plan):
    tables.customer.createOrReplaceTempView("customers_seen")
    name = govern.predicate_function(spark, "customers_of", "customers_seen", "c_mktsegment")
    by_function = spark.sql(f"SELECT * FROM {name}('BUILDING')")
    view = govern.row_filter_view(tables.customer, "building_only", "c_mktsegment", "BUILDING")
    assert rows(by_function) == rows(spark.table(view)) and by_function.count() > 0
    assert "EqualTo(c_mktsegment,BUILDING)" in plan(by_function)
    assert spark.sql(f"SELECT * FROM {name}(NULL)").isEmpty()


def test_row_filter_reaches_the_scan(tables, plan):
    assert "EqualTo(c_mktsegment,BUILDING)" in plan(govern.row_filter(tables.customer, "c_mktsegment", "BUILDING"))


def test_placement(spark):
    df = spark.range(100)
    assert layout.repartition(df, 10).rdd.getNumPartitions() == 10
    assert layout.coalesce(df, 2).rdd.getNumPartitions() == 2
    with pytest.raises(ValueError):
        layout.distribute(df, "elsewhere")
