"""Column functions on literal rows: NULL, blank, malformed, boundary values."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark import functions as X
from pyspark.sql import functions as F


def values(spark, fn, cases, dtype="string"):
    data = [(i, c) for i, c in enumerate(cases)]
    df = spark.createDataFrame(data, f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn("v").alias("o")).collect()]


def test_title_splits_on_spaces_only(spark):
    assert values(spark, X.title, ["o'neil", "MARY-jane  SMITH", None, ""]) == ["O'neil", "Mary-jane  Smith", None, ""]


def test_zip_from_text(spark):
    cases = ["1234.0", "", "  ", "123456789", None, "21244", " 77 "]
    assert values(spark, X.norm_zip, cases) == ["01234", "00000", "00000", "123456789", "00000", "21244", "00077"]


def test_zip_from_double_has_no_exponent(spark):
    cases = [6156.0, 21244.0, 123456789.0, None, 1e9]
    out = values(spark, lambda c: X.norm_zip(c, numeric=True), cases, "double")
    assert out == ["06156", "21244", "123456789", "00000", "1000000000"]


def test_phone(spark):
    assert values(spark, X.norm_phone, ["1-555-010-0123", "---", None]) == ["15550100123", "Not Provided", "Not Provided"]


def test_uuid(spark):
    good = "0f1e2d3c-4b5a-6978-8796-a5b4c3d2e1f0"
    assert values(spark, X.valid_uuid, [good, good.replace("-", ""), good[:-1], "x" * 32, None]) == [
        "Valid", "Valid", "Invalid", "Invalid", "Invalid"]


def test_pad_keeps_longer_values(spark):
    assert values(spark, lambda c: X.pad_left(c, 3, "0"), ["7", "1234", None]) == ["007", "1234", None]


def test_printable_and_collapse(spark):
    assert values(spark, X.printable, ["café\t1~", None]) == ["caf1~", None]
    assert values(spark, X.collapse_ws, ["a \t\n b", None]) == ["a b", None]


def test_abbreviations_in_order(spark):
    assert values(spark, X.expand_abbrev, ["Dr. A, Mr. B, Mrs. C", None]) == ["Doctor A, Mister B, Missus C", None]


def test_concat_blank_reads_null_as_empty(spark):
    assert values(spark, lambda c: X.concat_blank(F.lit("a"), c, F.lit("b")), ["-", None]) == ["a-b", "ab"]


def test_clamp_keeps_null(spark):
    assert values(spark, lambda c: X.clamp_min(c, 0.0), [-1.0, 2.0, None], "double") == [0.0, 2.0, None]


def test_safe_divide(spark):
    assert values(spark, lambda c: X.safe_divide(F.lit(1.0), c), [2.0, 0.0, None], "double") == [0.5, None, None]


def test_bad_dates_become_null(spark):
    out = values(spark, X.parse_ts, ["2024-02-29", "2023-02-29", "garbage", None])
    assert out == [dt.datetime(2024, 2, 29), None, None, None]


def test_iso_times(spark):
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    out = values(spark, lambda c: X.parse_ts(c, fmt), ["2020-01-02T03:04:05Z", "2020-01-02 03:04:05"])
    assert out == [dt.datetime(2020, 1, 2, 3, 4, 5), None]


def test_age_on_birthday_and_before(spark):
    birth = [dt.date(2000, 1, 15), dt.date(2000, 1, 16), None]
    assert values(spark, lambda c: X.age_years(c, "2024-01-15"), birth, "date") == [24, 23, None]


def test_duration_and_seconds(spark):
    data = [(dt.datetime(2024, 1, 1, 0, 0, 0, 900000), dt.datetime(2024, 1, 1, 0, 1, 1, 100000)),
            (dt.datetime(2024, 1, 1, 0, 1), dt.datetime(2024, 1, 1)), (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 1))]
    df = spark.createDataFrame(data, "a timestamp_ntz, b timestamp_ntz")
    out = df.select(X.seconds_between("a", "b"), X.duration_minutes("a", "b")).collect()
    assert [r[0] for r in out] == [61, -60, 1]
    assert out[1][1] == -1.0


def test_seconds_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1), dt.datetime(2024, 3, 10, 4))], "a timestamp_ntz, b timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(X.seconds_between("a", "b")).first()[0] == 3 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_json_build_leaves_out_nulls(spark):
    df = spark.createDataFrame([("t", None, None), (None, None, "f")], "a string, b string, c string")
    doc = X.build_json({"SQLSource": {"Table": "a", "Server": "b"}, "FileSource": {"Name": "c"}})
    assert [r[0] for r in df.select(doc).collect()] == ['[{"SQLSource":{"Table":"t"}}]', '[{"FileSource":{"Name":"f"}}]']


def test_json_get(spark):
    assert values(spark, lambda c: X.json_get(c, "$.A.B"), ['{"A":{"B":"x"}}', "{}", "bad", None]) == ["x", None, None, None]


def test_zip_arrays_of_unequal_length(spark):
    df = spark.createDataFrame([(["a", "b"], [1])], "s array<string>, n array<int>")
    assert [tuple(x) for x in df.select(X.zip_arrays("s", "n")).first()[0]] == [("a", 1), ("b", None)]


def test_sha2_hash_tells_apart_what_sha1_mixes_up(spark):
    df = spark.createDataFrame([(None, "b"), ("NA", "b"), ("x|y", "z"), ("x", "y|z")], "a string, b string")
    safe = [r[0] for r in df.select(X.row_hash(["a", "b"])).collect()]
    compat = [r[0] for r in df.select(X.row_hash(["a", "b"], "sha1")).collect()]
    assert len(set(safe)) == 4
    assert compat[0] == compat[1] and compat[2] == compat[3]
    assert all(len(h) == 40 and h == h.upper() for h in compat)


def test_sha1_encodings_differ(spark):
    df = spark.createDataFrame([("a",)], "a string")
    one, two = df.select(X.row_hash(["a"], "sha1"), X.row_hash(["a"], "sha1", "UTF-16LE")).first()
    assert one != two
    with pytest.raises(ValueError):
        X.row_hash(["a"], "md5")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .\t-0é", max_size=8), min_size=1, max_size=20))
def test_text_rules_agree_with_python(spark, texts):
    import re

    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").orderBy("i")
    got = df.select(X.collapse_ws("v"), X.printable("v"), X.is_blank("v")).collect()
    for text, (collapsed, shown, blank) in zip(texts, got):
        assert collapsed == re.sub(r"\s+", " ", text)
        assert shown == re.sub(r"[^\x20-\x7E]", "", text)
        assert blank == (text.strip(" ") == "")
