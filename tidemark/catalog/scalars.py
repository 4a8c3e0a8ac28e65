"""Scalar functions."""

from pyspark.sql import functions as F

from .. import functions as X
from ..operators.joins import lookup
from ..session import settle
from .base import collapse_sql, money, printable_sql, query, title_sql, zip_sql


@query("str_upper_lower", "SELECT c_custkey, upper(c_name) AS up, lower(c_mktsegment) AS low FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.upper("c_name").alias("up"), F.lower("c_mktsegment").alias("low"))


@query("str_trim", "SELECT c_custkey, c_name AS name FROM customer")
def _(t):
    padded = F.concat(F.lit("   "), "c_name", F.lit("  "))
    return t.customer.select("c_custkey", F.trim(padded).alias("name"))


@query("str_initcap", f"SELECT p_partkey, {title_sql('p_name')} AS name, {title_sql('p_type')} AS type FROM part")
def _(t):
    return t.part.select("p_partkey", X.title("p_name").alias("name"), X.title("p_type").alias("type"))


@query("str_concat", """SELECT doc_id, lang || source AS both_names,
 concat(CASE WHEN lang <> 'en' THEN lang END, source) AS blank_names, CASE WHEN lang <> 'en' THEN lang || source END AS null_names
 FROM documents""")
def _(t):
    gap = F.when(F.col("lang") != "en", F.col("lang"))
    return t.documents.select("doc_id", F.concat("lang", "source").alias("both_names"),
                              X.concat_blank(gap, "source").alias("blank_names"),
                              F.concat(gap, F.col("source")).alias("null_names"))


@query("str_substring", "SELECT p_partkey, substring(p_brand, 3, 100) AS tail, upper(substring(p_name, 1, 3)) AS head FROM part")
def _(t):
    return t.part.select("p_partkey", F.substring("p_brand", 3, 100).alias("tail"),
                         F.upper(F.substring("p_name", 1, 3)).alias("head"))


@query("str_replace", """SELECT doc_id, replace(replace(replace(source, 'src', '['), '1', 'one]'), '/', '_') AS s,
 md5(replace(replace(text, ' the ', ' THE '), ',', ';')) AS text_md5 FROM documents""")
def _(t):
    s = X.replace_all("source", [("src", "["), ("1", "one]"), ("/", "_")])
    return t.documents.select("doc_id", s.alias("s"),
                              F.md5(X.replace_all("text", {" the ": " THE ", ",": ";"})).alias("text_md5"))


@query("str_position", "SELECT page_id, CAST(instr(html, '<body') AS INTEGER) AS body_at, CAST(length(html) AS INTEGER) AS n FROM pages")
def _(t):
    return t.pages.select("page_id", F.locate("<body", "html").alias("body_at"), F.length("html").alias("n"))


@query("str_regexp_collapse", f"SELECT doc_id, md5({collapse_sql('text')}) AS text_md5, CAST(length({collapse_sql('text')}) AS INTEGER) AS n FROM documents")
def _(t):
    text = X.collapse_ws("text")
    return t.documents.select("doc_id", F.md5(text).alias("text_md5"), F.length(text).alias("n"))


@query("str_strip_nonprintable", f"SELECT doc_id, md5({printable_sql('text')}) AS text_md5, CAST(length({printable_sql('text')}) AS INTEGER) AS n FROM documents")
def _(t):
    text = X.printable("text")
    return t.documents.select("doc_id", F.md5(text).alias("text_md5"), F.length(text).alias("n"))


@query("str_lpad", """SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 3
 THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS code FROM customer""")
def _(t):
    return t.customer.select("c_custkey", X.pad_left(F.col("c_custkey").cast("string"), 3, "0").alias("code"))


@query("str_encode_utf8", "SELECT doc_id, octet_length(encode(text)) AS n_bytes, sha1(text) AS digest FROM documents")
def _(t):
    raw = X.utf8("text")
    return t.documents.select("doc_id", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha1(raw).alias("digest"))


@query("str_abbrev_expand", """SELECT c_custkey, replace(replace(replace(CASE WHEN c_acctbal < 0 THEN 'Dr. ' WHEN c_acctbal < 5000
 THEN 'Mr. and Mrs. ' ELSE '' END || c_name, 'Dr.', 'Doctor'), 'Mr.', 'Mister'), 'Mrs.', 'Missus') AS name FROM customer""")
def _(t):
    title = F.when(F.col("c_acctbal") < 0, "Dr. ").when(F.col("c_acctbal") < 5000, "Mr. and Mrs. ").otherwise("")
    return t.customer.select("c_custkey", X.expand_abbrev(F.concat(title, "c_name")).alias("name"))


@query("str_csv_list", """SELECT p_partkey, '[' || p_name || '], [' || p_brand || '], [' || p_size || ']' AS names FROM part""")
def _(t):
    names = F.concat(F.lit("["), X.csv_list(["p_name", "p_brand", "p_size"], quote="", sep="], ["), F.lit("]"))
    return t.part.select("p_partkey", names.alias("names"))


@query("norm_zip", "SELECT c_custkey, " + zip_sql("CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) || '.0' END")
       + " AS zip, " + zip_sql("CASE WHEN c_acctbal < 0 THEN '  ' ELSE CAST(c_custkey * 7919 AS VARCHAR) END")
       + " AS text_zip FROM customer")
def _(t):
    number = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey").cast("double"))
    text = F.when(F.col("c_acctbal") < 0, "  ").otherwise((F.col("c_custkey") * 7919).cast("string"))
    return t.customer.select("c_custkey", X.norm_zip(number, numeric=True).alias("zip"), X.norm_zip(text).alias("text_zip"))


@query("norm_phone", """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'Not Provided'
 ELSE regexp_replace('1-555-' || s_name, '[^0-9]', '', 'g') END AS phone FROM supplier""")
def _(t):
    raw = F.when(F.col("s_acctbal") < 0, "---").otherwise(F.concat(F.lit("1-555-"), "s_name"))
    return t.supplier.select("s_suppkey", X.norm_phone(raw).alias("phone"))


@query("valid_uuid", """SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'MACHINERY' THEN 'Invalid' ELSE 'Valid' END AS valid
 FROM customer""")
def _(t):
    digest = F.md5(F.col("c_custkey").cast("string"))
    dashed = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    raw = F.when(F.col("c_acctbal") < 0, F.substring(digest, 1, 31)).when(F.col("c_mktsegment") != "MACHINERY", dashed)
    return t.customer.select("c_custkey", X.valid_uuid(raw).alias("valid"))


@query("num_round_floor", """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
 CAST(floor(o_totalprice) AS BIGINT) AS floored, CAST(floor(o_totalprice * 75) AS BIGINT) AS converted FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", X.round_to(money("o_totalprice"), 1).cast("double").alias("rounded"),
                           F.floor("o_totalprice").alias("floored"), F.floor(F.col("o_totalprice") * 75).alias("converted"))


@query("num_format", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price FROM orders")
def _(t):
    return t.orders.select("o_orderkey", X.fixed("o_totalprice", 2).alias("price"))


@query("num_clamp_negative", """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_acctbal < 0 THEN 0
 ELSE c_acctbal END AS cost FROM customer""")
def _(t):
    cost = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return t.customer.select("c_custkey", X.clamp_min(cost, 0.0).alias("cost"))


@query("num_fx_convert", """SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 75, 2) AS DOUBLE) AS inr,
 CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(o_rate AS DECIMAL(6,2)), 2) AS DOUBLE) AS by_rate
 FROM orders JOIN (SELECT o_orderpriority AS ccy, min(length(o_orderpriority)) AS o_rate FROM orders GROUP BY 1) ON o_orderpriority = ccy""")
def _(t):
    # One rate per priority stands for a rate table keyed by currency.
    rates = t.orders.groupBy(F.col("o_orderpriority").alias("ccy")).agg(F.min(F.length("o_orderpriority")).alias("rate"))
    joined = lookup(t.orders, settle(rates, "rates"), {"o_orderpriority": "ccy"}, ["rate"])
    rate = F.col("rate").cast("decimal(6,2)")
    return joined.select("o_orderkey", X.convert(money("o_totalprice"), 75).cast("double").alias("inr"),
                         X.convert(money("o_totalprice"), rate).cast("double").alias("by_rate"))


@query("dt_parse", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) END AS day,
 CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 10 HOUR END AS instant FROM orders""")
def _(t):
    day = F.when(F.col("o_orderstatus") == "P", "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    iso = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"),
                   F.when(F.col("o_orderstatus") == "P", "T25:00:00Z").otherwise("T10:00:00Z"))
    return t.orders.select("o_orderkey", X.parse_ts(day, "yyyy-MM-dd").alias("day"),
                           X.parse_ts(iso, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("instant"))


@query("dt_format", """SELECT event_id, strftime(ts, '%Y-%m') AS ym, strftime(ts, '%Y%m%d') AS compact,
 strftime(ts, '%Y-%m-%d %H:%M:%S') AS odbc FROM events""")
def _(t):
    return t.events.select("event_id", X.fmt_date("ts").alias("ym"), X.fmt_date("ts", "yyyyMMdd").alias("compact"),
                           X.fmt_date("ts", "yyyy-MM-dd HH:mm:ss").alias("odbc"))


@query("dt_parts", """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
 CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h FROM events""")
def _(t):
    return t.events.select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.day("ts").alias("d"),
                           F.hour("ts").alias("h"))


@query("dt_diff_days", """SELECT l_orderkey, l_linenumber, l_shipdate, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_shipdate", X.days_between("l_shipdate", "o_orderdate").alias("days"))


@query("dt_diff_seconds", "SELECT event_id, date_diff('second', TIMESTAMP '2024-01-01', ts) AS seconds FROM events")
def _(t):
    return t.events.select("event_id", X.seconds_between(F.lit("2024-01-01").cast("timestamp_ntz"), "ts").alias("seconds"))


@query("dt_duration_minutes", "SELECT event_id, date_diff('second', ts, TIMESTAMP '2024-01-15') / 60.0 AS minutes FROM events")
def _(t):
    return t.events.select("event_id", X.duration_minutes("ts", F.lit("2024-01-15").cast("timestamp_ntz")).alias("minutes"))


@query("dt_age_years", """SELECT o_orderkey, CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2025-01-01') / 365.25) AS BIGINT) AS age
 FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", X.age_years("o_orderdate", "2025-01-01").alias("age"))


@query("dt_add_days", "SELECT event_id, ts - INTERVAL 3 DAY AS low, ts + INTERVAL 1 DAY AS high FROM events")
def _(t):
    return t.events.select("event_id", X.shift_days("ts", -3).alias("low"), X.shift_days("ts", 1).alias("high"))


@query("dt_timezone", "SELECT event_id, ts + INTERVAL 330 MINUTE AS local_ts FROM events")
def _(t):
    return t.events.select("event_id", X.to_zone("ts", "Asia/Kolkata").alias("local_ts"))


@query("dt_now", "SELECT c_custkey, TIMESTAMP '2025-01-15 08:00:00' AS stamped, TRUE AS now_is_set FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.stamp("2025-01-15 08:00:00").alias("stamped"),
                             X.stamp(None).isNotNull().alias("now_is_set"))


@query("arr_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(t):
    words = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    return words.select("p_partkey", X.explode_col("words", "word"))


@query("arr_zip", """SELECT c_custkey, unnest(['Math', 'English']) AS subject, unnest([c_nationkey, NULL]) AS score FROM customer""")
def _(t):
    arrays = t.customer.select("c_custkey", F.array(F.lit("Math"), F.lit("English")).alias("subjects"),
                               F.array("c_nationkey").alias("scores"))
    zipped = arrays.select("c_custkey", X.zip_arrays("subjects", "scores"))
    return zipped.select("c_custkey", X.explode_col("zipped", "z")).select(
        "c_custkey", F.col("z.subjects").alias("subject"), F.col("z.scores").alias("score"))


@query("json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _(t):
    return t.events.select("event_id", X.parse_json("props", "k int").alias("data")).select("event_id", "data.*")


@query("json_build", """SELECT p_partkey, '[{"SQLSource":{"TableName":"' || p_name || '","Brand":"' || p_brand || '"}'
 || CASE WHEN p_type <> 'PROMO' THEN ',"FileSource":{"FileName":"' || p_type || '"}' ELSE '' END || '}]' AS doc FROM part""")
def _(t):
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    doc = X.build_json({"SQLSource": {"TableName": "p_name", "Schema": F.lit(None).cast("string"), "Brand": "p_brand"},
                        "FileSource": {"FileName": kind}})
    return t.part.select("p_partkey", doc.alias("doc"))


@query("json_path", """SELECT event_id, event_type AS a, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def _(t):
    doc = F.concat(F.lit('{"A":{"B":"'), "event_type", F.lit('"},"C":'), "props", F.lit("}"))
    return t.events.select("event_id", X.json_get(doc, "$.A.B").alias("a"), X.json_get(doc, "$.C.k").alias("k"),
                           X.json_get(doc, "$.A.Z").alias("missing"))


@query("hash_row", """SELECT p_partkey, upper(sha1(concat_ws('|', CAST(p_partkey AS VARCHAR), p_name,
 coalesce(nullif(p_brand, 'Brand#2'), 'NA'), CAST(p_size AS VARCHAR)))) AS hash_value FROM part""")
def _(t):
    brand = F.nullif("p_brand", F.lit("Brand#2"))
    digest = X.row_hash(["p_partkey", "p_name", brand, "p_size"], mode="sha1")
    return t.part.select("p_partkey", digest.alias("hash_value"))


@query("id_monotonic", "SELECT count(*) AS n, count(*) AS n_distinct FROM lineitem")
def _(t):
    return t.lineitem.select(X.surrogate_id().alias("id")).agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_distinct"))
