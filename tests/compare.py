"""Compare a Spark result with a DuckDB result: names, type kinds and the multiset of rows."""

import datetime as dt
import decimal
import glob
import math
import os
from collections import Counter

import duckdb

KINDS = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "UBIGINT": "int", "DOUBLE": "float",
         "FLOAT": "float", "VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "ts", "HUGEINT": "huge"}
SPARK_KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "double": "float", "float": "float",
               "string": "str", "boolean": "bool", "date": "date", "timestamp": "ts", "timestamp_ntz": "ts"}


def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return f"dec{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def spark_side(df):
    kinds = {f.name: SPARK_KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    return kinds, rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_side(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    return kinds, rows_of(names, cur.fetchall())


def differences(spark_result, duck_result):
    (sk, sr), (dk, dr) = spark_result, duck_result
    out = []
    if sk != dk:
        out.append(f"types: spark only {set(sk.items()) - set(dk.items())}, sql only {set(dk.items()) - set(sk.items())}")
    if sr != dr:
        a, b = sr - dr, dr - sr
        out.append(f"rows {sum(sr.values())} vs {sum(dr.values())}; spark {list(a)[:2]}; sql {list(b)[:2]}")
    return out
