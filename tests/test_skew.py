"""Queries on tables in which one key holds a third of the rows or more, against their SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from compare import differences, duck, duck_side, spark_side
from conftest import DATA
from tidemark.catalog import Tables

# One order, part, supplier, customer, user, segment and nation take a large share.
HOT = {
    "lineitem": """CASE WHEN l_linenumber <= 2 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_quantity < 17 THEN 11 ELSE l_partkey END AS l_partkey, CASE WHEN l_tax < 0.03 THEN 3 ELSE l_suppkey END AS l_suppkey""",
    "orders": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 5 ELSE o_custkey END AS o_custkey",
    "events": "CASE WHEN event_type IN ('view', 'click') THEN 4 ELSE user_id END AS user_id",
    "customer": """CASE WHEN c_nationkey < 9 THEN 'BUILDING' ELSE c_mktsegment END AS c_mktsegment,
        CASE WHEN c_nationkey < 9 THEN 1 ELSE c_nationkey END AS c_nationkey""",
}
NAMES = ["win_row_number", "win_rank", "win_dense_rank", "win_ntile", "win_rank_over_agg", "win_moving_avg", "mart_employee_ranks",
         "topk_per_group", "cdc_merge", "dim_upsert_exclusion", "audit_resolve_min", "stream_upsert", "mart_category_month_top3",
         "agg_string_xml", "agg_count_distinct", "join_update_from", "sink_bucketed", "sink_range_partitioned"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        cols = f"* REPLACE ({HOT[name]})" if name in HOT else "*"
        duckdb.execute(f"COPY (SELECT {cols} FROM '{path}') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, skewed, name, monkeypatch):
    monkeypatch.setattr(Tables, "split", 12)  # every ranking takes its split form
    got = spark_side(contract.queries()[name](spark, skewed))
    assert not differences(got, duck_side(duck(skewed), contract.oracle_sql()[name]))


def test_hot_join_key_is_split(spark, skewed, plan):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = spark.read.parquet(f"{skewed}/lineitem.parquet").repartition(6)
        from tidemark.operators.joins import lookup

        joined = lookup(lines, spark.read.parquet(f"{skewed}/part.parquet"), {"l_partkey": "p_partkey"}, ["p_type"])
        assert "skew=true" in plan(joined, run=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
