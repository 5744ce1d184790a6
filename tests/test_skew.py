"""Queries on tables in which single keys hold a third of all rows."""

import tempfile

import duckdb
import pytest

from tests.conftest import SMALL
from tools.compare import compare, connect

HOT = {
    "orders": """SELECT * REPLACE (
        CASE WHEN hash(o_orderkey) % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
        CASE WHEN hash(o_orderkey, 1) % 3 = 0 THEN TIMESTAMP '1997-05-05' ELSE o_orderdate END AS o_orderdate)
        FROM '{0}'""",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN hash(l_orderkey, l_extendedprice) % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey,
        CASE WHEN hash(l_orderkey, l_extendedprice, 2) % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN hash(l_orderkey, l_extendedprice, 3) % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey)
        FROM '{0}'""",
}

NAMES = [
    "share_lag", "top5_share", "top300_all_years", "last_activity", "top_rented_mapped", "max_gap_days",
    "two_child_threshold", "null_safe_latest", "best_per_group_tiebreak", "like_in_stock", "in_stock",
    "customer_balance", "on_conflict_nothing", "surrogate_keys", "column_change_log", "post_sales",
    "peer_numbering", "dq_unique",
]


@pytest.fixture(scope="module")
def hot_tables():
    folder = tempfile.mkdtemp(prefix="ledgerlark-skew-")
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        source = f"{SMALL}/{name}.parquet"
        text = HOT.get(name, "SELECT * FROM '{0}'").format(source)
        connection.execute(f"COPY ({text}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_on_hot_keys(spark, conf, hot_tables, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert compare(spark, connect(hot_tables), hot_tables, name) is None
