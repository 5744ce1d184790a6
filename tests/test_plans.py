"""What the plans look like where it matters at scale."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import joins, quality
from ledgerlark.plans.catalog import QUERIES
from ledgerlark.session import cluster_settings
from ledgerlark.sources import tables
from tests.conftest import SMALL, bag


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")


ONE_ROW = r"(HashAggregate\(keys=\[\]|SortAggregate\(key=\[\]|GlobalLimit 1|TakeOrderedAndProject\(limit=1)"


def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, no_broadcast):
    """Nested loops only with a global aggregate, a LIMIT 1 or one literal row."""
    for name, query in QUERIES.items():
        text = plan(query(spark, SMALL))
        assert "CartesianProduct" not in text, name
        assert "EvalPython" not in text and "InPandas" not in text, name
        for match in re.finditer(r"BroadcastNestedLoopJoin", text):
            assert re.search(ONE_ROW, text[match.start():]), name


@pytest.mark.parametrize("name", ["share_lag", "join_address", "quarter_by_date", "rows_frame", "weekly_cumsum"])
def test_period_predicates_reach_the_scan(spark, name):
    pushed = " ".join(re.findall(r"PushedFilters: \[.*", plan(QUERIES[name](spark, SMALL))))
    assert "GreaterThanOrEqual(" in pushed


def test_scans_read_only_the_columns_needed(spark):
    text = plan(QUERIES["quarter_by_date"](spark, SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text


def test_latest_month_filters_with_a_scalar_subquery(spark):
    assert "Subquery" in plan(QUERIES["rewards_report"](spark, SMALL))


def skewed(spark, rows=60000):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997)
    return spark.range(0, rows, numPartitions=12).select(
        key.alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )


@pytest.fixture
def small_pieces(conf, no_broadcast):
    conf(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
        spark__sql__shuffle__partitions="16",
    )


def final_plan(df):
    """The plan after it has run; counting rows through the same query."""
    df.collect()
    return plan(df)


def test_a_hot_join_key_is_cut(spark, small_pieces):
    children = skewed(spark)
    parents = spark.range(0, 900).withColumnRenamed("id", "p")
    found = quality.orphans(children, "k", parents, "p")
    text = final_plan(found)
    assert "skew=true" in text
    assert found.count() == children.where("k >= 900").count()


def test_a_hot_join_key_is_cut_even_if_rows_are_grouped_by_it(spark, small_pieces):
    children = skewed(spark)
    parents = spark.range(0, 997).select(F.col("id").alias("k"), (F.col("id") % 5).alias("g"))
    grouped = children.join(parents, "k").groupBy("k", "g").agg(F.max("pad").alias("m"), F.count("*").alias("n"))
    text = final_plan(grouped)
    assert "skew=true" in text
    assert sum(r.n for r in grouped.collect()) == 60000


def test_children_are_counted_before_the_join(spark, small_pieces):
    children = skewed(spark)
    parents = spark.range(0, 1000).withColumnRenamed("id", "k")
    counted = joins.with_child_counts(parents, "k", {"n": children, "m": children.where("id < 10")})
    hot = counted.where("k = 0").first()
    assert (hot.n, hot.m) == (children.where("k = 0").count(), children.where("k = 0 and id < 10").count())
    text = plan(counted)
    # Map-side aggregation sits below the shuffle that feeds the join.
    assert text.count("partial_count") == 2
    assert bag(counted.agg(F.sum("n"))) == [(60000,)]


def test_bucketed_tables_join_and_group_without_a_shuffle(spark, no_broadcast):
    folder = tempfile.mkdtemp(prefix="ledgerlark-buckets-")
    orders = tables.create_bucketed(
        tables.load(spark, SMALL, "orders"), "bucketed_orders", f"{folder}/orders", "o_orderkey", 4)
    lines = tables.create_bucketed(
        tables.load(spark, SMALL, "lineitem"), "bucketed_lines", f"{folder}/lines", "l_orderkey", 4)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey").count()
    assert "Exchange" not in plan(joined)
    assert joined.agg(F.sum("count")).first()[0] == 6000


def test_cluster_settings_grow_with_the_shuffle():
    small, large = cluster_settings(10**9, 8), cluster_settings(10 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) > 37_000
