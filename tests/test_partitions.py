"""Copy on write by partition, and joins by the layout of the tables."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.joins import keys_in_all_periods, with_child_counts
from ledgerlark.plans.catalog import QUERIES
from ledgerlark.sources import tables
from tests.conftest import SMALL, bag


@pytest.fixture
def by_month(spark, tmp_path):
    path = str(tmp_path / "payments")
    rows = [(i, f"1997-0{1 + i % 4}", i * 10) for i in range(40)]
    tables.create_table_as(spark.createDataFrame(rows, "id int, month string, amount int"), path, ["month"])
    return path


def files(path):
    return {
        folder: sorted(f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet"))
        for folder in sorted(os.listdir(path)) if folder.startswith("month=")
    }


def test_other_partitions_keep_their_files(spark, by_month):
    before = files(by_month)
    after = tables.change_partitions(
        spark, by_month, "month", ["1997-02"], lambda rows: rows.withColumn("amount", F.col("amount") + 1)
    )
    now = files(by_month)
    assert {k for k in before if before[k] != now[k]} == {"month=1997-02"}
    assert bag(after.select("id", "amount")) == sorted([(i, i * 10 + (i % 4 == 1)) for i in range(40)], key=repr)


def test_a_partition_without_rows_goes(spark, by_month):
    after = tables.change_partitions(
        spark, by_month, "month", ["1997-01", "1997-03"], lambda rows: rows.where("month = '1997-03' and id > 10")
    )
    assert list(files(by_month)) == ["month=1997-02", "month=1997-03", "month=1997-04"]
    assert after.count() == 20 + len([i for i in range(40) if i % 4 == 2 and i > 10])


def test_rows_that_would_leave_their_partitions(spark, by_month):
    before = files(by_month)
    with pytest.raises(ValueError, match="1999-09"):
        tables.change_partitions(
            spark, by_month, "month", ["1997-02"], lambda rows: rows.withColumn("month", F.lit("1999-09"))
        )
    assert files(by_month) == before
    assert tables.change_partitions(spark, by_month, "month", [], lambda rows: rows).count() == 40


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_and_group_without_a_shuffle(spark):
    text = plan(QUERIES["bucketed_priority_revenue"](spark, SMALL))
    assert "Exchange" not in text and "SortMergeJoin" in text


def test_periods_and_children_take_one_exchange(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = [(k, p) for k in range(20) for p in range(k % 5) for _ in range(3)]
    df = spark.createDataFrame(rows, "k int, p int")
    found = keys_in_all_periods(df, ["k"], "p", [0, 1, 2])
    assert bag(found) == sorted([(k,) for k in range(20) if k % 5 >= 3], key=repr)
    text = plan(found).split("== Initial Plan ==")[0]
    assert text.count("Exchange hashpartitioning") == 1 and "Expand" not in text
    parent = spark.createDataFrame([(k,) for k in range(6)], "k int")
    other = spark.createDataFrame([(0, 5), (4, 2), (None, 1)], "k int, _rows int")
    for how in ("left", "inner"):
        counted = with_child_counts(parent, "k", {"a": df, "b": other}, how)
        want = [(k, 3 * (k % 5), {0: 5, 4: 2}.get(k, 0)) for k in range(6)]
        if how == "inner":
            want = [w for w in want if w[1] and w[2]]
        assert bag(counted) == sorted(want, key=repr)
        # One for the counts of all children, one for the parents.
        assert plan(counted).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 2


def test_too_many_periods(spark):
    with pytest.raises(ValueError):
        keys_in_all_periods(spark.range(1), ["id"], "id", list(range(64)))
