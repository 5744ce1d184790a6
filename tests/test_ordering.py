"""Numbering, running totals and top-n against brute force, with hot keys."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import ordering
from tests.conftest import bag, rows


@pytest.fixture
def spread(conf):
    """Many parts."""
    conf(
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="7",
    )


def hot_rows(n=3000, seed=1):
    """A third of all rows in key 0, the rest in 200 keys."""
    rng = random.Random(seed)
    data = [
        (0 if rng.random() < 1 / 3 else rng.randrange(1, 200), i, rng.randrange(1, 50))
        for i in range(n)
    ]
    rng.shuffle(data)
    return data


def test_number_rows_counts_up_in_order(spark, spread):
    data = hot_rows()
    df = spark.createDataFrame(data, "k int, i int, v int").repartition(5)
    numbered = ordering.number_rows(df, [F.col("k"), -F.col("i")], "n", after=100)
    want = sorted(data, key=lambda r: (r[0], -r[1]))
    got = sorted(rows(numbered.select("n", "k", "i", "v")))
    assert got == [(101 + place, *row) for place, row in enumerate(want)]


def test_number_rows_cuts_rows_that_are_all_equal(spark, spread):
    df = spark.range(0, 5000, numPartitions=5).select(F.lit(1).alias("k"))
    numbered = ordering.number_rows(df, [F.col("k")], "n")
    assert numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()[:] == (1, 5000, 5000)


def test_running_total_spreads_a_hot_key(spark, spread):
    data = hot_rows()
    df = spark.createDataFrame(data, "k int, i int, v int")
    summed = ordering.running_total(df, ["k"], ["i"], "v", "total")
    totals, want = defaultdict(int), []
    for k, i, v in sorted(data):
        totals[k] += v
        want.append((k, i, v, totals[k]))
    assert bag(summed.select("k", "i", "v", "total")) == sorted(want, key=repr)
    part = ordering._parts(df, F.struct("k", "i"))
    sizes = df.groupBy(part.alias("part"), "k").count().where("k = 0").collect()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 500


def test_running_total_carries_over_for_a_null_key(spark, spread):
    data = [(None, i, 1) for i in range(400)] + [(1, i, 2) for i in range(30)]
    df = spark.createDataFrame(data, "k int, i int, v int")
    got = ordering.running_total(df, ["k"], ["i"], "v", "total")
    assert bag(got.select("k", "i", "total")) == sorted(
        [(None, i, i + 1) for i in range(400)] + [(1, i, 2 * i + 2) for i in range(30)], key=repr
    )


def test_equal_rows_get_numbers_of_their_own(spark, spread):
    df = spark.createDataFrame([("b", 1)] * 50 + [("a", 2), ("a", 3), (None, None)], "k string, v int")
    got = ordering.number_rows(df, [F.col("k")], "n", after=5).collect()
    assert sorted(r.n for r in got) == list(range(6, 59))
    assert [r.k for r in sorted(got, key=lambda r: r.n)] == [None, "a", "a"] + ["b"] * 50


def test_parts_of_no_rows(spark):
    df = spark.createDataFrame([], "k int, i int, v int")
    assert ordering.running_total(df, ["k"], ["i"], "v", "total").collect() == []
    assert ordering.number_rows(df, [F.col("k")], "n").collect() == []


def test_running_total_without_keys(spark, spread):
    df = spark.range(1, 2001).withColumn("v", F.col("id") * 2)
    summed = ordering.running_total(df, [], ["id"], "v", "total")
    assert summed.where(F.col("total") != F.col("id") * (F.col("id") + 1)).count() == 0
    assert summed.count() == 2000


def test_peers_share_the_highest_number(spark, spread):
    data = [("b",), ("A",), ("a",), ("c",), ("B",), (None,), ("a",)]
    df = spark.createDataFrame(data, "t string")
    numbered = ordering.peer_numbers(df, {"_t": F.upper("t")}, "n")
    assert bag(numbered) == sorted(
        [(None, 1), ("A", 4), ("a", 4), ("a", 4), ("b", 6), ("B", 6), ("c", 7)], key=repr
    )


def test_peer_numbers_equal_the_window_count(spark, spread):
    df = spark.createDataFrame(hot_rows(), "k int, i int, v int")
    got = ordering.peer_numbers(df, {"_k": F.col("k"), "_v": F.col("v")}, "n")
    want = df.withColumn("n", F.expr("count(*) over (order by k, v)"))
    assert bag(got) == bag(want)


def test_best_rows_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "k int, v int, t string")
    assert bag(ordering.best_rows(df, ["k"], [F.desc("v")])) == [(1, 5, "a"), (1, 5, "b"), (2, 1, "d")]


def test_latest_rows(spark):
    data = [(1, 5), (1, 5), (1, None), (2, None), (2, None), (None, 3), (None, 2)]
    df = spark.createDataFrame(data, "k int, t int")
    assert bag(ordering.latest_rows(df, ["k"], "t")) == sorted([(1, 5), (1, 5), (None, 3)], key=repr)
    assert bag(ordering.latest_rows(df, ["k"], "t", null_safe=True)) == sorted(
        [(1, 5), (1, 5), (2, None), (2, None), (None, 3)], key=repr
    )


def test_first_k_varying(spark):
    data = [(k, limit, i) for k, limit in ((1, 2), (2, 0), (3, 900)) for i in range(700)]
    df = spark.createDataFrame(data, "k int, most int, i long")
    got = ordering.first_k_varying(df, ["k"], "i", "most")
    assert bag(got) == sorted([r for r in data if r[2] < r[1]], key=repr)


def test_cuts_compare_as_few_fields_as_tell_them_apart(spark, spread):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("i"), F.lit(1).alias("same"))
    df = df.localCheckpoint()

    def plan(keys, order):
        placed = df.select(ordering.part_numbers(df, keys, order).alias("part"))
        return placed._jdf.queryExecution().optimizedPlan().toString()

    assert "struct" not in plan([], ["i", "same"]) and "CASE" in plan([], ["i", "same"])
    assert "struct" in plan(["same"], ["i"])


def test_numbers_where_the_first_field_is_null_or_no_number(spark, spread):
    values = [None, float("nan"), float("-inf"), -0.0, 0.0, 1.5, float("inf")]
    df = spark.range(700).select(
        F.array(*[F.lit(v).cast("double") for v in values])[(F.col("id") % 7).cast("int")].alias("v"),
        (F.col("id") * 3 % 700).alias("i"),
    )
    want = [row.i for row in df.orderBy("v", "i").collect()]
    got = ordering.number_rows(df, [F.col("v"), F.col("i")], "n", unique=True).orderBy("n").collect()
    assert [row.n for row in got] == list(range(1, 701))
    assert [row.i for row in got] == want
    few = spark.createDataFrame([(None, 1), (1.0, 2), (2.0, 3), (float("nan"), 4)], "v double, i int")
    assert sorted(rows(ordering.number_rows(few, [F.col("v")], "n", unique=True).select("n", "i"))) == [
        (1, 1), (2, 2), (3, 3), (4, 4)]
