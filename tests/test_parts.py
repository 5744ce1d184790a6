"""Windows cut into parts by value, against plain loops; a key or a value may hold most rows."""

import random
from datetime import date, timedelta
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import parts
from ledgerlark.operators.frames import widest_gap
from ledgerlark.operators.parts import By
from tests.conftest import bag


@pytest.fixture
def many_parts(conf):
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")


def hot(n=600, seed=3):
    """Most rows in key 1; a null key, a key of one row; ``v`` ties, ``i`` does not."""
    rng = random.Random(seed)
    rows = [(1 if rng.random() < 0.7 else rng.choice([2, 3, None]), i, rng.choice([None, *range(9)])) for i in range(n)]
    rows.append((9, n, 4))
    rng.shuffle(rows)
    return rows


def down(v):
    """Downwards, NULL last, as Spark sorts."""
    return (v is None, 0 if v is None else -v)


def up(v):
    return (v is not None, 0 if v is None else v)


@pytest.fixture
def df(spark):
    return spark.createDataFrame(hot(), "k int, i int, v int").repartition(5)


def tasks(result):
    """Tasks that bring forth rows of the result."""
    return len(result.select(F.spark_partition_id().alias("t")).distinct().collect())


@pytest.mark.parametrize("n", [1, 10, 150, 5000])
def test_top_n(many_parts, df, n):
    got = parts.top_n(df, ["k"], [By("v", False), By("i")], n)
    want = []
    for _, rows in groupby(sorted(hot(), key=lambda r: (str(r[0]), down(r[2]), r[1])), key=lambda r: r[0]):
        want += [(*r, place + 1) for place, r in enumerate(list(rows)[:n])]
    assert bag(got) == sorted(want, key=repr)


def test_a_hot_key_is_sorted_in_many_tasks(many_parts, df):
    """And of the parts behind the first n rows none is sorted."""
    every = parts.top_n(df.where("k = 1"), ["k"], [By("v", False), By("i")], 5000)
    assert tasks(every) > 4
    few = parts.top_n(df.where("k = 1"), ["k"], [By("i")], 10)
    assert bag(few.select("i")) == sorted([(i,) for k, i, _ in sorted(hot(), key=lambda r: r[1]) if k == 1][:10], key=repr)


@pytest.mark.parametrize("ascending", [True, False])
def test_parts_follow_the_order(many_parts, df, ascending):
    """Whatever the direction, a row in an earlier part never comes after one in a later part."""
    place = parts.placing(df, [By("v", ascending), By("i")])
    rows = df.select("v", "i", place(F.col("v"), F.col("i")).alias("p")).collect()
    key = up if ascending else down
    rows.sort(key=lambda r: (key(r.v), r.i))
    numbers = [r.p for r in rows]
    assert numbers == sorted(numbers) and len(set(numbers)) > 4


def test_last_before(many_parts, df):
    want = []
    for _, rows in groupby(sorted(hot(), key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        last = None
        for k, i, v in rows:
            want.append((k, i, v, last))
            last = v if v is not None else last
    got = parts.last_before(df, ["k"], ["i"], "v", "last")
    assert bag(got) == sorted(want, key=repr)
    assert tasks(got) > 4


def test_last_before_over_parts_without_a_value(many_parts, spark):
    """One value at the start goes on through parts that have none."""
    rows = [(1, i, 7 if i == 0 else None) for i in range(400)] + [(2, 0, None)]
    got = parts.last_before(spark.createDataFrame(rows, "k int, i int, v int"), ["k"], ["i"], "v", "last")
    assert bag(got.select("k", "i", "last")) == sorted([(1, i, 7 if i else None) for i in range(400)] + [(2, 0, None)], key=repr)


def test_widest_gap_of_a_hot_key(many_parts, spark):
    rng = random.Random(8)
    rows = [(1 if rng.random() < 0.8 else 2, rng.randrange(5000)) for _ in range(900)] + [(3, 5), (3, 5), (4, None)]
    want = []
    for key in (1, 2):
        at = sorted({v for k, v in rows if k == key})
        want.append((key, max(b - a for a, b in zip(at, at[1:]))))
    got = widest_gap(spark.createDataFrame(rows, "k int, at int"), ["k"], "at", "gap")
    assert bag(got) == want


@pytest.mark.parametrize("before, after", [(2, 0), (0, 0), (1, 3), (700, 1)])
def test_rows_frame(many_parts, df, before, after):
    rows = sorted(hot(), key=lambda r: r[1])
    got = parts.rows_frame(df, ["i"], before, after, {"s": F.sum("v"), "n": F.count("*")})
    want = []
    for at, row in enumerate(rows):
        frame = [r[2] for r in rows[max(0, at - before) : at + after + 1]]
        there = [v for v in frame if v is not None]
        want.append((*row, sum(there) if there else None, len(frame)))
    assert bag(got) == sorted(want, key=repr)
    assert tasks(got) > 4


def test_range_and_groups_frames(many_parts, spark):
    """A day holds a third of all rows, days are missing, and some rows have no day."""
    rng = random.Random(6)
    start = date(2020, 2, 25)
    days = [start if rng.random() < 0.35 else start + timedelta(rng.randrange(120)) for _ in range(500)]
    rows = [(i, day, rng.randrange(50)) for i, day in enumerate(days)] + [(900, None, 5), (901, None, 6)]
    df = spark.createDataFrame(rows, "i int, day date, v int")
    known = sorted({day for _, day, _ in rows if day})

    def total(inside):
        return sum(v for _, day, v in rows if inside(day))

    want = []
    for i, day, v in rows:
        if day is None:
            want.append((i, day, v, 11))
        else:
            want.append((i, day, v, total(lambda d: d and day - timedelta(2) <= d <= day + timedelta(1))))
    got = parts.range_frame(df, "day", "INTERVAL 2 DAY", "INTERVAL 1 DAY", {"s": F.col("v")})
    assert bag(got) == sorted(want, key=repr)
    groups = [None, *known]
    want = []
    for i, day, v in rows:
        at = groups.index(day)
        near = groups[max(0, at - 1) : at + 1]
        want.append((i, day, v, total(lambda d: d in near)))
    got = parts.groups_frame(df, "day", 1, 0, {"s": F.col("v")})
    assert bag(got) == sorted(want, key=repr)


def test_no_rows(spark):
    df = spark.createDataFrame([], "k int, i int, v int, day date")
    assert parts.top_n(df, ["k"], [By("i")], 3).collect() == []
    assert parts.last_before(df, ["k"], ["i"], "v", "x").collect() == []
    assert parts.rows_frame(df, ["i"], 1, 1, {"s": F.sum("v")}).collect() == []
    assert parts.range_frame(df, "day", "INTERVAL 1 DAY", "INTERVAL 1 DAY", {"s": F.col("v")}).collect() == []
    assert parts.groups_frame(df, "day", 1, 1, {"s": F.col("v")}).collect() == []
