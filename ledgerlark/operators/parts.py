"""Rows cut into parts by value, and what has to cross between the parts.

Spark runs an unpartitioned window in one task, and a window over a hot key in one task as
well. Here rows are cut into parts at quantiles of a sample, in the order of the window, so
that any number of neighbouring rows, of one key or of many, is spread over tasks. What a part
needs of the others is small: how many rows of its first key came before (``top_n``), the last
value before it (``last_before``), or the few rows a frame reaches (``rows_frame``,
``range_frame``, ``groups_frame``).

The cuts are literals of the plan, so a row's part depends on its values alone: a task that
runs again gives the same parts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the sample per part.
SAMPLED = 20


@dataclass(frozen=True)
class By:
    """One key of an order; NULL comes first upwards and last downwards, as in Spark."""

    column: str
    ascending: bool = True

    def sorted(self) -> Column:
        return F.col(self.column).asc() if self.ascending else F.col(self.column).desc()


Placing = Callable[..., Column]


def _behind(values: list[Column], order: list[By], cut: list[Column | None]) -> Column:
    """Whether a row comes after the cut."""
    later = F.lit(False)
    for value, by, at in zip(reversed(values), reversed(order), reversed(cut)):
        if at is None:
            beyond = value.isNotNull() if by.ascending else F.lit(False)
            same = value.isNull()
        else:
            beyond = F.coalesce(value > at if by.ascending else value < at, F.lit(not by.ascending))
            same = F.coalesce(value == at, F.lit(False))
        later = beyond | (same & later)
    return later


def placing(df: DataFrame, order: list[By]) -> Placing:
    """A function from values, in the order of ``order``, to the number of their part.

    There are some parts for each shuffle partition, cut at quantiles of a sample of rows.
    """
    n = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.select(*[F.col(by.column).alias(f"_k{i}") for i, by in enumerate(order)])
    names = keyed.columns
    sample = (
        keyed.orderBy(F.xxhash64(*names), *names).limit(SAMPLED * n)
        .orderBy(*[By(name, by.ascending).sorted() for name, by in zip(names, order)]).collect()
    )
    cuts = []
    for i in range(1, n):
        row = tuple(sample[i * len(sample) // n]) if sample else None
        if row is not None and (not cuts or row != cuts[-1]):
            cuts.append(row)
    types = [field.dataType for field in keyed.schema.fields]

    def place(*values: Column) -> Column:
        def search(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            cut = [None if v is None else F.lit(v).cast(t) for v, t in zip(cuts[middle], types)]
            behind = _behind(list(values), order, cut)
            return F.when(behind, search(middle + 1, high)).otherwise(search(low, middle))

        return search(0, len(cuts))

    return place


def _placed(df: DataFrame, order: list[By]) -> DataFrame:
    return df.withColumn("_part", placing(df, order)(*[F.col(by.column) for by in order]))


def _same(keys: list[str]) -> Column:
    same = F.col("_part") == F.col("_at")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return same


def _carried(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """What rows of (part, key) hand on to later parts of the key. A key that lies in one
    part hands on nothing, so these are no more rows than parts."""
    return rows.select(
        F.col("_part").alias("_at"), *[F.col(key).alias(f"_of_{key}") for key in keys], value.alias("_carried")
    ).where(F.col("_carried").isNotNull())


def top_n(df: DataFrame, keys: list[str], order: list[By], n: int) -> DataFrame:
    """The first ``n`` rows of each key with their ``place``; ``order`` must break all ties.

    Rows are counted per part and key first. Of a key that fills several parts only those
    that begin within its first ``n`` rows are sorted, each in a task of its own.
    """
    placed = _placed(df, [*map(By, keys), *order])
    sizes = placed.groupBy("_part", *keys).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = _carried(sizes, keys, F.sum("_rows").over(earlier))
    before = F.coalesce("_carried", F.lit(0))
    local = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*[by.sorted() for by in order]))
    return (
        placed.join(F.broadcast(carried), _same(keys), "left")
        .where(before < n)
        .withColumn("_local", local)
        .where(F.col("_local") <= n)
        .withColumn("place", (F.col("_local") + before).cast("int"))
        .where(F.col("place") <= n)
        .select(*[F.col(f"`{c}`") for c in df.columns], "place")
    )


def last_before(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The last ``value`` that is not NULL before each row of its key, NULL where there is none.

    ``order`` is ascending and breaks all ties between rows that differ in ``value``.
    """
    placed = _placed(df, [By(c) for c in [*keys, *order]])
    there = F.col(value).isNotNull()
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])
    lasts = placed.where(there).groupBy("_part", *keys).agg(F.max_by(value, place).alias("_last"))
    # A part without a value hands on what it got.
    slots = placed.select("_part", *keys).distinct().join(
        lasts.withColumnsRenamed({"_part": "_at", **{key: f"_of_{key}" for key in keys}}), _same(keys), "left"
    )
    upto = Window.unboundedPreceding, -1
    carried = _carried(
        slots.select("_part", *keys, "_last"), keys,
        F.last("_last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(*upto)),
    )
    local = F.last(value, ignorenulls=True).over(
        Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(*upto)
    )
    return (
        placed.withColumn("_local", local)
        .join(F.broadcast(carried), _same(keys), "left")
        .select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.coalesce("_local", "_carried").alias(name))
    )


def _number_of(position: Column, starts: list[int]) -> Column:
    """The part that holds a position, given where each part starts."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high + 1) // 2
        return F.when(position >= starts[middle], search(middle, high)).otherwise(search(low, middle - 1))

    return search(0, len(starts) - 1)


def rows_frame(
    df: DataFrame, order: list[str], before: int, after: int, aggregates: dict[str, Column]
) -> DataFrame:
    """``aggregates`` over the rows from ``before`` ahead of each row to ``after`` behind it.

    ``order`` breaks all ties between rows that differ. Each part gets the rows of its
    neighbours that its frames reach, however many parts these lie in.
    """
    placed = _placed(df, [By(c) for c in order])
    sizes = dict(placed.groupBy("_part").count().collect())  # a row per part
    numbers = {part: i for i, part in enumerate(sorted(sizes))}
    starts, at = [], 0
    for part in sorted(sizes):
        starts.append(at)
        at += sizes[part]
    if not starts:
        starts, numbers = [0], {0: 0}
    first = F.element_at(F.create_map(*[F.lit(x) for p, i in numbers.items() for x in (p, starts[i])]), F.col("_part"))
    position = first + F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    # A row stands in the frames of the rows from ``after`` ahead of it to ``before`` behind it.
    numbered = placed.withColumn("_position", position)
    reached = F.sequence(
        _number_of(F.greatest(F.col("_position") - after, F.lit(0)), starts),
        _number_of(F.col("_position") + before, starts),
    )
    spread = numbered.select("*", F.explode(reached).alias("_to"))
    frame = Window.partitionBy("_to").orderBy("_position").rowsBetween(-before, after)
    framed = spread.select("*", *[value.over(frame).alias(name) for name, value in aggregates.items()])
    own = F.col("_to") == _number_of(F.col("_position"), starts)
    return framed.where(own).select(*[F.col(f"`{c}`") for c in df.columns], *aggregates)


def range_frame(
    df: DataFrame, order: str, before: str, after: str, sums: dict[str, Column]
) -> DataFrame:
    """Sums over all rows whose ``order`` lies within the SQL intervals ``before`` and ``after`` of
    a row's own; rows without it make one frame. ``sums`` maps names to what is added up.

    Rows with equal ``order`` have the same frame, so they are added up first and each value
    stands once, however many rows share it.
    """
    values = df.groupBy(order).agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    place = placing(values, [By(order)])
    at = F.col(order)
    reached = F.sequence(place(at - F.expr(after)), place(at + F.expr(before)))
    spread = values.withColumn("_part", place(at)).withColumn("_to", F.explode(reached))
    framed = spread.select(
        order, "_part", "_to",
        *[F.expr(
            f"sum(`{name}`) OVER (PARTITION BY _to ORDER BY `{order}` RANGE BETWEEN {before} PRECEDING"
            f" AND {after} FOLLOWING)"
        ).alias(name) for name in sums],
    ).where("_part = _to")
    return _joined_by(df, framed, order, list(sums))


def groups_frame(df: DataFrame, order: str, before: int, after: int, sums: dict[str, Column]) -> DataFrame:
    """Sums over all rows of the groups of equal ``order`` from ``before`` ahead of a row's own group
    to ``after`` behind it. Groups are added up first."""
    values = df.groupBy(order).agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    # The sums of the groups have other names than the sums over the frame.
    values = values.withColumnsRenamed({name: f"_of_{name}" for name in sums})
    framed = rows_frame(values, [order], before, after, {name: F.sum(f"_of_{name}") for name in sums})
    return _joined_by(df, framed, order, list(sums))


def _joined_by(df: DataFrame, framed: DataFrame, order: str, names: list[str]) -> DataFrame:
    found = framed.select(F.col(order).alias("_value"), *names)
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept).join(found, F.col(order).eqNullSafe(F.col("_value"))).drop("_value")
