"""Window frames over rows that were aggregated to a calendar grain first.

The unpartitioned frames run in one task, which is fine for one row per day or
per year and group; aggregate before calling them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.operators.parts import last_before
from ledgerlark.session import materialise


def running_sum(value: str, keys: list[str], order: str) -> Column:
    """Cumulative sum that restarts for every key (ROWS frame)."""
    frame = Window.partitionBy(*keys).orderBy(order)
    return F.sum(value).over(frame.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def moving_sum(value: str, order: str, before: int) -> Column:
    """Sum of the row and the ``before`` rows ahead of it (ROWS frame)."""
    return F.sum(value).over(Window.orderBy(order).rowsBetween(-before, Window.currentRow))


def day_range(aggregate: str, order: str, before: int, after: int) -> Column:
    """Aggregate over real calendar distance (RANGE frame); ``order`` is a DATE
    or a TIMESTAMP column, ``aggregate`` an SQL aggregate such as ``sum(v)``."""
    return F.expr(
        f"{aggregate} OVER (ORDER BY {order} RANGE BETWEEN"
        f" INTERVAL {before} DAY PRECEDING AND INTERVAL {after} DAY FOLLOWING)"
    )


def day_range_average(value: str, order: str, before: int, after: int) -> Column:
    """Average over the days present in the frame, from an exact sum."""
    total = day_range(f"sum({value})", order, before, after)
    present = day_range(f"count({value})", order, before, after)
    return total.cast("double") / present


def weekday_average(value: str, order: str, weekday: Column) -> Column:
    """Centred average: one day to both sides, but Monday reaches back over the
    weekend and Friday reaches forward over it."""
    weekday = F.upper(weekday)
    return (
        F.when(weekday == "MONDAY", day_range_average(value, order, 2, 1))
        .when(weekday == "FRIDAY", day_range_average(value, order, 1, 2))
        .otherwise(day_range_average(value, order, 1, 1))
    )


def with_groups_sum(
    df: DataFrame, value: str, order: str, before: int, name: str, keys: list[str] | None = None
) -> DataFrame:
    """Sum over the peer group of the row and the ``before`` peer groups ahead.

    Spark has no GROUPS frame. Peer groups are numbered without gaps by
    ``dense_rank``, and a RANGE frame over that number covers whole groups.
    """
    keys = keys or []
    ranked = df.withColumn("_group", F.dense_rank().over(Window.partitionBy(*keys).orderBy(order)))
    frame = Window.partitionBy(*keys).orderBy("_group").rangeBetween(-before, Window.currentRow)
    return ranked.withColumn(name, F.sum(value).over(frame)).drop("_group")


def share_of_total(value: str, keys: list[str], digits: int = 2) -> Column:
    """Percentage of the key's total, for few rows per key."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return F.round(F.col(value).cast("double") / total.cast("double") * 100, digits)


def previous(value: str, keys: list[str], order: str) -> Column:
    """The value of the previous row present in the key."""
    return F.lag(value).over(Window.partitionBy(*keys).orderBy(order))


def widest_gap(df: DataFrame, keys: list[str], at: str, name: str) -> DataFrame:
    """Largest step between consecutive distinct values of ``at`` per key.

    Distinct values first; each part of them gets the last value before it, so a key
    with any number of values is spread over tasks. A key with a single value has no step
    and is dropped.
    """
    values = materialise(df.select(*keys, at).where(F.col(at).isNotNull()).distinct())
    steps = last_before(values, keys, [at], at, "_before")
    return (
        steps.where(F.col("_before").isNotNull())
        .groupBy(*keys)
        .agg(F.max(F.col(at) - F.col("_before")).alias(name))
    )
