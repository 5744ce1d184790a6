"""Join shapes used by several reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def natural(column: str | Column) -> Column:
    """Form in which natural keys are compared."""
    return F.lower(F.trim(F.col(column) if isinstance(column, str) else column))


def resolve(
    df: DataFrame, lookup: DataFrame, on: dict[str, str], take: list[str], how: str = "inner"
) -> DataFrame:
    """Natural key to surrogate key: add the ``take`` columns of ``lookup``.

    ``on`` maps columns of ``df`` to columns of ``lookup``. Both sides are
    compared lowered and trimmed, as equality, so the join stays hashable. Where a
    natural key repeats in the lookup, its row with the least ``take`` columns is
    the one taken, so rows of ``df`` are never multiplied.
    """
    return resolve_by(df, keyed_once(lookup, list(on.values()), take), list(on), how)


def keyed_once(lookup: DataFrame, on: list[str], take: list[str]) -> DataFrame:
    """The lookup of ``resolve``, a row per natural key, which is named ``_key0``, ``_key1`` ..."""
    keys = [f"_key{i}" for i in range(len(on))]
    keyed = lookup.select(*[natural(there).alias(key) for key, there in zip(keys, on)], *take)
    return keyed.groupBy(*keys).agg(F.min(F.struct(*take)).alias("_least")).select(
        *keys, *[F.col(f"_least.{column}").alias(column) for column in take]
    )


def resolve_by(df: DataFrame, keyed: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``resolve`` with a lookup of ``keyed_once``, whose keys stand for the columns ``on`` of ``df``."""
    condition = all_of([natural(df[here]) == keyed[f"_key{i}"] for i, here in enumerate(on)])
    return df.join(keyed, condition, how).drop(*[f"_key{i}" for i in range(len(on))])


def with_child_counts(
    parent: DataFrame,
    key: str,
    children: dict[str, DataFrame],
    how: str = "left",
    weight: str = "_rows",
) -> DataFrame:
    """Row count of each child per parent key.

    The children are counted together, in one pass and one shuffle, before the join: no
    fan-out of one child by the other, and a hot parent brings one row per map task. A
    child that has a column ``weight`` is already counted in parts, which are added up.
    """
    rows = reduce(DataFrame.unionByName, [
        child.select(
            key, F.lit(i).alias("_child"),
            (F.col(weight) if weight in child.columns else F.lit(1)).cast("bigint").alias("_n"),
        )
        for i, child in enumerate(children.values())
    ])

    def total(i: int, child: DataFrame) -> Column:
        own = F.when(F.col("_child") == i, F.col("_n"))
        return F.sum(own) if weight in child.columns else F.count(own)

    counts = rows.groupBy(key).agg(*[total(i, child).alias(name) for i, (name, child) in enumerate(children.items())])
    if how == "inner":
        counts = counts.where(all_of([
            F.col(name).isNotNull() if weight in child.columns else F.col(name) > 0
            for name, child in children.items()
        ]))
    result = parent.join(counts, key, how)
    return result.select(
        *parent.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in children]
    )


def periods_seen(period: str, periods: list) -> Column:
    """How many of the given periods, up to 63, a key has rows in, as an aggregate.

    Each period is one bit, so rows combine before the shuffle and no distinct values
    are shuffled or expanded.
    """
    wanted = sorted(set(periods))
    if len(wanted) > 63:
        raise ValueError("more than 63 periods")
    bit = F.lit(0).cast("bigint")
    for i, value in enumerate(wanted):
        bit = F.when(F.col(period) == value, F.lit(1 << i).cast("bigint")).otherwise(bit)
    return F.bit_count(F.bit_or(bit))


def keys_in_all_periods(df: DataFrame, keys: list[str], period: str, periods: list) -> DataFrame:
    """Keys present in every one of the given periods."""
    return (
        df.where(F.col(period).isin(list(periods)))
        .groupBy(*keys)
        .agg(periods_seen(period, periods).alias("_periods"))
        .where(F.col("_periods") == len(set(periods)))
        .select(*keys)
    )


def or_info_row(result: DataFrame, evidence: DataFrame, info: DataFrame) -> DataFrame:
    """``result``, or the one-row relation ``info`` when ``evidence`` is empty."""
    found = F.broadcast(evidence.limit(1).select(F.lit(1).alias("_found")))
    return result.unionByName(info.join(found, F.lit(True), "left_anti"))
