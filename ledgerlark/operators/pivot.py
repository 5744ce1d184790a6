"""Conditional aggregates and crosstabs with a fixed list of categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.text import same_text


def count_columns(category: str, names: dict[str, str]) -> list[Column]:
    """One conditional count per category; ``names`` maps it to a column name."""
    return [
        F.sum(F.when(same_text(category, value), 1).otherwise(0)).alias(name)
        for value, name in names.items()
    ]


def sum_columns(category: str, amount: str, names: dict[str, str]) -> list[Column]:
    """One conditional sum per category, zero where no row matches."""
    return [
        F.coalesce(F.sum(F.when(same_text(category, value), F.col(amount))), F.lit(0)).alias(name)
        for value, name in names.items()
    ]


def counts_on_spine(
    df: DataFrame, row: str, category: str, names: dict[str, str]
) -> DataFrame:
    """The same counts by left-joining one small result per category to the rows.

    The rows are counted once, per row and category; all branches read that.
    """
    wanted = df.where(F.lower(category).isin([value.lower() for value in names]))
    counted = wanted.groupBy(row, F.lower(category).alias("_category")).agg(F.count("*").alias("_n"))
    result = counted.select(row).distinct()
    for value, name in names.items():
        counts = counted.where(F.col("_category") == value.lower()).select(row, F.col("_n").alias(name))
        result = result.join(counts, row, "left")
    return result.select(row, *[F.coalesce(name, F.lit(0)).alias(name) for name in names.values()])


def crosstab(
    df: DataFrame, rows: list[str], category: str, values: list, amount: str, total: str
) -> DataFrame:
    """Sum per row and category; missing cells are zero, ``total`` adds a row sum.

    The category list is fixed, so Spark needs no job to find it. Columns are
    named ``q<value>``.
    """
    wide = df.groupBy(*rows).pivot(category, values).agg(F.sum(amount))
    cells = [F.coalesce(F.col(f"`{value}`"), F.lit(0)).alias(f"q{value}") for value in values]
    wide = wide.select(*rows, *cells)
    row_sum = F.col(f"q{values[0]}")
    for value in values[1:]:
        row_sum = row_sum + F.col(f"q{value}")
    return wide.withColumn(total, row_sum)
