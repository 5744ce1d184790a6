"""Integrity rules as queries that find or count what breaks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import all_of


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def in_domain(column: str, values: list) -> Column:
    """A value from the list, or NULL."""
    return F.col(column).isin(list(values))


def normal_form(column: str) -> Column:
    """Stored lowered and trimmed."""
    return F.col(column) == F.lower(F.trim(column))


def not_blank(column: str) -> Column:
    return F.length(F.trim(column)) > 0


def rule_report(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules counted in one pass.

    As with CHECK, a rule is broken only where it is false, not where it is
    NULL; ``not_null`` is never NULL.
    """
    names = list(rules)
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~rules[name]).alias(f"_rule{i}") for i, name in enumerate(names)],
    )
    report = F.array(
        *[
            F.struct(F.lit(name).alias("rule_name"), F.col(f"_rule{i}").alias("violations"))
            for i, name in enumerate(names)
        ]
    )
    return counts.select("_rows", F.explode(report).alias("_r")).select(
        F.lit(table).alias("table_name"),
        F.col("_r.rule_name").alias("rule_name"),
        F.col("_rows").alias("checked_rows"),
        F.col("_r.violations").alias("violations"),
    )


def violations(df: DataFrame, rule: Column) -> DataFrame:
    """The rows that break a rule."""
    return df.where(~rule)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; a key with a NULL part is never equal."""
    filled = all_of([F.col(key).isNotNull() for key in keys])
    return (
        df.where(filled)
        .groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key, if set, has no parent."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    return child.where(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_parent"), "left_anti"
    )


def set_null_on_delete(child: DataFrame, key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Child table after its parents in ``deleted`` are gone: their key is NULL."""
    gone = deleted.select(F.col(deleted_key).alias("_gone")).distinct()
    joined = child.join(gone, F.col(key) == F.col("_gone"), "left")
    return joined.withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).drop("_gone")


def completeness_by_stage(tables: dict[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """``completeness`` before and after the named column is filled by a default;
    each table is read once."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("total_rows"),
            F.count(column).alias("before"),
            F.count(F.coalesce(F.col(column), default)).alias("after"),
        )
        for name, (df, column, default) in tables.items()
    ]
    wide = reduce(DataFrame.unionByName, parts)
    return wide.unpivot(["table_name", "total_rows"], ["before", "after"], "stage", "set_rows")


def completeness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per table, and rows in which the named column is set."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("total_rows"),
            F.count(column).alias("set_rows"),
        )
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
