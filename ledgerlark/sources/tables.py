"""Reading tables, and writing new versions of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.session import materialise

MONEY = "decimal(18,2)"


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def money(column: str | Column) -> Column:
    """Exact money, so that sums do not depend on the order of the tasks."""
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def fit_to(source: DataFrame, target: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Project ``source`` to the columns and types of ``target``.

    A column the source lacks takes its default, and is NULL without one. A column
    it has is taken as it is: an explicit NULL stays NULL.
    """
    defaults = defaults or {}
    columns = []
    for field in target.schema.fields:
        default = defaults.get(field.name)
        default = default if isinstance(default, Column) else F.lit(default)
        if field.name in source.columns:
            value = F.col(field.name)
        else:
            value = default
        columns.append(value.cast(field.dataType).alias(field.name))
    return source.select(*columns)


def create_table_as(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a new table version and read it back."""
    if partition_by:
        # Rebalancing groups rows by partition value and lets AQE cut a value
        # that holds too many rows into several files.
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        writer = df.write
    writer = writer.mode("errorifexists")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def create_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` as the table ``name``.

    Tables bucketed alike join and group on the key without a shuffle.
    """
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def append(df: DataFrame, path: str, defaults: dict | None = None) -> None:
    """Insert rows into the table at ``path``, reordered to its columns."""
    target = df.sparkSession.read.parquet(path)
    fit_to(df, target, defaults).write.mode("append").parquet(path)


def change_partitions(
    spark: SparkSession,
    path: str,
    column: str,
    values: list,
    change: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Copy on write: ``change`` makes new rows of the partitions ``values`` of a table that is
    partitioned by ``column``; all others keep their files.

    Only these partitions are read and written. A row must stay in one of them; otherwise
    nothing is written and ``ValueError`` is raised. A partition that keeps no row goes.
    """
    if not values:
        return spark.read.parquet(path)
    table = spark.read.parquet(path)
    # Written first: the rows are computed once, and are there whatever happens to the old files.
    changed = materialise(change(table.where(F.col(column).isin(values))).select(*table.columns))
    left = {row[0] for row in changed.select(column).distinct().limit(len(values) + 1).collect()}
    if not left <= set(values):
        raise ValueError(f"rows would leave the partitions of {column}: {sorted(map(str, left - set(values)))[:3]}")
    if left:
        (
            changed.hint("rebalance", column).write.mode("overwrite").partitionBy(column)
            .option("partitionOverwriteMode", "dynamic").parquet(path)
        )
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in set(values) - left:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"{column}={value}"), True)
    return spark.read.parquet(path)


def truncate(spark: SparkSession, path: str) -> DataFrame:
    """Leave the table at ``path`` with its schema and without rows."""
    schema = spark.read.parquet(path).schema
    nothing = spark.range(0, 0, 1, 1).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    )
    nothing.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
