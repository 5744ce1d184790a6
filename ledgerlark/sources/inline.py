"""Inline relations: literal rows, integer series, array elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows. They are part of the plan, so Spark knows that they are few."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(
            *[F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(fields, row, strict=True)]
        )
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def series(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """The integers ``first`` .. ``last``, made by the executors."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def numbered_text(prefix: str, number: Column) -> Column:
    """``prefix`` in capitals followed by the number."""
    return F.concat(F.upper(F.lit(prefix)), number.cast("string"))


def suffix_number(column: Column, prefix: str) -> Column:
    """The number behind ``prefix``, whatever the case of the text."""
    return F.replace(F.lower(column), F.lower(F.lit(prefix)), F.lit("")).cast("bigint")


def clean_names(spark: SparkSession, names: list[str | None]) -> DataFrame:
    """Array to rows: trimmed, lowered, distinct, blanks dropped."""
    array = F.lit(None).cast("array<string>") if names is None else F.array(
        *[F.lit(name).cast("string") for name in names]
    )
    exploded = spark.range(1).select(F.explode(array).alias("entry"))
    return (
        exploded.where(F.btrim("entry") != "")
        .select(F.lower(F.btrim("entry")).alias("name"))
        .distinct()
    )
