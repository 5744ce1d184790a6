"""Ties, numbering and running totals that no single task has to hold.

Spark runs an unpartitioned window in one task, and a window over a hot key in
one task as well. The numbering helpers here cut the rows into parts by value
instead, so that any number of neighbouring rows, of one key or of many, is spread
over tasks; only one small row per part and key crosses between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """All rows that share first place in their key (ties are kept).

    Spark cuts each key before the shuffle, so only the ties travel. Where a
    whole key may tie, use ``latest_rows``.
    """
    place = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= 1).drop("_place")


def latest_rows(df: DataFrame, keys: list[str], at: str, null_safe: bool = False) -> DataFrame:
    """The rows with the greatest ``at`` of each key (ties are kept).

    With ``null_safe`` a key that has no ``at`` at all keeps its rows.

    Written as an aggregate and an equi-join, because any number of rows may
    tie: the aggregate combines before the shuffle and AQE can cut the join.
    """
    last = df.groupBy(*keys).agg(F.max(at).alias("_last")).select(
        *[F.col(key).alias(f"_key_{key}") for key in keys], "_last"
    )
    latest = F.col("_last")
    condition = F.col(at).eqNullSafe(latest) if null_safe else F.col(at) == latest
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return df.join(last, condition, "left_semi")


def _parts(df: DataFrame, key: Column) -> Column | None:
    """The part of each row, counted up in the order of ``key``, a struct; None if
    there is one part only, as with a single row.

    Parts are cut at quantiles of a sample of rows, some for each shuffle
    partition. The cuts are literals, so a row's part depends on its values alone:
    a task that runs again gives the same parts.
    """
    n = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.select(key.alias("_key"))
    sample = keyed.orderBy(F.xxhash64("_key"), "_key").limit(20 * n).orderBy("_key").collect()
    cuts = []
    for i in range(1, n):
        row = sample[i * len(sample) // n]["_key"] if sample else None
        if row is not None and (not cuts or row != cuts[-1]):
            cuts.append(row)
    # The cuts are compared by as few of the leading fields as tell them apart: one of them, as a
    # rule, and then no struct is made for a comparison.
    fields = keyed.schema["_key"].dataType.fields
    width = next((w for w in range(1, len(fields)) if len({row[:w] for row in cuts}) == len(cuts)), len(fields))

    def literal(i: int, row) -> Column:
        return F.lit(row[i]).cast(fields[i].dataType)

    def upto(row) -> Column:
        first = key[fields[0].name]
        if width == 1:
            return first.isNull() if row[0] is None else first.isNull() | (first <= literal(0, row))
        leading = F.struct(*[key[field.name] for field in fields[:width]])
        return leading <= F.struct(*[literal(i, row).alias(fields[i].name) for i in range(width)])

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(upto(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts)) if cuts else None


def part_numbers(df: DataFrame, keys: list[str], order: list[str]) -> Column:
    """The parts that ``running_total`` cuts rows into, to be kept for further totals."""
    part = _parts(df, F.struct(*[F.col(column) for column in [*keys, *order]]))
    return F.lit(0) if part is None else part


def running_total(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, part: str | None = None
) -> DataFrame:
    """Running sum of ``value`` per key; ``order`` is unique within the key.

    Rows are cut into parts by value (see ``_parts``), so that a key of any size
    fills many. Each part is summed on its own, and the sum before a part is added
    to its rows. At most one key per part continues from the one before, so the
    carried sums are as few as the parts. ``part`` may name a column of part numbers
    that were found before.
    """
    found = F.col(part) if part else _parts(df, F.struct(*[F.col(c) for c in [*keys, *order]]))
    kept = [F.col(f"`{column}`") for column in df.columns if column != name]
    upto = Window.unboundedPreceding, Window.currentRow
    if found is None:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.select(*kept, F.sum(value).over(whole).alias(name))
    placed = df.withColumn("_part", found)
    local = F.sum(value).over(Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(*upto))
    totals = placed.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    # Without keys this is one row per part, in one task.
    earlier = F.sum("_sum").over(
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        F.col("_part").alias("_at"), *[F.col(k).alias(f"_of_{k}") for k in keys], earlier.alias("_carried")
    ).where(F.col("_carried").isNotNull())
    same = F.col("_part") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return (
        placed.withColumn("_local", local)
        .join(F.broadcast(carried), same, "left")
        .withColumn(name, F.col("_local") + F.coalesce("_carried", F.lit(0)))
        .select(*kept, name)
    )


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str,
    after: int | Column = 0,
    unique: bool = False,
) -> DataFrame:
    """Consecutive numbers in ascending ``order``, starting behind ``after``.

    Unless the order is ``unique``, ties are broken by a hash of the whole row, and
    rows that are equal as a whole are counted and numbered together, so that any
    number of them can be told apart by their numbers alone.
    """
    columns = df.columns
    keyed = df.select("*", *[column.alias(f"_order{i}") for i, column in enumerate(order)])
    keys = [f"_order{i}" for i in range(len(order))]
    if unique:
        counted = keyed.withColumn("_rows", F.lit(1))
    else:
        counted = keyed.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
        keys.append("_tie")
        counted = counted.groupBy(*counted.columns).agg(F.count("*").alias("_rows"))
    summed = running_total(counted, [], keys, "_rows", "_end")
    after = after if isinstance(after, Column) else F.lit(after)
    summed = summed.withColumn("_last", (after + F.col("_end")).cast("bigint"))
    numbers = F.col("_last")
    if not unique:
        numbers = F.explode(F.sequence(F.col("_last") - F.col("_rows") + 1, F.col("_last")))
    return summed.select(*[F.col(f"`{c}`") for c in columns if c != name], numbers.alias(name))


def first_k_varying(df: DataFrame, keys: list[str], order: str, limit: str) -> DataFrame:
    """The first ``limit`` rows of each key, where the limit is a column that is
    constant within the key. ``order`` is unique within the key, and rows are
    counted as running totals are summed, so a hot key is spread."""
    counted = running_total(df.withColumn("_one", F.lit(1)), keys, [order], "_one", "_place")
    return counted.where(F.col("_place") <= F.col(limit)).drop("_one", "_place")


def peer_numbers(df: DataFrame, order: dict[str, Column], name: str) -> DataFrame:
    """Number of rows up to and including the peers of each row.

    Equal to ``count(*) over (order by ...)`` with its default frame: rows that
    tie share the highest number. ``order`` maps helper names to the
    expressions compared. Peers are counted before they are numbered.
    """
    keyed = df.select("*", *[column.alias(key) for key, column in order.items()])
    keys = list(order)
    peers = keyed.groupBy(*keys).agg(F.count("*").alias("_peers"))
    numbered = running_total(peers, [], keys, "_peers", name).drop("_peers")
    same = [F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")) for key in keys]
    condition = same[0]
    for term in same[1:]:
        condition = condition & term
    return (
        keyed.alias("l")
        .join(numbered.alias("r"), condition)
        .select(*[F.col(f"l.{column}") for column in df.columns], F.col(f"r.{name}"))
    )
