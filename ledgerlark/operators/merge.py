"""Set-based changes to a table.

Parquet tables have no INSERT/UPDATE/DELETE, so each change takes the table
and returns the next version of it together with the affected rows. Nothing is
written here; see ``sources.tables`` for the sinks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators.joins import all_of
from ledgerlark.operators.ordering import number_rows
from ledgerlark.sources.tables import fit_to


# The language of a new film that states none, and what its row holds
# beside the proposal.
DEFAULT_LANGUAGE = "Klingon"
NEW_ITEM = {
    "description": "Inserted via core.new_movie()",
    "rental_duration": 3,
    "rental_rate": "4.99",
    "length": 90,
    "replacement_cost": "19.99",
    "rating": "PG",
    "special_features": ["Trailers"],
}


class Change(NamedTuple):
    table: DataFrame
    affected: DataFrame


def _absent(source: DataFrame, target: DataFrame, keys: list[str], ignore_case: list[str]) -> DataFrame:
    def form(column: str) -> Column:
        return F.upper(F.col(column)) if column in ignore_case else F.col(column)

    taken = target.select(*[form(key).alias(f"_taken{i}") for i, key in enumerate(keys)])
    condition = all_of([form(key) == F.col(f"_taken{i}") for i, key in enumerate(keys)])
    return source.join(taken, condition, "left_anti")


def insert_if_absent(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    ignore_case: list[str] | None = None,
    defaults: dict | None = None,
) -> Change:
    """Insert the source rows whose natural key the target does not hold.

    Only the target is searched: two source rows with one new key both go in.
    """
    new = fit_to(_absent(source, target, keys, ignore_case or []), target, defaults)
    return Change(target.unionByName(new), new)


def insert_on_conflict_nothing(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    defaults: dict | None = None,
) -> Change:
    """Insert unless the key is taken, by the target or earlier in the batch.

    The earliest row of a key, by ``order``, is found by an aggregate with
    map-side combine, so a hot key is not gathered anywhere. A NULL key never
    conflicts, so such rows all go in.
    """
    rest = [column for column in batch.columns if column not in keys]
    first = [*order, *[column for column in rest if column not in order]]
    filled = all_of([F.col(key).isNotNull() for key in keys])
    winners = (
        batch.where(filled)
        .groupBy(*keys)
        .agg(F.min(F.struct(*[F.col(column) for column in first])).alias("_row"))
        .select(*keys, *[F.col(f"_row.{column}").alias(column) for column in rest])
    )
    open_rows = winners.select(*batch.columns).unionByName(batch.where(~filled))
    new = fit_to(_absent(open_rows, target, keys, []), target, defaults)
    return Change(target.unionByName(new), new)


def update_from(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    columns: list[str],
    stamp: tuple[str, Column] | None = None,
) -> Change:
    """Set ``columns`` of the rows that ``changes`` names.

    Of several changes for one key the least holds, compared by ``columns`` in
    their order with NULL first; they are cut to one per key before the join, with
    map-side combine, so that no target row is doubled. ``stamp`` names a column that records the change, on changed rows only.
    Spark broadcasts the changes if they are known to be few.
    """
    one = F.min(F.struct(*[F.col(c) for c in columns])) if columns else F.lit(None)
    incoming = changes.groupBy(key).agg(one.alias("_new")).select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in columns]
    )
    joined = target.join(incoming, key, "left")
    stamped = stamp[0] if stamp else None

    def value(column: str) -> Column:
        if column in columns:
            return F.when(F.col("_hit"), F.col(f"_new_{column}")).otherwise(F.col(column))
        if column == stamped:
            return F.when(F.col("_hit"), stamp[1]).otherwise(F.col(column))
        return F.col(column)

    types = dict(target.dtypes)
    updated = joined.select(
        *[value(column).cast(types[column]).alias(column) for column in target.columns], "_hit"
    )
    return Change(updated.drop("_hit"), updated.where("_hit").drop("_hit"))


def update_latest_row(target: DataFrame, id_column: str, values: dict[str, Column]) -> Change:
    """Update the row that holds the greatest id."""
    last = target.agg(F.max(id_column)).scalar()
    marked = target.withColumn("_hit", F.col(id_column) == last)
    types = dict(target.dtypes)
    updated = marked.select(
        *[
            F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).cast(types[c]).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ],
        "_hit",
    )
    return Change(updated.drop("_hit"), updated.where("_hit").drop("_hit"))


def delete_using(target: DataFrame, doomed: DataFrame, key: str) -> Change:
    """Delete the rows whose key is in ``doomed``; rows without a key stay."""
    doomed = doomed.select(key)
    return Change(target.join(doomed, key, "left_anti"), target.join(doomed, key, "left_semi"))


def deleted_and_left(target: DataFrame, doomed: DataFrame, key: str, amount: str) -> DataFrame:
    """Rows and amount that ``delete_using`` takes and leaves, in one pass."""
    hit = target.join(doomed.select(key).distinct().withColumn("_gone", F.lit(True)), key, "left")
    gone = F.coalesce("_gone", F.lit(False))
    money = F.col(amount)
    sums = hit.agg(
        F.struct(F.count_if(gone), F.coalesce(F.sum(F.when(gone, money)), F.lit(0))).alias("deleted"),
        F.struct(F.count_if(~gone), F.coalesce(F.sum(F.when(~gone, money)), F.lit(0))).alias("left"),
    )
    return sums.unpivot([], ["deleted", "left"], "state", "_both").select(
        "state", F.col("_both")["col1"].alias("row_count"), F.col("_both")["col2"].alias(amount)
    )


def delete_where(target: DataFrame, predicate: Column) -> Change:
    """Delete the rows for which the predicate is true, not those where it is NULL."""
    hit = F.coalesce(predicate, F.lit(False))
    return Change(target.where(~hit), target.where(hit))


def delete_preview(children: dict[str, DataFrame], doomed: DataFrame, key: str) -> DataFrame:
    """How many rows of each table a delete by ``doomed`` would remove."""
    doomed = doomed.select(key)
    result = None
    for name, child in children.items():
        counted = child.join(doomed, key, "left_semi").agg(
            F.upper(F.lit(name)).alias("table_name"), F.count("*").alias("rows_to_delete")
        )
        result = counted if result is None else result.unionByName(counted)
    return result


def with_generated(df: DataFrame, generated: dict[str, Column]) -> DataFrame:
    """Columns computed from the row before it is written."""
    return df.withColumns(generated)


def assign_keys(
    new_rows: DataFrame,
    id_column: str,
    order: list[Column],
    existing: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Surrogate keys behind the greatest one in use, in a stated ascending order.

    ``unique`` says that no two rows are equal in that order.
    """
    last = 0 if existing is None else existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    return number_rows(new_rows, order, id_column, last, unique)


def add_column_backfilled(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Add the column if it is missing and fill its NULLs."""
    current = F.col(column) if column in df.columns else F.lit(None)
    return df.withColumn(column, F.coalesce(current, value))


# The columns a change log may touch, and their types.
CHANGEABLE = {
    "product_name": "text",
    "unit_price": "decimal(10,2)",
    "stock_quantity": "int",
    "product_display_name": "text",
    "created_at": "timestamp_ntz",
}


class ChangeLog(NamedTuple):
    table: DataFrame
    decided: DataFrame


def apply_change_log(
    target: DataFrame, changes: DataFrame, key: str = "product_id", seq: str = "change_seq"
) -> ChangeLog:
    """Apply changes ``(seq, key, column_name, new_value)`` in order.

    The column name is trimmed and lowered and must be changeable; text values
    are trimmed and lowered; other values must convert to the column's type; the
    key must exist. ``decided`` repeats each change with the reason it was
    rejected, or NULL. The last accepted change of a cell wins.
    """
    name = F.lower(F.trim("column_name"))
    typed = [column for column, kind in CHANGEABLE.items() if kind != "text"]
    converts = F.lit(True)
    for column in typed:
        valid = F.trim("new_value").try_cast(CHANGEABLE[column]).isNotNull()
        if CHANGEABLE[column] == "int":
            # A cast alone would cut the fraction off.
            valid = valid & F.trim("new_value").rlike("^[+-]?[0-9]+$")
        converts = F.when(name == column, F.col("new_value").isNull() | valid).otherwise(converts)
    known = target.select(F.col(key), F.lit(True).alias("_known"))
    decided = (
        changes.join(known, key, "left")
        .withColumn("column_name", name)
        .withColumn(
            "reason",
            F.when(
                F.col("column_name").isNull() | ~F.col("column_name").isin(list(CHANGEABLE)),
                F.lit("column not allowed"),
            )
            .when(~converts, F.lit("value does not convert"))
            .when(F.col("_known").isNull(), F.lit("product not found")),
        )
        .drop("_known")
    )
    accepted = decided.where(F.col("reason").isNull())
    present = [column for column in CHANGEABLE if column in target.columns]
    last = accepted.groupBy(key).agg(
        *[
            F.max(
                F.when(F.col("column_name") == column, F.struct(F.col(seq), F.col("new_value")))
            ).alias(f"_{column}")
            for column in present
        ]
    )

    def value(column: str) -> Column:
        if column not in present:
            return F.col(column)
        text = F.col(f"_{column}.new_value")
        kind = CHANGEABLE[column]
        new = F.lower(F.trim(text)) if kind == "text" else F.trim(text).try_cast(kind)
        return F.when(F.col(f"_{column}").isNotNull(), new).otherwise(F.col(column)).alias(column)

    table = target.join(last, key, "left").select(*[value(column) for column in target.columns])
    return ChangeLog(table, decided)


def validate_new_items(
    catalog: DataFrame,
    proposals: DataFrame,
    languages: DataFrame,
    as_of_year: int,
    seq: str = "seq",
    default_language: str = DEFAULT_LANGUAGE,
) -> DataFrame:
    """Decide on proposed titles ``(seq, title, release_year, language)``; proposals
    without a ``language`` column are in ``default_language``.

    Checked in order: blank title, year outside 1888 .. five years ahead,
    unknown language, title taken (trimmed, any case). A missing year becomes
    the current one. A title is taken by the catalog or by the first proposal
    that passes the other checks. ``reason`` is NULL for accepted rows.
    """
    stated = "language" in proposals.columns
    if not stated:
        proposals = proposals.withColumn("language", F.lit(default_language))
    titles = proposals.withColumn("_title", F.lower(F.trim("title")))
    # Of languages that share a name the first is meant.
    known = languages.groupBy(F.lower("name").alias("_language")).agg(
        F.min(F.struct("language_id", F.col("name").alias("_name"))).alias("_least")
    ).select("_language", "_least.*")
    taken = catalog.select(F.lower(F.trim("title")).alias("_title")).distinct()
    if stated:
        spoken = titles.withColumn("_language", F.lower(F.trim("language"))).join(known, "_language", "left")
    else:
        # One language for all rows is looked up once.
        wanted = known.where(F.col("_language") == default_language.strip().lower())
        least = wanted.agg(F.min(F.struct("language_id", "_name"))).scalar()
        spoken = titles.withColumns({"language_id": least["language_id"], "_name": least["_name"]})
    checked = (
        spoken.join(taken.withColumn("_taken", F.lit(True)), "_title", "left")
        .withColumn(
            "reason",
            F.when(F.col("_title").isNull() | (F.col("_title") == ""), F.lit("title is blank"))
            .when(
                (F.col("release_year") < 1888) | (F.col("release_year") > as_of_year + 5),
                F.lit("year is not valid"),
            )
            .when(F.col("language_id").isNull(), F.lit("language is unknown"))
            .when(F.col("_taken"), F.lit("title already exists")),
        )
    )
    first = (
        checked.where(F.col("reason").isNull())
        .groupBy("_title")
        .agg(F.min(seq).alias("_first"))
    )
    repeated = F.col("reason").isNull() & (F.col(seq) != F.col("_first"))
    return checked.join(first, "_title", "left").select(
        *[c for c in proposals.columns if c not in ("title", "release_year", "language")],
        F.trim("title").alias("title"),
        F.coalesce("release_year", F.lit(as_of_year)).alias("release_year"),
        F.coalesce("_name", "language").alias("language"),
        F.when(repeated, F.lit("title already exists")).otherwise(F.col("reason")).alias("reason"),
    )


def new_item_rows(
    decided: DataFrame, films: DataFrame, languages: DataFrame, stamp: Column, seq: str = "seq"
) -> DataFrame:
    """The film rows that the accepted proposals of ``validate_new_items`` become:
    ids behind the greatest one in the order of ``seq``, and fixed values elsewhere."""
    spoken = languages.groupBy(F.col("name").alias("language")).agg(F.min("language_id").alias("language_id"))
    accepted = decided.where(F.col("reason").isNull()).join(spoken, "language")
    numbered = assign_keys(accepted, "film_id", [F.col(seq)], films, unique=True)
    return numbered.select(
        "film_id", "title", F.lit(NEW_ITEM["description"]).alias("description"), "release_year",
        "language_id", F.lit(None).cast("int").alias("original_language_id"),
        F.lit(NEW_ITEM["rental_duration"]).alias("rental_duration"),
        F.lit(NEW_ITEM["rental_rate"]).cast("decimal(4,2)").alias("rental_rate"),
        F.lit(NEW_ITEM["length"]).alias("length"),
        F.lit(NEW_ITEM["replacement_cost"]).cast("decimal(5,2)").alias("replacement_cost"),
        F.lit(NEW_ITEM["rating"]).alias("rating"), stamp.alias("last_update"),
        F.array(*map(F.lit, NEW_ITEM["special_features"])).alias("special_features"),
    )
