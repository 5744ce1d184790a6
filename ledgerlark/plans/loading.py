"""The idempotent load: a customer's favourite films into the rental tables.

Twelve steps in the order of the foreign keys. Each step resolves its keys by
natural names, leaves out what is already there and keeps the rows it wrote.
New rows are written once as they are found, so that the next step and the
caller read the same ids; the tables themselves are not rewritten here.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.operators import merge
from ledgerlark.operators.joins import resolve
from ledgerlark.plans.rental_reports import qualifying_customers
from ledgerlark.session import materialise


class Load(NamedTuple):
    tables: dict[str, DataFrame]
    affected: dict[str, DataFrame]


def _insert(
    tables: dict[str, DataFrame],
    affected: dict[str, DataFrame],
    name: str,
    source: DataFrame,
    keys: list[str],
    ignore_case: list[str],
    defaults: dict,
    identity: tuple[str, list[str]] | None = None,
    used: DataFrame | None = None,
) -> None:
    """Insert what is absent; ``identity`` names the id column and its order.

    ``used`` holds the ids given out so far, where rows were deleted since.
    """
    target = tables[name]
    new = merge.insert_if_absent(target, source, keys, ignore_case, defaults).affected
    if identity:
        column, order = identity
        numbered = merge.assign_keys(
            new.drop(column),
            column,
            [F.col(key) for key in order],
            target if used is None else used,
        )
        types = dict(target.dtypes)
        new = numbered.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])
    new = materialise(new)
    affected[name] = new
    tables[name] = target.unionByName(new)


def _films(tables: dict[str, DataFrame], favourites: DataFrame) -> DataFrame:
    """Film ids of the favourites, by title in any case and release year."""
    films = tables["film"].select(
        "film_id", F.upper("title").alias("_title"), F.col("release_year").alias("_year")
    )
    return favourites.join(
        films, (F.upper("title") == F.col("_title")) & (F.col("release_year") == F.col("_year"))
    ).drop("_title", "_year")


def _owner(tables: dict[str, DataFrame], first_name: str, last_name: str) -> DataFrame:
    """The id of the customer of that name; the least one if there are several."""
    named = tables["customer"].where(
        (F.upper("first_name") == first_name.upper()) & (F.upper("last_name") == last_name.upper())
    )
    return named.agg(F.min("customer_id").alias("customer_id")).where("customer_id is not null")


def load_favourites(
    tables: dict[str, DataFrame],
    favourites: DataFrame,
    cast: DataFrame,
    owner: dict[str, str],
    store_id: int,
    least: tuple[int, int],
    as_of: date,
    language: str = "English",
) -> Load:
    """Run the load and return the new tables and the rows of each step.

    favourites: columns of film plus ``category_name, rental_date,
    return_date``; cast ``(title, release_year, first_name, last_name)``; owner
    maps ``first_name, last_name, email``. The first customer with at least
    ``least`` rentals and payments becomes the owner, unless the owner exists.
    """
    tables, affected = dict(tables), {}
    stamp: Column = F.lit(as_of)
    stamped = {"last_update": stamp}

    spoken = tables["language"].where(F.upper("name") == language.upper()).agg(F.min("language_id"))
    films = favourites.withColumns(
        {"title": F.upper("title"), "language_id": spoken.scalar()}
    ).where(F.col("language_id").isNotNull())
    _insert(tables, affected, "film", films, ["title", "release_year"], ["title"], stamped,
            ("film_id", ["title", "release_year"]))

    found = _films(tables, favourites)
    genres = resolve(found, tables["category"], {"category_name": "name"}, ["category_id"])
    _insert(tables, affected, "film_category", genres, ["film_id", "category_id"], [], stamped)

    people = cast.select(F.upper("first_name").alias("first_name"), F.upper("last_name").alias("last_name")).distinct()
    names = ["first_name", "last_name"]
    _insert(tables, affected, "actor", people, names, names, stamped, ("actor_id", names))

    roles = resolve(_films(tables, cast), tables["actor"], {n: n for n in names}, ["actor_id"])
    _insert(tables, affected, "film_actor", roles, ["actor_id", "film_id"], [], stamped)

    stocked = found.select("film_id", F.lit(store_id).alias("store_id"))
    _insert(tables, affected, "inventory", stocked, ["film_id", "store_id"], [], stamped,
            ("inventory_id", ["film_id"]))

    present = _owner(tables, owner["first_name"], owner["last_name"])
    qualified = qualifying_customers(
        tables["customer"], tables["rental"], tables["payment"], least, k=1
    ).select("customer_id")
    affected["qualified"] = qualified
    home = tables["address"].agg(F.min("address_id")).scalar()
    renamed = (
        qualified.where(present.agg(F.min("customer_id")).scalar().isNull())
        .withColumns({column: F.lit(value) for column, value in owner.items()} | {"address_id": home})
    )
    change = merge.update_from(
        tables["customer"], materialise(renamed), "customer_id", [*owner, "address_id"],
        stamp=("last_update", stamp),
    )
    # One customer at most, who is read again by each delete.
    first_run = materialise(change.affected)
    affected["customer"], tables["customer"] = first_run, change.table

    # Only the run that takes the customer over deletes the old history.
    doomed = first_run.select("customer_id")
    affected["preview"] = merge.delete_preview(
        {"payment": tables["payment"], "rental": tables["rental"]}, doomed, "customer_id"
    )
    used = {name: tables[name] for name in ("payment", "rental")}
    for name in used:
        removed = merge.delete_using(tables[name], doomed, "customer_id")
        affected[f"deleted_{name}"], tables[name] = removed.affected, removed.table

    me = _owner(tables, owner["first_name"], owner["last_name"])
    copies = tables["inventory"].where(F.col("store_id") == store_id)
    clerk = tables["store"].where(F.col("store_id") == store_id).select(
        "store_id", F.col("manager_staff_id").alias("staff_id")
    )
    rented = (
        _films(tables, favourites)
        .select("film_id", "rental_date", "return_date")
        .join(copies.select("film_id", "inventory_id", "store_id"), "film_id")
        .join(clerk, "store_id")
        .withColumn("customer_id", me.agg(F.min("customer_id")).scalar())
        .where(F.col("customer_id").isNotNull())
    )
    visit = ["customer_id", "inventory_id", "rental_date"]
    _insert(tables, affected, "rental", rented, visit, [], stamped,
            ("rental_id", ["rental_date", "inventory_id"]), used["rental"])

    paid = (
        tables["rental"]
        .join(F.broadcast(me), "customer_id", "left_semi")
        .join(copies.select("inventory_id", "film_id"), "inventory_id")
        .join(tables["film"].select("film_id", "title", "release_year", "rental_rate"), "film_id")
        .join(
            favourites.select(F.upper("title").alias("_title"), F.col("release_year").alias("_year"),
                              F.col("rental_date").alias("_date")),
            (F.upper("title") == F.col("_title"))
            & (F.col("release_year") == F.col("_year"))
            & (F.col("rental_date") == F.col("_date")),
        )
        .select(
            "rental_id",
            "customer_id",
            "staff_id",
            F.col("rental_rate").alias("amount"),
            (F.col("rental_date") + F.expr("INTERVAL '1' HOUR")).alias("payment_date"),
        )
    )
    _insert(tables, affected, "payment", paid, ["rental_id"], [], stamped,
            ("payment_id", ["rental_id"]), used["payment"])
    return Load(tables, affected)
