"""Reports on the rental schema.

Tables carry the usual names: film, category, film_category, actor, film_actor,
inventory, rental, payment, store, address, staff, customer. ``payment_facts``
builds the payment rows that several reports share.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import dates
from ledgerlark.functions.text import mapped, merged, one_of, same_text
from ledgerlark.operators.frames import widest_gap
from ledgerlark.operators.joins import with_child_counts
from ledgerlark.operators.pivot import count_columns, counts_on_spine

# Audience labels per rating.
AUDIENCES = {
    "G": "All ages",
    "PG": "Parental guidance suggested",
    "PG-13": "13+",
    "R": "17+",
    "NC-17": "18+",
}
UNKNOWN_AUDIENCE = "Unknown"


def payment_facts(
    payment: DataFrame, rental: DataFrame, inventory: DataFrame, how: str = "inner"
) -> DataFrame:
    """Payments with the film and store of the rental they pay for.

    ``how="left"`` keeps payments without a rental; their store is NULL.
    """
    copies = rental.select("rental_id", "inventory_id").join(
        inventory.select("inventory_id", "film_id", "store_id"), "inventory_id"
    )
    return payment.join(copies, "rental_id", how)


def store_addresses(store: DataFrame, address: DataFrame) -> DataFrame:
    """Store id and its address, both address lines as one text."""
    return store.join(address, "address_id").select(
        "store_id", merged("address", "address2").alias("store_address")
    )


def _in_category(film_category: DataFrame, category: DataFrame, name: str) -> DataFrame:
    return film_category.join(category.where(same_text("name", name)), "category_id").select("film_id")


def _released(film: DataFrame, first_year: int, last_year: int, min_rate: float) -> DataFrame:
    return film.where(
        F.col("release_year").between(first_year, last_year) & (F.col("rental_rate") > min_rate)
    ).select("film_id", "title", "release_year", "rental_rate")


def titles_in_category(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    name: str,
    first_year: int,
    last_year: int,
    min_rate: float,
    form: str = "join",
) -> DataFrame:
    """Titles of one category, by inner join or by semi join (``form="in"``)."""
    films = _released(film, first_year, last_year, min_rate)
    wanted = _in_category(film_category, category, name)
    how = "inner" if form == "join" else "left_semi"
    return (
        films.join(wanted, "film_id", how)
        .select("title", "release_year", "rental_rate")
        .orderBy("title")
    )


def _since(payments: DataFrame, since: date) -> DataFrame:
    return payments.where(F.col("payment_date") >= F.lit(since))


def _store_revenue(payments: DataFrame, since: date) -> DataFrame:
    return _since(payments, since).groupBy("store_id").agg(F.sum("amount").alias("revenue"))


def revenue_by_address(payments: DataFrame, addresses: DataFrame, since: date) -> DataFrame:
    """Revenue per store address; stores that share an address share a row.

    Payments are summed per store before the join, then per address.
    """
    return (
        _store_revenue(payments, since)
        .join(addresses, "store_id")
        .groupBy("store_address")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "store_address")
    )


def revenue_by_store(payments: DataFrame, addresses: DataFrame, since: date) -> DataFrame:
    """Revenue per store, shown with its address."""
    return (
        _store_revenue(payments, since)
        .join(addresses, "store_id")
        .select("store_id", "store_address", "revenue")
        .orderBy(F.desc("revenue"), "store_address", "store_id")
    )


def top_actors(
    actor: DataFrame, film_actor: DataFrame, film: DataFrame, since_year: int, k: int = 5
) -> DataFrame:
    """Actors with the most films released since a year."""
    recent = film.where(F.col("release_year") >= since_year).select("film_id")
    counts = (
        film_actor.join(recent, "film_id")
        .groupBy("actor_id")
        .agg(F.count("*").alias("number_of_movies"))
    )
    return (
        counts.join(actor, "actor_id")
        .orderBy(F.desc("number_of_movies"), "last_name", "first_name", "actor_id")
        .limit(k)
        .select("first_name", "last_name", "number_of_movies")
    )


def genre_counts(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    names: dict[str, str],
    form: str = "case",
) -> DataFrame:
    """Films per release year in each of the named categories.

    ``names`` maps categories to column names. ``form="case"`` counts in one
    pass; ``form="spine"`` left-joins one count per category to the years.
    """
    wanted = category.where(one_of("name", list(names)))
    films = (
        film.select("film_id", "release_year")
        .join(film_category.select("film_id", "category_id"), "film_id")
        .join(wanted.select("category_id", "name"), "category_id")
    )
    if form == "spine":
        result = counts_on_spine(films, "release_year", "name", names)
    else:
        result = films.groupBy("release_year").agg(*count_columns("name", names))
    return result.orderBy(F.desc("release_year"))


def top_staff(
    staff: DataFrame,
    payments: DataFrame,
    addresses: DataFrame,
    year: int,
    k: int = 3,
    store_payments_only: bool = False,
) -> DataFrame:
    """Staff with the most revenue in a year, with the store of the last payment.

    ``payments`` holds all payments, with NULL stores where no rental is known.
    By default those count towards revenue; ``store_payments_only`` leaves them
    out. Store and address of tied last payments are the least of each, taken
    independently. One aggregate per moment, then one per person: no self-join
    for "no later payment", and no window over a busy person's payments.
    """
    rows = payments.where(dates.in_years("payment_date", year, year))
    if store_payments_only:
        rows = rows.where(F.col("store_id").isNotNull())
    per_moment = rows.join(addresses, "store_id", "left").groupBy("staff_id", "payment_date").agg(
        F.sum("amount").alias("amount"),
        F.min(F.when(F.col("store_address").isNotNull(), F.col("store_id"))).alias("store_id"),
        F.min("store_address").alias("store_address"),
    )
    summary = per_moment.groupBy("staff_id").agg(
        F.sum("amount").alias("revenue"),
        F.max(F.struct("payment_date", "store_id", "store_address")).alias("last"),
    )
    return (
        summary.where(F.col("last.store_id").isNotNull())
        .join(staff, "staff_id")
        .orderBy(F.desc("revenue"), "last_name", "first_name", "staff_id")
        .limit(k)
        .select(
            "first_name",
            "last_name",
            "revenue",
            F.col("last.store_id").alias("last_store_id"),
            F.col("last.store_address").alias("last_store_address"),
        )
    )


def top_rented(
    film: DataFrame,
    inventory: DataFrame | None,
    rental: DataFrame,
    k: int = 5,
    audiences: dict[str, str] | None = None,
    default: str = UNKNOWN_AUDIENCE,
) -> DataFrame:
    """Most rented films and the audience their rating stands for.

    Rentals are counted per copy before they meet the copies. Rentals that name
    their film need no ``inventory``.
    """
    if inventory is None:
        per_film = rental.groupBy("film_id").agg(F.count("*").alias("number_of_rentals"))
    else:
        per_copy = rental.groupBy("inventory_id").agg(F.count("*").alias("_rentals"))
        per_film = (
            per_copy.join(inventory.select("inventory_id", "film_id"), "inventory_id")
            .groupBy("film_id")
            .agg(F.sum("_rentals").alias("number_of_rentals"))
        )
    return (
        per_film.join(film.select("film_id", "title", "rating"), "film_id")
        .orderBy(F.desc("number_of_rentals"), "title", "film_id")
        .limit(k)
        .select(
            "title",
            "number_of_rentals",
            mapped("rating", audiences or AUDIENCES, default).alias("expected_age"),
        )
    )


def appearances(film_actor: DataFrame, film: DataFrame) -> DataFrame:
    return film_actor.select("actor_id", "film_id").join(
        film.select("film_id", "release_year"), "film_id"
    )


def inactivity(actor: DataFrame, appeared: DataFrame, as_of: Column) -> DataFrame:
    """Years between the latest film of each actor and the year of ``as_of``.

    ``appeared`` holds ``(actor_id, release_year)``.
    """
    latest = appeared.groupBy("actor_id").agg(F.max("release_year").alias("latest_release_year"))
    return (
        latest.join(actor, "actor_id")
        .select(
            "first_name",
            "last_name",
            "latest_release_year",
            (F.year(as_of) - F.col("latest_release_year")).alias("inactivity_years"),
        )
        .orderBy(F.desc("inactivity_years"), "last_name", "first_name")
    )


def longest_gap(
    actor: DataFrame, appeared: DataFrame, at: str = "release_year", name: str = "max_gap_years"
) -> DataFrame:
    """Largest gap between consecutive ``at`` values of each actor."""
    return (
        widest_gap(appeared, ["actor_id"], at, name)
        .join(actor, "actor_id")
        .select("first_name", "last_name", name)
        .orderBy(F.desc(name), "last_name", "first_name")
    )


def qualifying_customers(
    customer: DataFrame,
    rental: DataFrame,
    payment: DataFrame,
    least: tuple[int, int],
    k: int | None = 5,
) -> DataFrame:
    """Customers with at least so many rentals and payments, lowest ids first."""
    least_rentals, least_payments = least
    counted = with_child_counts(
        customer,
        "customer_id",
        {"rental_count": rental, "payment_count": payment},
        how="inner" if min(least) > 0 else "left",
    )
    found = counted.where(
        (F.col("rental_count") >= least_rentals) & (F.col("payment_count") >= least_payments)
    ).orderBy("customer_id")
    return found if k is None else found.limit(k)
