"""Parameterised table functions on the rental schema.

Guards raise ``ValueError`` before any job starts. Wherever the clock would be
read, ``as_of`` is a parameter.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import dates
from ledgerlark.functions.text import capitalised, joined
from ledgerlark.operators.joins import or_info_row
from ledgerlark.operators.ordering import best_rows, latest_rows, peer_numbers
from ledgerlark.operators.text_index import matching
from ledgerlark.session import materialise
from ledgerlark.sources.inline import clean_names

# Fixed value: the row shown when no film matches.
NOT_FOUND = "Movie not found or not currently in stock"


def revenue_by_category(
    payments: DataFrame, film_category: DataFrame, category: DataFrame, when: date | None
) -> DataFrame:
    """Revenue per category in the quarter of ``when``.

    ``payments`` holds ``(film_id, amount, payment_date)``. Payments are summed
    per film before they meet the categories.
    """
    if when is None:
        raise ValueError("a date is needed to find the quarter")
    start, end = dates.quarter_bounds(when)
    per_film = (
        payments.where(dates.half_open("payment_date", start, end))
        .groupBy("film_id")
        .agg(F.sum("amount").alias("_amount"))
    )
    return (
        per_film.join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", "name"), "category_id")
        .groupBy("name")
        .agg(F.sum("_amount").alias("_revenue"))
        .where(F.col("_revenue") > 0)
        .orderBy(F.desc("_revenue"), "name")
        .select(
            F.upper("name").alias("category_name"),
            F.round("_revenue", 2).alias("total_sales_revenue"),
        )
    )


def revenue_by_category_this_quarter(
    payments: DataFrame, film_category: DataFrame, category: DataFrame, as_of: date | None = None
) -> DataFrame:
    """The same for the current quarter, as a view would show it."""
    return revenue_by_category(payments, film_category, category, as_of or date.today())


def most_popular_by_country(
    rentals: DataFrame, customers: DataFrame, film: DataFrame, names: list[str | None] | None
) -> DataFrame:
    """Most rented film per listed country.

    ``rentals`` has one row per rental and payment: ``(rental_id, customer_id,
    film_id, amount)``; a rental paid twice counts twice, an unpaid one has a
    NULL amount. customers ``(customer_id, country)``; film ``(film_id, title,
    rating, language_name, length, release_year)``, whose copies with equal
    facts count as one. Ties go to revenue, then to the first title. Unknown
    countries show ``-``.
    """
    if not names:
        raise ValueError("the country list is empty")
    if not any(name is not None and name.strip(" ") for name in names):
        raise ValueError("all entries of the country list are blank")
    countries = clean_names(rentals.sparkSession, names)
    facts = ["title", "rating", "language_name", "length", "release_year"]
    living = (
        # The list of names is part of the plan, so its size is known.
        customers.select("customer_id", F.lower("country").alias("name"))
        .join(F.broadcast(countries), "name", "left_semi")
    )
    # Counted per country and film before the rows meet the films.
    per_film = (
        rentals.select("rental_id", "customer_id", "film_id", "amount")
        .join(living, "customer_id")
        .groupBy("name", "film_id")
        .agg(F.count("rental_id").alias("_n"), F.sum("amount").alias("_amount"))
    )
    statistics = (
        per_film.join(film.select("film_id", *facts), "film_id")
        .groupBy("name", *facts)
        .agg(
            F.sum("_n").alias("_rentals"),
            F.coalesce(F.sum("_amount"), F.lit(0)).alias("_revenue"),
        )
    )
    best = best_rows(
        statistics, ["name"], [F.desc("_rentals"), F.desc("_revenue"), F.upper("title").asc()]
    )

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("-"))

    return (
        countries.join(best, "name", "left")
        .orderBy("name")
        .select(
            capitalised("name").alias("country"),
            shown(F.col("title")).alias("film"),
            shown(F.upper("rating")).alias("rating"),
            shown(capitalised("language_name")).alias("language"),
            shown(F.col("length")).alias("length"),
            shown(F.col("release_year")).alias("release_year"),
        )
    )


def open_rentals(rental: DataFrame) -> DataFrame:
    """Copies out on rent and who holds them (the least id if several do)."""
    return (
        rental.where(F.col("return_date").isNull())
        .groupBy("inventory_id")
        .agg(F.min("customer_id").alias("held_by"))
    )


def stock_state(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Each copy with ``in_stock`` and the customer who holds it, if any."""
    out = open_rentals(rental).withColumn("_out", F.lit(True))
    return inventory.join(out, "inventory_id", "left").select(
        *inventory.columns, F.col("_out").isNull().alias("in_stock"), "held_by"
    )


def copies(
    inventory: DataFrame,
    rental: DataFrame,
    in_stock: bool = True,
    film_id: int | None = None,
    store_id: int | None = None,
) -> DataFrame:
    """Copies that are in stock, or out, of one film and store or of all."""
    wanted = inventory
    if film_id is not None:
        wanted = wanted.where(F.col("film_id") == film_id)
    if store_id is not None:
        wanted = wanted.where(F.col("store_id") == store_id)
    out = rental.where(F.col("return_date").isNull()).select("inventory_id")
    how = "left_anti" if in_stock else "left_semi"
    return wanted.join(out, "inventory_id", how).select("inventory_id")


def holder(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Customer who holds each copy; NULL for copies in stock."""
    return inventory.select("inventory_id").join(open_rentals(rental), "inventory_id", "left")


def films_in_stock(
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    customer: DataFrame,
    pattern: str | None = "%",
    returns: DataFrame | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Films in stock whose title matches, with their latest rentals.

    film ``(film_id, title, language_name)``. Rentals tied for latest give one
    row each, with a shared number. A film never rented shows a blank customer
    and ``-`` as date. No match gives one informational row.
    ``returns`` may give ``(inventory_id, film_id, return_date)`` of the rentals where that
    is cheaper to read than ``rental``, and ``index`` the pieces of all titles (see
    ``operators.text_index``). The titles are searched before this returns: all else is
    read for the films found alone, and not at all if there are none.
    """
    if pattern is None or not pattern.strip(" "):
        raise ValueError("the search pattern is blank")
    info = film.sparkSession.range(1).select(
        F.lit(1).cast("bigint").alias("row_num"),
        F.lit(NOT_FOUND).alias("film_title"),
        *[F.lit("-").alias(name) for name in ("language", "customer_name", "rental_date")],
    )
    titled = materialise(
        matching(film.select("film_id", "title", "language_name"), "film_id", "title", pattern, index)
    )
    if titled.isEmpty():
        return info
    wanted = titled.select("film_id")
    copies_of = inventory.select("inventory_id", "film_id").join(wanted, "film_id", "left_semi")
    returns = rental if returns is None else returns
    if "film_id" in returns.columns:
        returns = returns.join(wanted, "film_id", "left_semi")
    out = returns.where(F.col("return_date").isNull()).select("inventory_id")
    free = copies_of.join(out, "inventory_id", "left_anti")
    matched = materialise(titled.join(free.select("film_id"), "film_id", "left_semi"))
    # One row per film and customer before anything is compared.
    if "film_id" in rental.columns:
        known = rental.join(matched.select("film_id"), "film_id", "left_semi")
    else:
        known = rental.join(copies_of, "inventory_id").join(matched.select("film_id"), "film_id", "left_semi")
    rented = materialise(
        known.groupBy("film_id", "customer_id").agg(F.max("rental_date").alias("rental_date"))
    )
    last = latest_rows(rented, ["film_id"], "rental_date").join(
        customer.select("customer_id", "first_name", "last_name"), "customer_id", "left"
    )
    rows = materialise(
        matched.select("film_id", "title", "language_name")
        .join(last, "film_id", "left")
        .select(
            "film_id",
            "title",
            "language_name",
            joined("first_name", F.lit(" "), "last_name").alias("customer_name"),
            F.coalesce(dates.second_label("rental_date"), F.lit("-")).alias("rental_date"),
        )
        .distinct()
    )
    numbered = peer_numbers(rows, {"_title": F.upper("title"), "_film": F.col("film_id")}, "row_num")
    result = numbered.select(
        "row_num",
        F.col("title").alias("film_title"),
        capitalised("language_name").alias("language"),
        "customer_name",
        "rental_date",
    )
    return or_info_row(result, matched, info).orderBy("row_num")


def customer_balance(
    customer: DataFrame,
    rentals: DataFrame,
    payment: DataFrame,
    effective: date,
    fee_per_day: str = "1.00",
) -> DataFrame:
    """Fees plus overdue fees minus payments, of every customer, at a date.

    rentals ``(customer_id, rental_date, return_date, rental_rate,
    rental_duration)``. An open rental counts as kept until the date. Both sides
    are summed per customer before they meet the customers.
    """
    until = F.lit(date.fromordinal(effective.toordinal() + 1))
    kept = F.datediff(F.coalesce(F.col("return_date").cast("date"), F.lit(effective)), F.col("rental_date"))
    days_over = F.greatest(kept - F.col("rental_duration"), F.lit(0))
    fees = (
        rentals.where(F.col("rental_date") < until)
        .groupBy("customer_id")
        .agg(
            F.sum("rental_rate").alias("rental_fees"),
            F.sum(days_over).alias("_days"),
        )
    )
    paid = (
        payment.where(F.col("payment_date") < until)
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("payments"))
    )
    zero = F.lit(0).cast("decimal(18,2)")
    overdue = (F.coalesce("_days", F.lit(0)).cast("decimal(18,0)") * F.lit(fee_per_day).cast("decimal(9,2)"))
    balances = customer.select("customer_id").join(fees, "customer_id", "left")
    return balances.join(paid, "customer_id", "left").select(
        "customer_id",
        F.coalesce("rental_fees", zero).alias("rental_fees"),
        overdue.alias("overdue_fees"),
        F.coalesce("payments", zero).alias("payments"),
        (F.coalesce("rental_fees", zero) + overdue - F.coalesce("payments", zero)).alias("balance"),
    )


def rewards_report(
    payment: DataFrame,
    least_payments: int,
    least_amount: str,
    inclusive: bool = True,
) -> DataFrame:
    """Customers who reached both thresholds in the last month with payments."""
    if least_payments <= 0 or float(least_amount) <= 0:
        raise ValueError("both thresholds must be greater than zero")
    kind = dict(payment.dtypes)["payment_date"]
    month = payment.agg(F.trunc(F.max("payment_date"), "month").alias("start"))
    lower = month.select(F.col("start").cast(kind)).scalar()
    upper = month.select(F.date_add(dates.month_end("start"), 1).cast(kind)).scalar()
    sums = (
        payment.where((F.col("payment_date") >= lower) & (F.col("payment_date") < upper))
        .groupBy("customer_id")
        .agg(F.count("*").alias("payment_count"), F.sum("amount").alias("amount_spent"))
    )
    amount = F.lit(least_amount).cast("decimal(18,2)")
    count = F.col("payment_count")
    if inclusive:
        reached = (count >= least_payments) & (F.col("amount_spent") >= amount)
    else:
        reached = (count > least_payments) & (F.col("amount_spent") > amount)
    return sums.where(reached)


def text_lists(
    df: DataFrame, keys: list[str], value: str, name: str, separator: str = ",", distinct: bool = False
) -> DataFrame:
    """The values of each key as one ordered text, every one of them unless
    ``distinct``; NULL values are left out.

    A text of all values of a key is one row by nature. Equal values are counted
    before they are gathered, so a key brings as many of them as differ.
    """
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    times = F.lit(1) if distinct else F.col("_n")
    text = F.array_join(F.array_repeat(F.col(value).cast("string"), times.cast("int")), separator)
    repeated = counted.withColumn("_all", F.when(F.col(value).isNotNull(), text))
    return repeated.groupBy(*keys).agg(
        F.expr(f"listagg(_all, '{separator}') WITHIN GROUP (ORDER BY {value})").alias(name)
    )
