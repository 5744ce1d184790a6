"""All registered queries: the plans bound to the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions import dates, formats
from ledgerlark.functions.text import capitalised, joined, mapped, matches, merged, one_of
from ledgerlark.operators import joins, merge, parts, policy, posting, quality, references, text_index
from ledgerlark.operators.ordering import peer_numbers
from ledgerlark.plans import rental_reports, sales_reports, table_functions
from ledgerlark.plans.loading import load_favourites
from ledgerlark.session import alone, configure, materialise, shared_dir, sparing, written_once
from ledgerlark.sources import bindings as b
from ledgerlark.sources import inline, tables
from ledgerlark.sources.tables import load, money

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Money as double and dates as text, so that results of different engines
    can be compared value by value."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, base: str) -> DataFrame:
        return plain(function(configure(spark), base))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return run


# Reports on the rental schema


@query
def filter_join_sort(spark, base):
    return rental_reports.titles_in_category(
        b.film(spark, base), b.film_category(spark, base), b.category(spark, base),
        "Promo", 1990, 2010, 910,
    )


@query
def in_subquery(spark, base):
    return rental_reports.titles_in_category(
        b.film(spark, base), b.film_category(spark, base), b.category(spark, base),
        "promo", 1990, 2010, 910, form="in",
    )


SINCE = date(1997, 4, 1)


def _addresses(spark, base):
    return rental_reports.store_addresses(b.store(spark, base), b.address(spark, base))


@query
def join_address(spark, base):
    return rental_reports.revenue_by_address(
        b.line_payments(spark, base), _addresses(spark, base), SINCE
    )


@query
def revenue_by_store(spark, base):
    return rental_reports.revenue_by_store(
        b.line_payments(spark, base), _addresses(spark, base), SINCE
    )


@query
def topn_count(spark, base):
    return rental_reports.top_actors(
        b.actor(spark, base), b.film_actor(spark, base), b.film(spark, base), 2015
    )


GENRES = {
    "economy": "number_of_economy",
    "Promo": "number_of_promo",
    "STANDARD": "number_of_standard",
}


@query
def genre_pivot_case(spark, base):
    return rental_reports.genre_counts(
        b.film(spark, base), b.film_category(spark, base), b.category(spark, base), GENRES
    )


@query
def genre_pivot_leftjoins(spark, base):
    return rental_reports.genre_counts(
        b.film(spark, base), b.film_category(spark, base), b.category(spark, base), GENRES, "spine"
    )


@query
def last_activity(spark, base):
    return rental_reports.top_staff(
        b.staff(spark, base), b.clerk_payments(spark, base), b.region_addresses(spark, base), 1997
    )


@query
def last_activity_in_stores(spark, base):
    return rental_reports.top_staff(
        b.staff(spark, base), b.clerk_payments(spark, base), b.region_addresses(spark, base), 1997,
        store_payments_only=True,
    )


# Labels of the brands that stand for ratings here.
BRAND_AUDIENCES = {"Brand#1": "All ages", "Brand#2": "13+", "Brand#3": "17+", "Brand#4": "18+"}


@query
def top_rented_mapped(spark, base):
    return rental_reports.top_rented(
        b.film(spark, base), None, b.copy_rentals(spark, base), audiences=BRAND_AUDIENCES,
    )


@query
def inactivity_years(spark, base):
    return rental_reports.inactivity(
        b.actor(spark, base),
        rental_reports.appearances(b.film_actor(spark, base), b.film(spark, base)),
        F.lit(date(2026, 12, 31)),
    )


@query
def max_gap_years(spark, base):
    """Gaps between release years of the films of each supplier."""
    return rental_reports.longest_gap(
        b.actor(spark, base),
        rental_reports.appearances(b.film_actor(spark, base), b.film(spark, base)),
    )


@query
def max_gap_days(spark, base):
    """Gaps between ship dates of each supplier, in days."""
    shipped = load(spark, base, "lineitem").select(
        F.col("l_suppkey").alias("actor_id"), F.unix_date(dates.day("l_shipdate")).alias("day")
    )
    return rental_reports.longest_gap(b.actor(spark, base), shipped, "day", "max_gap_days")


# Least numbers of rentals (lines) and payments (orders).
LEAST = (43, 18)


def _qualifying(spark, base, k):
    return rental_reports.qualifying_customers(
        b.customer(spark, base), b.rental_counts(spark, base), b.payment(spark, base), LEAST, k
    )


@query
def two_child_threshold(spark, base):
    return _qualifying(spark, base, None).select(
        "customer_id",
        F.upper("first_name").alias("first_name"),
        F.upper("last_name").alias("last_name"),
        "rental_count",
        "payment_count",
    )


# Reports on the sales star


@query
def share_lag(spark, base):
    return sales_reports.channel_share(
        b.sales(spark, base), b.customers(spark, base), b.countries(spark, base),
        ["America", "ASIA", "europe"], 1999, 2001,
    )


@query
def top5_share(spark, base):
    return sales_reports.top_customers_by_channel(b.sales(spark, base), b.customers(spark, base))


@query
def top300_all_years(spark, base):
    return sales_reports.top_in_all_years(
        b.sales(spark, base), b.customers(spark, base), [1998, 1999, 2001]
    )


@query
def top300_join_form(spark, base):
    return sales_reports.top_in_all_years_by_join(
        b.sales(spark, base), b.customers(spark, base), [1998, 1999, 2001]
    )


def _buyers(spark, base, regions):
    return sales_reports.regional_customers(b.customers(spark, base), b.countries(spark, base), regions)


@query
def crosstab_quarters(spark, base):
    buyers = _buyers(spark, base, ["Asia"])
    return sales_reports.quarter_crosstab(
        b.line_sales(spark, base, buyers), b.products(spark, base), b.customers(spark, base),
        b.countries(spark, base), "promo", "Asia", 2000,
    )


@query
def region_columns(spark, base):
    buyers = _buyers(spark, base, ["america", "europe"])
    return sales_reports.month_by_category(
        b.line_sales(spark, base, buyers), b.products(spark, base), b.customers(spark, base),
        b.countries(spark, base), {"america": "america_sales", "europe": "europe_sales"},
        date(2000, 1, 1), date(2000, 3, 31),
    )


def _weeks(spark, base):
    return sales_reports.weekly_progress(
        b.sales(spark, base), date(1999, 12, 6), date(1999, 12, 26), [49, 50, 51]
    )


@query
def weekly_cumsum(spark, base):
    return _weeks(spark, base).drop("centered_3_day_avg")


@query
def centered_avg(spark, base):
    return _weeks(spark, base).drop("cum_sum")


def _days(spark, base):
    return sales_reports.daily_sales(
        b.event_sales(spark, base), date(2024, 1, 1), date(2024, 12, 31)
    )


@query
def rows_frame(spark, base):
    return sales_reports.three_row_sum(_days(spark, base))


@query
def range_frame(spark, base):
    return sales_reports.neighbour_day_average(_days(spark, base))


@query
def groups_frame(spark, base):
    return sales_reports.year_group_sum(b.sales(spark, base), 1999, 2001)


#: Order in which no two lines tie that differ in anything read here.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "amount"]


def _ordered_lines(spark, base):
    return load(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", money("l_extendedprice").alias("amount"),
        dates.day("l_shipdate").alias("day"), "l_returnflag",
        F.when(F.col("l_discount") > 0, money("l_extendedprice")).alias("reduced"),
    )


@query
def rows_frame_of_lines(spark, base):
    """Each line with the sum over itself and the two lines before it."""
    lines = _ordered_lines(spark, base).select(*LINE_ORDER)
    return parts.rows_frame(lines, LINE_ORDER, 2, 0, {"three_line_sum": F.sum("amount")})


@query
def range_frame_of_lines(spark, base):
    """Each line with the sum and number of all lines shipped a day before or after it, or with it."""
    lines = _ordered_lines(spark, base).select(*LINE_ORDER, "day")
    sums = {"neighbour_days_sum": F.col("amount"), "neighbour_days_lines": F.lit(1)}
    return parts.range_frame(lines, "day", "INTERVAL 1 DAY", "INTERVAL 1 DAY", sums)


@query
def groups_frame_of_lines(spark, base):
    """Each line with the sum over its ship date and the ship date before that has lines."""
    lines = _ordered_lines(spark, base).select(*LINE_ORDER, "day")
    return parts.groups_frame(lines, "day", 1, 0, {"two_dates_sum": F.col("amount")})


@query
def last_reduced_price(spark, base):
    """Each line with the last price at a discount before it under its flag, which a third of all lines share."""
    lines = _ordered_lines(spark, base).select(*LINE_ORDER, "l_returnflag", "reduced")
    found = parts.last_before(lines, ["l_returnflag"], LINE_ORDER, "reduced", "last_reduced")
    return found.select(*LINE_ORDER, "l_returnflag", "last_reduced")


@query
def top5000_lines(spark, base):
    """The 5,000 dearest lines of each flag."""
    lines = _ordered_lines(spark, base).select(*LINE_ORDER, "l_returnflag")
    order = [parts.By("amount", False), *map(parts.By, LINE_ORDER[:-1])]
    return parts.top_n(lines, ["l_returnflag"], order, 5000)


@query
def latest_quarter(spark, base):
    return sales_reports.latest_quarter_sales(
        b.transactions(spark, base), b.transaction_items(spark, base), b.store_products(spark, base)
    )


# Sources, predicates and joins


@query
def values_lookup(spark, base):
    """Literal rows resolved by name to keys, with dates assigned by CASE."""
    schema = "region_name string, segment string"
    literal = inline.values(
        spark,
        [("america", " Household "), ("Asia", "MACHINERY"), ("EUROPE", "furniture"),
         ("Middle East", "Household"), ("Atlantis", "Building")],
        schema,
    ).unionByName(inline.values(spark, [("africa", "automobile")], schema))
    resolved = joins.resolve(
        literal, load(spark, base, "region"), {"region_name": "r_name"}, ["r_regionkey", "r_name"]
    )
    # A constant key picks one row, which every literal row is combined with.
    home = load(spark, base, "nation").where(F.col("n_name") == "NATION_0")
    resolved = resolved.withColumn("home_nation", home.agg(F.min("n_nationkey")).scalar())
    nation = load(spark, base, "nation").select("n_nationkey", "n_regionkey")
    targets = resolved.join(nation, F.col("r_regionkey") == F.col("n_regionkey")).select(
        "n_nationkey", "r_name", "segment", "home_nation"
    )
    customer = load(spark, base, "customer").select("c_nationkey", "c_mktsegment", "c_acctbal")
    found = customer.join(
        targets,
        (customer["c_nationkey"] == targets["n_nationkey"])
        & (F.lower(customer["c_mktsegment"]) == joins.natural(targets["segment"])),
    )
    started = mapped("r_name", {"AMERICA": "2017-01-10", "ASIA": "2017-02-11", "EUROPE": "2017-03-12"})
    return (
        found.groupBy("r_name", "c_mktsegment", "home_nation")
        .agg(F.count("*").alias("customers"), F.sum(money("c_acctbal")).alias("balance"))
        .select("r_name", "c_mktsegment", "home_nation", "customers", "balance",
                started.cast("date").alias("start_date"))
    )


@query
def unnest_distinct(spark, base):
    names = inline.clean_names(spark, [" Asia", "ASIA ", "europe", "", "   ", None, "Atlantis", "Africa"])
    countries = b.countries(spark, base).withColumn("name", F.lower("country_region"))
    customers = load(spark, base, "customer").groupBy("c_nationkey").agg(F.count("*").alias("_n"))
    per_region = (
        countries.join(customers, F.col("country_id") == F.col("c_nationkey"))
        .groupBy("name")
        .agg(F.sum("_n").alias("customers"))
    )
    return names.join(per_region, "name", "left").select(
        "name", F.coalesce("customers", F.lit(0)).alias("customers")
    )


@query
def series_delete_third(spark, base):
    """Text rows made from a series per order, of which a third is deleted."""
    prefix = "veeeeeeery_long_string"  # fixed value
    made = (
        load(spark, base, "orders")
        .select(F.explode(F.sequence(F.col("o_orderkey") * 2 + 1, F.col("o_orderkey") * 2 + 2)).alias("n"))
        .select(inline.numbered_text(prefix, F.col("n")).alias("col"))
    )
    return merge.delete_where(made, inline.suffix_number(F.col("col"), prefix) % 3 == 0).table


@query
def or_groups(spark, base):
    part = load(spark, base, "part").select("p_partkey", "p_name", "p_size")
    lines = load(spark, base, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    chosen = part.where(
        ((F.upper("p_name") == "RED PLATE") & (F.col("p_size") <= 20))
        | ((F.upper("p_name") == "SMALL WIDGET") & (F.col("p_size") > 30))
        | ((F.upper("p_name") == "HOT RING") & (F.col("p_size") < 45))
    )
    return (
        lines.where(dates.half_open("l_shipdate", date(1997, 1, 1), date(1999, 7, 1)))
        .join(chosen, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_name", "p_size")
        .agg(F.count("*").alias("lines"), F.sum(money("l_extendedprice")).alias("amount"))
    )


@query
def anti_orders(spark, base):
    orders = load(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = load(spark, base, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(lines, "o_orderkey", "left_anti")


@query
def null_safe_latest(spark, base):
    """Lines at the latest return date of their order; NULL where all are open."""
    lines = load(spark, base, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("returned")
    )
    # A NULL date is the least, so it is kept only where there is no other.
    per_date = lines.groupBy("l_orderkey", "returned").agg(F.count("*").alias("lines"))
    latest = per_date.groupBy("l_orderkey").agg(F.max(F.struct("returned", "lines")).alias("_last"))
    return latest.select("l_orderkey", "_last.*").select(
        "l_orderkey",
        "lines",
        F.coalesce(dates.second_label("returned"), F.lit("-")).alias("returned"),
        joined(F.lit("order "), F.col("l_orderkey"), F.lit(" "), dates.month_label("returned")).alias("label"),
    )


@query
def peer_numbering(spark, base):
    part = load(spark, base, "part").select("p_partkey", "p_name")
    return peer_numbers(part, {"_name": F.upper("p_name")}, "row_num")


@query
def string_agg_ordered(spark, base):
    part = load(spark, base, "part").select("p_type", "p_brand")
    return table_functions.text_lists(part, ["p_type"], "p_brand", "brands")


@query
def string_agg_distinct(spark, base):
    part = load(spark, base, "part").select("p_type", "p_brand")
    return table_functions.text_lists(part, ["p_type"], "p_brand", "brands", distinct=True)


# Table functions


def _category_revenue(spark, base, when):
    return table_functions.revenue_by_category(
        b.line_payments(spark, base), b.film_category(spark, base), b.category(spark, base), when
    )


@query
def quarter_by_date(spark, base):
    return _category_revenue(spark, base, date(2000, 2, 15))


@query
def quarter_as_of(spark, base):
    """The same as the view of the current quarter, on a stated day."""
    return table_functions.revenue_by_category_this_quarter(
        b.line_payments(spark, base), b.film_category(spark, base), b.category(spark, base),
        as_of=date(2001, 5, 5),
    )


@query
def best_per_group_tiebreak(spark, base):
    customers = b.customer(spark, base).join(b.countries(spark, base), "country_id")
    names = [f" nation_{i}" for i in range(25)] + ["Atlantis", "", "NATION_3 "]
    return table_functions.most_popular_by_country(
        b.rental(spark, base, customers.where(one_of("country", [name.strip() for name in names]))), customers, b.film(spark, base), names
    )


def _matching(spark, base, pattern):
    return table_functions.films_in_stock(
        b.film(spark, base),
        b.inventory(spark, base),
        b.rental(spark, base).select("inventory_id", "film_id", "customer_id", "rental_date"),
        b.customer(spark, base),
        pattern,
        returns=b.copy_rentals(spark, base),
        index=_title_index(spark, base),
    )


def _title_index(spark, base):
    """The pieces of all titles, written once for all searches."""
    return written_once(
        spark, "title pieces", [f"{base}/part.parquet"],
        lambda: materialise(text_index.gram_rows(b.film(spark, base), "film_id", "title")),
    )


@query
def like_in_stock(spark, base):
    return _matching(spark, base, "%RING%")


@query
def like_not_found(spark, base):
    return _matching(spark, base, "%zzzzzzzznomatch%")


@query
def in_stock(spark, base):
    return table_functions.stock_state(b.inventory(spark, base), b.rental(spark, base))


@query
def not_in_stock(spark, base):
    return table_functions.copies(
        b.inventory(spark, base), b.copy_rentals(spark, base), in_stock=False
    )


@query
def customer_balance(spark, base):
    terms = b.film(spark, base).select("film_id", "rental_rate", "rental_duration")
    rentals = b.rental(spark, base).select("film_id", "customer_id", "rental_date", "return_date")
    return table_functions.customer_balance(
        b.customer(spark, base),
        rentals.join(terms, "film_id"),
        b.payment(spark, base),
        date(2001, 6, 30),
        "1.50",
    )


@query
def rewards_report(spark, base):
    # Order dates end on the first of a month; the report is on that month.
    return table_functions.rewards_report(b.payment(spark, base), 1, "100000")


# Changes


def _pairs(spark, base, status):
    lines = load(spark, base, "lineitem").where(F.col("l_linestatus") == status)
    return lines.select("l_partkey", "l_suppkey").distinct()


@query
def insert_if_absent(spark, base):
    """Add to the old catalogue every name and brand it lacks, in any case."""
    part = load(spark, base, "part")
    catalogue = (
        part.where(F.col("p_size") <= 10)
        .select("p_name", "p_brand", F.lit("old").alias("origin"), F.col("p_size").alias("p_size"))
        .distinct()
    )
    source = part.select(F.upper("p_name").alias("p_name"), "p_brand").distinct()
    label = part.agg(F.max("p_size")).scalar()
    change = merge.insert_if_absent(
        catalogue, source.withColumn("p_size", label), ["p_name", "p_brand"], ["p_name"], {"origin": "new"}
    )
    return change.table


@query
def insert_explicit_null(spark, base):
    """A NULL that the source states stays; only a column it lacks takes its default."""
    part = load(spark, base, "part").select("p_partkey", "p_brand", "p_type")
    target = part.where(F.col("p_type") == "PROMO").select(
        "p_partkey", F.col("p_brand").alias("brand"), F.lit("old").alias("origin")
    )
    source = part.select(
        "p_partkey", F.when(F.col("p_brand") != "Brand#13", F.col("p_brand")).alias("brand")
    )
    return merge.insert_if_absent(
        target, source, ["p_partkey"], defaults={"brand": "none", "origin": "new"}
    ).table


@query
def update_from_repeated(spark, base):
    """Many changes for one customer change its row once, to the least of them."""
    changes = load(spark, base, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("last_name")
    )
    return merge.update_from(b.customer(spark, base), changes, "customer_id", ["last_name"]).table


def _line_batch(spark, base, status):
    return load(spark, base, "lineitem").where(F.col("l_linestatus") == status).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", money("l_extendedprice").alias("price")
    )


@query
def on_conflict_nothing(spark, base):
    """Open lines inserted behind the closed ones; number pairs occur twice."""
    change = merge.insert_on_conflict_nothing(
        _line_batch(spark, base, "F"),
        _line_batch(spark, base, "O"),
        ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "price"],
    )
    return change.affected


@query
def update_from(spark, base):
    """The first qualifying customer is renamed and moved to the first nation."""
    who = _qualifying(spark, base, 1).select("customer_id")
    where = load(spark, base, "nation").agg(F.min("n_nationkey")).scalar()
    changes = who.select(
        "customer_id",
        F.upper(F.lit("new")).alias("first_name"),
        F.upper(F.lit("owner")).alias("last_name"),
        where.alias("country_id"),
    )
    table = b.customer(spark, base).withColumn("last_update", F.lit(None).cast("date"))
    return merge.update_from(
        table,
        changes,
        "customer_id",
        ["first_name", "last_name", "country_id"],
        stamp=("last_update", F.lit(date(2026, 1, 1))),
    ).table


@query
def update_latest_row(spark, base):
    orders = load(spark, base, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return merge.update_latest_row(
        orders, "o_orderkey", {"o_orderstatus": F.lit("X"), "o_orderpriority": F.lit("0-NONE")}
    ).table


def _me(spark, base):
    found = load(spark, base, "customer").where(F.upper("c_name") == "CUSTOMER#000000007")
    return found.agg(F.min("c_custkey").alias("customer_id"))


@query
def delete_preview(spark, base):
    return merge.delete_preview(
        {"payment": b.payment(spark, base), "rental": b.rental(spark, base)},
        _me(spark, base),
        "customer_id",
    )


@query
def delete_using(spark, base):
    """Lines of one customer's orders deleted first, then the orders."""
    orders = load(spark, base, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), money("o_totalprice").alias("amount")
    )
    lines = load(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), money("l_extendedprice").alias("amount")
    )
    gone = orders.where(F.col("customer_id") == _me(spark, base).scalar()).select("o_orderkey", "customer_id")
    parts = {
        "lines": merge.deleted_and_left(lines, gone, "o_orderkey", "amount"),
        "orders": merge.deleted_and_left(orders, gone.select("customer_id"), "customer_id", "amount"),
    }
    lines_part, orders_part = (df.select(F.lit(name).alias("table_name"), "*") for name, df in parts.items())
    return lines_part.unionByName(orders_part)


@query
def delete_returning(spark, base):
    """The deleted orders themselves."""
    orders = load(spark, base, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderstatus", "o_orderdate"
    )
    return merge.delete_using(orders, _me(spark, base), "customer_id").affected


@query
def generated_columns(spark, base):
    lines = load(spark, base, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
    )
    return merge.with_generated(
        lines,
        {
            "line_total": (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)"),
            "display_name": F.concat_ws(
                " - ", F.concat_ws(" ", F.lit("order"), "l_orderkey"), F.col("l_linenumber").cast("string")
            ),
        },
    )


@query
def surrogate_keys(spark, base):
    """Pairs known from open lines only get ids behind the greatest order key."""
    known = _pairs(spark, base, "F")
    new = _pairs(spark, base, "O").join(known, ["l_partkey", "l_suppkey"], "left_anti")
    existing = load(spark, base, "orders").select(F.col("o_orderkey").alias("copy_id"))
    return merge.assign_keys(new, "copy_id", [F.col("l_partkey"), F.col("l_suppkey")], existing, unique=True)


def _change_log(spark, base):
    products = b.store_products(spark, base).select(
        "product_id",
        "product_name",
        "unit_price",
        "stock_quantity",
        F.concat_ws(" ", "brand_name", "product_name").alias("product_display_name"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    name = (
        F.when(priority == "1-URGENT", F.lit(" Product_Name "))
        .when(priority == "2-HIGH", F.lit("unit_price"))
        .when(priority == "3-MEDIUM", F.lit("STOCK_QUANTITY"))
        .when((priority == "5-LOW") & (status == "F"), F.lit("warranty_months"))
        .when(priority == "5-LOW", F.lit("product_display_name"))
        .otherwise(F.lit("created_at"))
    )
    price = money("o_totalprice").cast("string")
    value = (
        F.when(priority.isin("1-URGENT", "5-LOW"), F.concat(F.lit(" New Name "), F.col("o_orderkey").cast("string"), F.lit(" ")))
        .when((priority == "2-HIGH") & (status == "P"), F.lit("n/a"))
        .when((priority == "3-MEDIUM") & (status != "P"), F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
        .when(priority.isin("2-HIGH", "3-MEDIUM"), price)
        .when(status == "P", F.lit("not a date"))
        .otherwise(dates.second_label("o_orderdate"))
    )
    changes = load(spark, base, "orders").select(
        F.col("o_orderkey").alias("change_seq"),
        (F.col("o_custkey") * 2).alias("product_id"),
        name.alias("column_name"),
        value.alias("new_value"),
    )
    return merge.apply_change_log(products, changes)


@query
def column_change_log(spark, base):
    return _change_log(spark, base).table


@query
def column_change_rejects(spark, base):
    return _change_log(spark, base).decided.where(F.col("reason").isNotNull())


#: Requests that the lookups of a sale posting move at a time.
SLICE = 24_000_000


def _decide(spark, base):
    ends = list(range(SLICE, load(spark, base, "lineitem").count(), SLICE))
    with sparing(spark):
        return alone(lambda: posting.decide_checked(alone(lambda: _checked_sales(spark, base, ends)), ends))


def _checked_sales(spark, base, ends):
    products = b.store_products(spark, base)
    quantity = F.when(F.col("l_discount") == 0, F.lit(0)).when(
        F.col("l_tax") != 0, F.col("l_quantity").cast("int")
    )
    lines = load(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", quantity.alias("quantity"),
    )
    orders = load(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = products.select("product_id", "brand_name", "model_name")
    ordered = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    # The lines are numbered once; slices of them are read by their numbers.
    numbered = materialise(
        merge.assign_keys(lines, "seq", [F.col(column) for column in ordered], unique=True).drop("l_extendedprice")
    )
    number = F.concat_ws("-", F.lit("TX"), F.col("l_orderkey"), F.col("l_linenumber"))
    requests = (
        numbered.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(names, F.col("l_partkey") == F.col("product_id"))
        .select(
            "seq",
            number.alias("transaction_number"),
            F.concat(F.lit(" CUSTOMER"), F.col("o_custkey").cast("string"), F.lit("@Example.com")).alias("customer_email"),
            F.concat(F.lit("Clerk"), F.col("l_suppkey").cast("string"), F.lit("@example.com ")).alias("employee_email"),
            F.upper("brand_name").alias("brand_name"),
            F.concat(F.lit(" "), F.col("model_name")).alias("model_name"),
            "quantity",
            F.col("o_orderdate").alias("transaction_date"),
        )
    )
    customers = load(spark, base, "customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    )
    employees = load(spark, base, "supplier").where(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("employee_id"),
        F.concat(F.lit("clerk"), F.col("s_suppkey").cast("string"), F.lit("@example.com")).alias("email"),
    )
    posted = load(spark, base, "orders").where(F.col("o_orderstatus") == "P").select(
        F.concat(F.lit("TX-"), F.col("o_orderkey").cast("string"), F.lit("-1")).alias("transaction_number")
    )
    return posting.check_sales(requests, customers, employees, _sold_products(spark, base), posted, ends)


def _sold_products(spark, base):
    return b.store_products(spark, base).where(F.col("category_name") != "PROMO")


def _posting(spark, base):
    """One decision for all queries over the same tables."""
    paths = [f"{base}/{name}.parquet" for name in ("lineitem", "orders", "part", "customer", "supplier")]
    decided = written_once(spark, "decided sales", paths, lambda: _decide(spark, base))
    last_id = load(spark, base, "orders").agg(F.max("o_orderkey")).scalar()
    accepted = written_once(
        spark, "accepted sales", paths, lambda: posting.accepted_sales(decided, last_id)
    )
    return posting.post_decided(
        decided, accepted, _sold_products(spark, base), today=F.lit(date(2026, 1, 1)).cast("timestamp_ntz")
    )


@query
def post_sales(spark, base):
    return _posting(spark, base).decided.select(
        "seq", "transaction_number", "customer_id", "product_id", "quantity", "reason"
    )


@query
def post_sales_lines(spark, base):
    return _posting(spark, base).lines


@query
def post_sales_headers(spark, base):
    return _posting(spark, base).headers


@query
def post_sales_stock(spark, base):
    return _posting(spark, base).stock.select("product_id", "stock_quantity")


@query
def validate_new_items(spark, base):
    part = load(spark, base, "part")
    title = F.concat_ws(" ", "p_name", "p_brand")
    catalogue = part.where(F.col("p_size") <= 10).select(title.alias("title"))
    proposals = part.select(
        F.col("p_partkey").alias("seq"),
        F.when(F.col("p_brand") == "Brand#13", F.lit("   "))
        .otherwise(F.concat(F.lit("  "), F.upper(title), F.lit(" ")))
        .alias("title"),
        F.when(F.col("p_size") != 12, F.lit(1860) + F.col("p_size") * 4).alias("release_year"),
        F.concat(F.lit(" Nation_"), (F.col("p_size") - F.length("p_name")).cast("string")).alias("language"),
    )
    languages = load(spark, base, "nation").select(
        F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("name")
    )
    return merge.validate_new_items(catalogue, proposals, languages, 2026)


@query
def new_items_inserted(spark, base):
    """The rows that accepted proposals become, in a language given or the default one."""
    part = load(spark, base, "part")
    films = part.where(F.col("p_size") <= 10).select(
        F.col("p_partkey").alias("film_id"), F.concat_ws(" ", "p_name", "p_brand").alias("title")
    )
    proposals = part.select(
        F.col("p_partkey").alias("seq"),
        F.concat(F.lit(" "), F.upper(F.concat_ws(" ", "p_name", "p_brand"))).alias("title"),
        F.when(F.col("p_size") != 12, F.lit(1860) + F.col("p_size") * 4).alias("release_year"),
    )
    languages = load(spark, base, "nation").select(
        F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("name")
    )
    decided = merge.validate_new_items(films, proposals, languages, 2026, default_language=" nation_3")
    rows = merge.new_item_rows(decided, films, languages, F.lit(date(2026, 1, 1)))
    return rows.withColumn("special_features", F.array_join("special_features", ","))


# Tables written and read again


def _fresh(spark):
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


SERIES_PREFIX = "numbered_text"


@query
def series_table(spark, base):
    """As many numbered texts as orders: created, a third deleted, read back."""
    n = load(spark, base, "orders").count()
    texts = inline.series(spark, 1, n).select(inline.numbered_text(SERIES_PREFIX, F.col("n")).alias("col"))
    made = tables.create_table_as(texts, _fresh(spark))
    number = inline.suffix_number(F.col("col"), SERIES_PREFIX)
    left = tables.create_table_as(merge.delete_where(made, number % 3 == 0).table, _fresh(spark))
    return left.agg(
        F.count("*").alias("row_count"), F.min(number).alias("first_number"),
        F.max(number).alias("last_number"), F.sum(F.length("col")).alias("characters"),
    )


@query
def append_reordered(spark, base):
    """Rows with their columns in another order, and one missing, go behind the others."""
    orders = load(spark, base, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("origin"),
    )
    path = _fresh(spark)
    tables.create_table_as(orders.where(F.col("status") == "P"), path)
    rest = orders.where(F.col("status") != "P").select("status", F.col("order_id").cast("string").alias("order_id"))
    tables.append(rest, path, {"origin": "appended"})
    return spark.read.parquet(path)


@query
def truncate_and_refill(spark, base):
    """Rows of a table before it is truncated, after, and when it is filled again."""
    lines = load(spark, base, "lineitem").select("l_orderkey", "l_linenumber")
    path = _fresh(spark)
    full = tables.create_table_as(lines, path).count()
    empty = tables.truncate(spark, path).count()
    tables.append(lines.where(F.col("l_linenumber") == 1), path)
    return spark.read.parquet(path).agg(
        F.lit(full).alias("before"), F.lit(empty).alias("truncated"), F.count("*").alias("refilled")
    )


@query
def payments_of_a_month(spark, base):
    """Payments written in one folder per month, of which one is read."""
    payments = b.payment(spark, base).withColumn("month", dates.month_label("payment_date"))
    written = tables.create_table_as(payments, _fresh(spark), ["month"])
    return written.where(F.col("month") == "1997-04").select("payment_id", "customer_id", "amount", "month")


@query
def changed_months(spark, base):
    """Payments by month, of which one month is changed and another deleted in part; other
    months keep their files."""
    payments = b.payment(spark, base).withColumn("month", dates.month_label("payment_date"))
    path = _fresh(spark)
    tables.create_table_as(payments.select("payment_id", "customer_id", "amount", "month"), path, ["month"])
    customers = b.customer(spark, base).where(F.col("country_id") < 5).select("customer_id")

    def raise_amounts(rows):
        changes = rows.join(customers, "customer_id", "left_semi").select(
            "payment_id", (F.col("amount") + 1).cast("decimal(18,2)").alias("amount")
        )
        return merge.update_from(rows, changes, "payment_id", ["amount"]).table

    tables.change_partitions(spark, path, "month", ["1997-04"], raise_amounts)
    table = tables.change_partitions(
        spark, path, "month", ["1998-05", "1998-06"],
        lambda rows: merge.delete_where(rows, (F.col("month") == "1998-06") | (F.col("customer_id") % 2 == 0)).table,
    )
    return table.groupBy("month").agg(F.count("*").alias("payments"), F.sum("amount").alias("amount"))


BUCKETS = 16


def _bucketed(spark, base, name, key, columns):
    """A table bucketed by ``key``, written once for all queries over the same files."""
    def write():
        path = _fresh(spark)
        made = load(spark, base, name).select(*columns)
        return tables.create_bucketed(made, f"bucketed_{uuid.uuid4().hex}", path, key, BUCKETS)

    return written_once(spark, f"bucketed {name}", [f"{base}/{name}.parquet"], write, as_table=True)


@query
def bucketed_priority_revenue(spark, base):
    """Lines joined to their orders and summed per order, all by the layout of the tables."""
    orders = _bucketed(spark, base, "orders", "o_orderkey", ["o_orderkey", "o_orderpriority"])
    lines = _bucketed(spark, base, "lineitem", "l_orderkey", ["l_orderkey", "l_extendedprice"])
    per_order = lines.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum(money("l_extendedprice")).alias("amount")
    )
    return per_order.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "o_orderpriority", "lines", "amount"
    )


@query
def store_revenue_chain(spark, base):
    """Payments to stores over rental, copy, store and address."""
    return rental_reports.revenue_by_store(
        rental_reports.payment_facts(
            b.order_payments(spark, base), b.order_rentals(spark, base), b.inventory(spark, base)
        ),
        _addresses(spark, base), SINCE,
    )


@query
def in_stock_by_film_and_store(spark, base):
    """Copies in stock of one store, of one film, and out of the same film."""
    copies, rentals = b.inventory(spark, base), b.copy_rentals(spark, base)
    parts = {
        "store": table_functions.copies(copies, rentals, store_id=7),
        "film": table_functions.copies(copies, rentals, film_id=7),
        "film out": table_functions.copies(copies, rentals, in_stock=False, film_id=7),
        "film and store": table_functions.copies(copies, rentals, film_id=7, store_id=7),
    }
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("asked"), "inventory_id") for name, df in parts.items()
    ])


@query
def copy_holders(spark, base):
    """Who holds each copy."""
    return table_functions.holder(b.inventory(spark, base), b.rental(spark, base))


# The load

LOAD_OWNER = {"first_name": "NEW", "last_name": "OWNER", "email": "new@x.org"}
LOAD_STEPS = ["film", "film_category", "actor", "film_actor", "inventory", "customer",
              "deleted_payment", "deleted_rental", "rental", "payment"]


def _loads(spark, base, runs):
    """The load, run so many times, each on the tables that the one before left.

    What a run writes is read back by the next; the tables it left are unions and differences
    of that and of what was given, and are not copied."""
    pairs = materialise(b.supplied(spark, base))
    sources = [materialise(df) for df in b.load_sources(spark, base, pairs)]
    given, done = b.load_tables(spark, base, pairs), []
    for _ in range(runs):
        done.append(
            load_favourites(given, *sources, LOAD_OWNER, 2, (8, 8), date(2026, 1, 1), "nation_3")
        )
        given = done[-1].tables
    return done


def _counts(parts):
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("name"), F.count("*").alias("row_count")) for name, df in parts.items()
    ])


@query
def load_steps(spark, base):
    """Rows that each step of the load writes or deletes, in a first and a second run."""
    runs = [
        _counts({step: load_run.affected[step] for step in LOAD_STEPS}).select(F.lit(i).alias("run"), "*")
        for i, load_run in enumerate(_loads(spark, base, 2), 1)
    ]
    return runs[0].unionByName(runs[1])


@query
def load_tables(spark, base):
    """Rows of each table after the load."""
    return _counts(_loads(spark, base, 1)[0].tables)


# Integrity rules


@query
def dq_check_rules(spark, base):
    customer, orders = load(spark, base, "customer"), load(spark, base, "orders")
    lines, part = load(spark, base, "lineitem"), load(spark, base, "part")
    reports = [
        quality.rule_report(customer, "customer", {
            "name not null": quality.not_null("c_name"),
            "name not blank": quality.not_blank("c_name"),
            "name in normal form": quality.normal_form("c_name"),
            "balance not negative": F.col("c_acctbal") >= 0,
            "segment in domain": quality.in_domain("c_mktsegment", ["HOUSEHOLD", "MACHINERY"]),
        }),
        quality.rule_report(
            orders.withColumn("closed_on", F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))),
            "orders",
            {
                "closed date not null": quality.not_null("closed_on"),
                "closed after 1996": F.col("closed_on") > F.lit(date(1996, 12, 31)),
                "status in domain": quality.in_domain("o_orderstatus", ["F", "O"]),
                "price positive": F.col("o_totalprice") > 0,
            },
        ),
        quality.rule_report(lines, "lineitem", {
            "quantity positive": F.col("l_quantity") > 0,
            "discount at most 5 percent": F.col("l_discount") <= 0.05,
            "shipped after 1995": F.col("l_shipdate") > F.lit(date(1995, 12, 31)),
        }),
        quality.rule_report(part, "part", {
            "brand length": F.length("p_brand") <= 7,
            "size range": F.col("p_size").between(1, 49),
        }),
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


@query
def dq_unique(spark, base):
    lines = load(spark, base, "lineitem").select("l_orderkey", "l_linenumber")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def dq_unique_single(spark, base):
    part = load(spark, base, "part").select(
        F.when(F.col("p_size") != 1, F.col("p_name")).alias("name")
    )
    return quality.duplicate_keys(part, ["name"])


@query
def dq_orphans(spark, base):
    orders = load(spark, base, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
    )
    active = load(spark, base, "customer").where(F.col("c_acctbal") >= 0)
    return quality.orphans(orders, "o_custkey", active, "c_custkey")


@query
def dq_orphans_self(spark, base):
    """A key into the same table: the head office of a supplier, the first ones having none."""
    supplier = load(spark, base, "supplier").where(F.col("s_acctbal") >= 0)
    offices = supplier.select("s_suppkey", F.expr("nullif(s_suppkey div 10, 0)").alias("head_office"))
    return quality.orphans(offices, "head_office", offices, "s_suppkey")


@query
def dq_orphans_self_parts(spark, base):
    """The same among parts, many of whose heads are too small to be there."""
    kept = load(spark, base, "part").where(F.col("p_size") > 10)
    heads = kept.select("p_partkey", F.expr("nullif(p_partkey div 10, 0)").alias("head"))
    return quality.orphans(heads, "head", heads, "p_partkey")


#: Declared keys of the given tables, and of suppliers to their head office.
KEYS = [
    references.Key("nation", "n_regionkey", "region", "r_regionkey"),
    references.Key("customer", "c_nationkey", "nation", "n_nationkey"),
    references.Key("supplier", "s_nationkey", "nation", "n_nationkey"),
    references.Key("supplier", "head_office", "supplier", "s_suppkey"),
    references.Key("orders", "o_custkey", "customer", "c_custkey"),
    references.Key("lineitem", "l_orderkey", "orders", "o_orderkey"),
    references.Key("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]
KEYED = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
         "supplier": "s_suppkey", "orders": "o_orderkey"}


def _keyed_tables(spark, base):
    found = {name: load(spark, base, name) for name in [*KEYED, "lineitem"]}
    found["supplier"] = found["supplier"].withColumn("head_office", F.expr("nullif(s_suppkey div 4, 0)"))
    return {
        "region": found["region"].select("r_regionkey"),
        "nation": found["nation"].select("n_nationkey", "n_regionkey"),
        "customer": found["customer"].select("c_custkey", "c_nationkey"),
        "supplier": found["supplier"].select("s_suppkey", "s_nationkey", "head_office"),
        "orders": found["orders"].select("o_orderkey", "o_custkey"),
        "lineitem": found["lineitem"].select("l_orderkey", "l_suppkey"),
    }


def _cascade_counts(deleted):
    return reduce(DataFrame.unionByName, [
        deleted.doomed[name].agg(
            F.lit(step).alias("step"), F.lit(name).alias("table_name"), F.count("*").alias("deleted_rows")
        ).select("*", deleted.left[name].agg(F.count("*")).scalar().alias("rows_left"))
        for step, name in enumerate(deleted.order)
    ])


@query
def delete_nation_cascade(spark, base):
    """What a nation takes along, over four levels of tables and the offices below its suppliers."""
    roots = load(spark, base, "nation").where(F.col("n_name") == "NATION_3").select(F.col("n_nationkey").alias("id"))
    return _cascade_counts(references.delete_cascade(_keyed_tables(spark, base), KEYED, KEYS, "nation", roots))


@query
def offices_below(spark, base):
    """The offices below the first supplier, and how far below."""
    supplier = _keyed_tables(spark, base)["supplier"]
    roots = supplier.agg(F.min("s_suppkey").alias("id")).select(F.greatest("id", F.lit(1)).alias("id"))
    return references.descendants(supplier, "s_suppkey", "head_office", roots).withColumnRenamed("id", "s_suppkey")


@query
def fk_set_null(spark, base):
    child = load(spark, base, "customer").select("c_custkey", "c_nationkey")
    closed = b.countries(spark, base).where(one_of("country_region", ["asia"]))
    return quality.set_null_on_delete(child, "c_nationkey", closed, "country_id")


@query
def completeness(spark, base):
    """Rows and set values per table, before and after a backfill."""
    opened = F.lit(date(2026, 1, 1))
    return quality.completeness_by_stage({
        "customer": (load(spark, base, "customer").select(
            F.when(F.col("c_acctbal") >= 0, F.lit(1)).alias("record_ts")), "record_ts", F.lit(0)),
        "orders": (load(spark, base, "orders").select(
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("record_ts")), "record_ts", opened),
        "lineitem": (load(spark, base, "lineitem").select(
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("record_ts")), "record_ts", opened),
        "part": (load(spark, base, "part").select(
            F.nullif("p_type", F.lit("PROMO")).alias("record_ts")), "record_ts", F.lit("NONE")),
    })


# Access


def _principal(spark, base):
    return policy.first_active_principal(
        b.customer(spark, base),
        b.payment(spark, base).select("customer_id"),
        b.rental(spark, base).select("customer_id"),
    )


@query
def row_policy(spark, base):
    return policy.own_rows(
        b.payment(spark, base), b.customer(spark, base), _principal(spark, base)
    )


@query
def row_policy_denied(spark, base):
    """What a principal sees of its own payments and of another customer's, next to
    what there is: nothing of the other's, and no error."""
    payment, customer = b.payment(spark, base), b.customer(spark, base)
    principal = _principal(spark, base)
    own = policy.own_customer(customer, principal)
    other = payment.where(F.col("customer_id") != own).agg(F.min("customer_id")).scalar()
    asked = payment.where((F.col("customer_id") == own) | (F.col("customer_id") == other))
    there = asked.groupBy("customer_id").agg(F.count("*").alias("actual_rows"))
    seen = policy.own_rows(asked, customer, principal).groupBy("customer_id").agg(
        F.count("*").alias("visible_rows")
    )
    return there.join(seen, "customer_id", "left").select(
        "customer_id", "actual_rows", F.coalesce("visible_rows", F.lit(0)).alias("visible_rows")
    )


@query
def column_policy(spark, base):
    people = b.customer(spark, base).select(
        "customer_id",
        F.lower("first_name").alias("first_name"),
        F.lower("last_name").alias("last_name"),
        "country_id",
    )
    return policy.visible(people, ["customer_id", "first_name", "last_name"])


# Scalar functions


@query
def scalar_text(spark, base):
    customer = load(spark, base, "customer")
    segment = F.col("c_mktsegment")
    return customer.select(
        "c_custkey",
        F.upper("c_name").alias("upper_name"),
        F.lower("c_name").alias("lower_name"),
        F.left("c_name", F.lit(5)).alias("left_name"),
        F.length("c_name").alias("name_length"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("replaced"),
        F.btrim(F.concat(F.lit("  "), segment, F.lit(" "))).alias("trimmed"),
        capitalised(F.concat(segment, F.lit("'s big-deal 1st "), segment)).alias("title_case"),
        joined(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), F.lit("/"), "c_nationkey").alias("null_skipped"),
        F.concat(F.nullif("c_mktsegment", F.lit("HOUSEHOLD")), F.lit("/")).alias("null_passed"),
        merged("c_name", F.nullif("c_mktsegment", F.lit("MACHINERY"))).alias("merged"),
        matches("c_mktsegment", "%HOLD").alias("is_household"),
        F.round(money("c_acctbal") * F.lit("0.125").cast("decimal(4,3)"), 2).alias("eighth"),
        F.array_size(F.array(F.lit("a"), segment)).alias("pair_size"),
    )


@query
def scalar_date(spark, base):
    when = F.col("o_orderdate")
    return load(spark, base, "orders").select(
        "o_orderkey",
        dates.quarter_start("o_orderdate").alias("quarter_start"),
        dates.month_label("o_orderdate").alias("month_label"),
        dates.second_label(when + F.expr("INTERVAL '1' HOUR")).alias("hour_later"),
        dates.second_label(when + F.expr("INTERVAL '7' DAY")).alias("week_later"),
        F.add_months(dates.day(when), 3).alias("quarter_later"),
        F.date_sub(dates.day(when), 82).alias("days_before"),
        dates.month_end("o_orderdate").alias("month_end"),
        F.year(when).alias("year"),
        F.quarter(when).alias("quarter"),
        F.month(when).alias("month"),
        dates.iso_week("o_orderdate").alias("week"),
        dates.day_name("o_orderdate").alias("day_name"),
        F.datediff(F.lit(date(2002, 1, 1)), when).alias("days_since"),
    )


@query
def scalar_masks(spark, base):
    price = money("o_totalprice")
    return load(spark, base, "orders").select(
        "o_orderkey",
        formats.plain_amount(price).alias("plain"),
        formats.grouped_integer(price).alias("grouped"),
        formats.percent(price / 1000000).alias("percent"),
        formats.plain_percent(price / 1000).alias("plain_percent"),
        (F.pow(F.lit(10), F.lit(7)).cast("int") + F.col("o_orderkey")).alias("shifted"),
    )
