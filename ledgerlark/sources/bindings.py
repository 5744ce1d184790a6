"""The given tables seen through the rental and sales schemas.

Every function is a projection or a join of the given Parquet tables, so what
it returns grows with them.

========================  =====================================================
sales, line_sales         orders; lines with the order's customer and date
customers, countries      customer; nation with its region
products, film            part; a title's year is 1970 plus its size
category, film_category   part types
actor, film_actor         supplier; supplier and part of each line
inventory, store          pairs of part and supplier; supplier
rental                    lines; closed lines were returned on their ship date
payment                   orders
========================  =====================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.sources.tables import load, money

FIRST_RELEASE = 1970


def _name_part(column: str, part: int) -> Column:
    """Names look like ``Customer#000000001``: text before and after the mark."""
    return F.split_part(F.col(column), F.lit("#"), F.lit(part))


def inventory_id() -> Column:
    """The pair of part and supplier, as text, so that no two pairs ever share one."""
    return F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("inventory_id")


def _returned() -> Column:
    return F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("return_date")


# sales star


def sales(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders").select(
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderdate").alias("time_id"),
        F.left("o_orderpriority", F.lit(1)).alias("channel_id"),
        F.col("o_orderpriority").alias("channel_desc"),
        money("o_totalprice").alias("amount_sold"),
    )


def line_sales(spark: SparkSession, base: str, buyers: DataFrame | None = None) -> DataFrame:
    """Lines with their order's customer and date; with ``buyers`` (``cust_id``) only
    theirs, which are found among the orders before these meet the lines."""
    lines = load(spark, base, "lineitem").select(
        "l_orderkey",
        F.col("l_partkey").alias("prod_id"),
        money("l_extendedprice").alias("amount_sold"),
    )
    orders = load(spark, base, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("cust_id"), F.col("o_orderdate").alias("time_id")
    )
    if buyers is not None:
        orders = orders.join(buyers.select("cust_id"), "cust_id", "left_semi")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "prod_id", "cust_id", "time_id", "amount_sold"
    )


def event_sales(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "events").select(
        F.col("ts").alias("time_id"), money("value").alias("amount_sold")
    )


def customers(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "customer").select(
        F.col("c_custkey").alias("cust_id"),
        _name_part("c_name", 1).alias("cust_first_name"),
        _name_part("c_name", 2).alias("cust_last_name"),
        F.col("c_nationkey").alias("country_id"),
    )


def countries(spark: SparkSession, base: str) -> DataFrame:
    nation = load(spark, base, "nation")
    region = load(spark, base, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("country_id"),
        F.col("n_name").alias("country"),
        F.col("r_regionkey").alias("country_region_id"),
        F.col("r_name").alias("country_region"),
    )


def products(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "part").select(
        F.col("p_partkey").alias("prod_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("prod_category"),
    )


# rental schema


def film(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "part").select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        (F.lit(FIRST_RELEASE) + F.col("p_size")).alias("release_year"),
        money("p_retailprice").alias("rental_rate"),
        F.col("p_size").alias("rental_duration"),
        F.col("p_size").alias("length"),
        F.col("p_brand").alias("rating"),
        F.col("p_type").alias("language_name"),
    )


def film_category(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "part").select(
        F.col("p_partkey").alias("film_id"), F.col("p_type").alias("category_id")
    )


def category(spark: SparkSession, base: str) -> DataFrame:
    kinds = load(spark, base, "part").select("p_type").distinct()
    return kinds.select(F.col("p_type").alias("category_id"), F.col("p_type").alias("name"))


def actor(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "supplier").select(
        F.col("s_suppkey").alias("actor_id"),
        _name_part("s_name", 1).alias("first_name"),
        _name_part("s_name", 2).alias("last_name"),
    )


def film_actor(spark: SparkSession, base: str) -> DataFrame:
    return (
        load(spark, base, "lineitem")
        .select(F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id"))
        .distinct()
    )


def inventory(spark: SparkSession, base: str) -> DataFrame:
    pairs = load(spark, base, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return pairs.select(
        inventory_id(), F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("store_id")
    )


def copy_rentals(spark: SparkSession, base: str) -> DataFrame:
    """Copy, film and return date of each rental, for reports that need no customer."""
    return load(spark, base, "lineitem").select(
        inventory_id(), F.col("l_partkey").alias("film_id"), _returned()
    )


def rental_counts(spark: SparkSession, base: str) -> DataFrame:
    """Rentals per order and customer.

    Lines are counted per order first; the join then needs no other shuffle of
    them.
    """
    lines = load(spark, base, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("_rows"))
    orders = load(spark, base, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("customer_id", "_rows")


def rental(spark: SparkSession, base: str, renters: DataFrame | None = None) -> DataFrame:
    """Lines as rentals; with ``renters`` (``customer_id``) only theirs, which are
    found among the orders before these meet the lines."""
    lines = load(spark, base, "lineitem").select(
        "l_orderkey",
        inventory_id(),
        F.col("l_partkey").alias("film_id"),
        _returned(),
        money("l_extendedprice").alias("amount"),
    )
    orders = load(spark, base, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
    )
    if renters is not None:
        orders = orders.join(renters.select("customer_id"), "customer_id", "left_semi")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("rental_id"),
        "inventory_id",
        "film_id",
        "customer_id",
        "rental_date",
        "return_date",
        "amount",
    )


def customer(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        _name_part("c_name", 1).alias("first_name"),
        _name_part("c_name", 2).alias("last_name"),
        F.col("c_nationkey").alias("country_id"),
    )


def payment(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )


def order_rentals(spark: SparkSession, base: str) -> DataFrame:
    """One rental per order: of the copy of its least line."""
    lines = load(spark, base, "lineitem").groupBy("l_orderkey").agg(
        F.min(F.struct("l_partkey", "l_suppkey")).alias("_least")
    )
    return lines.select(F.col("l_orderkey").alias("rental_id"), "_least.*").select("rental_id", inventory_id())


def order_payments(spark: SparkSession, base: str) -> DataFrame:
    """One payment per order for its rental."""
    return load(spark, base, "orders").select(
        F.col("o_orderkey").alias("rental_id"), money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )


def line_payments(spark: SparkSession, base: str) -> DataFrame:
    """One payment per line, on the ship date, in the supplier's store."""
    return load(spark, base, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("film_id"),
        money("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
    )


def store(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("address_id")
    )


def address(spark: SparkSession, base: str) -> DataFrame:
    """Nation and region as the two address lines; one region has no second
    line and one has a blank one."""
    region = F.col("country_region")
    return countries(spark, base).select(
        F.col("country_id").alias("address_id"),
        F.col("country").alias("address"),
        F.when(region == "EUROPE", F.lit("")).when(region != "ASIA", region).alias("address2"),
    )


def clerk_payments(spark: SparkSession, base: str) -> DataFrame:
    """Orders as payments taken by a member of staff; pending ones name no store."""
    return load(spark, base, "orders").select(
        F.col("o_custkey").alias("staff_id"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
        F.when(
            F.col("o_orderstatus") != "P", F.left("o_orderpriority", F.lit(1)).cast("int") - 1
        ).alias("store_id"),
    )


def region_addresses(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "region").select(
        F.col("r_regionkey").alias("store_id"), F.col("r_name").alias("store_address")
    )


def staff(spark: SparkSession, base: str) -> DataFrame:
    return customer(spark, base).select(
        F.col("customer_id").alias("staff_id"), "first_name", "last_name"
    )


# store schema


def transactions(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders").select(
        F.col("o_orderkey").alias("sales_transaction_id"),
        F.col("o_orderkey").cast("string").alias("transaction_number"),
        F.col("o_orderdate").alias("transaction_date"),
    )


def transaction_items(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("sales_transaction_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        money("l_extendedprice").alias("line_total"),
    )


def store_products(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_name"),
        F.col("p_brand").alias("brand_name"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("model_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        (F.col("p_size") * 10).alias("stock_quantity"),
    )


# the load: a catalogue of the larger parts, and the smallest ones as favourites

FAVOURITE_SIZES = (3, 4)


def _load_title() -> Column:
    return F.concat_ws(" ", F.upper("p_name"), F.col("p_partkey").cast("string"))


def supplied(spark: SparkSession, base: str) -> DataFrame:
    """The pairs of part and supplier, to be written before the load reads them again and again."""
    return load(spark, base, "lineitem").select("l_partkey", "l_suppkey").distinct()


def load_tables(spark: SparkSession, base: str, pairs: DataFrame) -> dict[str, DataFrame]:
    """The tables that the load changes. Parts of a favourite size have no genre,
    no cast and no copy yet, and those of the first of these sizes no film either;
    suppliers with debts are not known as actors. ``pairs`` are those of ``supplied``."""
    never = F.lit(None).cast("date").alias("last_update")
    part, orders = load(spark, base, "part"), load(spark, base, "orders")
    old = part.where(F.col("p_size") > FAVOURITE_SIZES[1])
    kinds = part.groupBy("p_type").agg(F.min("p_partkey").alias("category_id"))
    nation, supplier = load(spark, base, "nation"), load(spark, base, "supplier")
    return {
        "language": nation.select(F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("name")),
        "category": kinds.select("category_id", F.col("p_type").alias("name")),
        "film": part.where(F.col("p_size") > FAVOURITE_SIZES[0]).select(
            F.col("p_partkey").alias("film_id"), _load_title().alias("title"),
            (F.lit(FIRST_RELEASE) + F.col("p_size")).alias("release_year"), F.lit(0).alias("language_id"),
            F.col("p_size").alias("rental_duration"), F.col("p_retailprice").cast("decimal(10,2)").alias("rental_rate"),
            F.col("p_size").alias("length"), F.col("p_brand").alias("rating"), never,
        ),
        "film_category": old.join(kinds, "p_type").select(
            F.col("p_partkey").alias("film_id"), "category_id", never),
        "actor": supplier.where(F.col("s_acctbal") >= 0).select(
            F.col("s_suppkey").alias("actor_id"), F.upper(_name_part("s_name", 1)).alias("first_name"),
            _name_part("s_name", 2).alias("last_name"), never,
        ),
        "film_actor": pairs.join(
            old.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi"
        ).select(F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id"), never),
        "inventory": old.select(
            F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id"),
            F.lit(1).cast("bigint").alias("store_id"), never,
        ),
        "store": supplier.where(F.col("s_suppkey") <= 2).select(
            F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("address_id"),
            (F.col("s_suppkey") + 10).alias("manager_staff_id"),
        ),
        "address": nation.select(F.col("n_nationkey").alias("address_id")),
        "customer": load(spark, base, "customer").select(
            F.col("c_custkey").alias("customer_id"), _name_part("c_name", 1).alias("first_name"),
            _name_part("c_name", 2).alias("last_name"), F.lower("c_name").alias("email"),
            F.col("c_nationkey").alias("address_id"), never,
        ),
        "rental": orders.select(
            F.col("o_orderkey").alias("rental_id"), F.col("o_orderdate").alias("rental_date"),
            F.lit(0).cast("bigint").alias("inventory_id"), F.col("o_custkey").alias("customer_id"),
            F.lit(None).cast("timestamp_ntz").alias("return_date"), F.lit(1).cast("bigint").alias("staff_id"), never,
        ),
        "payment": orders.select(
            F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("customer_id"),
            F.lit(1).cast("bigint").alias("staff_id"), F.col("o_orderkey").alias("rental_id"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("amount"), F.col("o_orderdate").alias("payment_date"),
        ),
    }


def load_sources(spark: SparkSession, base: str, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Favourites, in another case than the catalogue, and their cast."""
    part = load(spark, base, "part").where(F.col("p_size").isin(*FAVOURITE_SIZES))
    year = (F.lit(FIRST_RELEASE) + F.col("p_size")).alias("release_year")
    rented = F.lit("2017-01-10 10:00:00").cast("timestamp_ntz")
    favourites = part.select(
        F.lower(_load_title()).alias("title"), year, F.col("p_size").alias("rental_duration"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("rental_rate"), F.col("p_size").alias("length"),
        F.col("p_brand").alias("rating"), F.lower("p_type").alias("category_name"),
        rented.alias("rental_date"), (rented + F.expr("INTERVAL '7' DAY")).alias("return_date"),
    )
    cast = pairs.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        load(spark, base, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).select(_load_title().alias("title"), year, _name_part("s_name", 1).alias("first_name"),
             _name_part("s_name", 2).alias("last_name"))
    return favourites, cast
