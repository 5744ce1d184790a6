"""Reports on the sales star.

sales ``(prod_id, cust_id, time_id, channel_id, channel_desc, amount_sold)``
carries the channel of each row; customers ``(cust_id, cust_first_name,
cust_last_name, country_id)``; countries ``(country_id, country_region_id,
country_region)``; products ``(prod_id, prod_name, prod_category)``. Calendar
parts are computed from ``time_id``, a DATE or TIMESTAMP_NTZ, and period
predicates compare the bare column, so they reach the scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import dates, formats
from ledgerlark.functions.text import one_of, same_text
from ledgerlark.operators import frames
from ledgerlark.operators.joins import keys_in_all_periods, periods_seen
from ledgerlark.operators.parts import By, top_n
from ledgerlark.operators.pivot import crosstab, sum_columns
from ledgerlark.session import materialise


def regional_customers(
    customers: DataFrame, countries: DataFrame, regions: list[str]
) -> DataFrame:
    """Customers of the named regions with their region."""
    wanted = countries.where(one_of("country_region", regions)).select(
        "country_id", "country_region_id", "country_region"
    )
    return customers.select("cust_id", "country_id").join(wanted, "country_id").drop("country_id")


def top_customers_by_channel(sales: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best customers of each channel and their share of its sales.

    Channel totals are an aggregate of the customers' sums, not a window over all
    customers of a channel.
    """
    per_customer = sales.groupBy("channel_id", "channel_desc", "cust_id").agg(
        F.sum("amount_sold").alias("total_sales")
    )
    # Written: it is sampled, counted and ranked.
    per_customer = materialise(per_customer)
    best = top_n(
        per_customer, ["channel_id", "channel_desc"], [By("total_sales", False), By("cust_id")], n
    )
    totals = per_customer.groupBy("channel_id").agg(F.sum("total_sales").alias("channel_total"))
    share = F.col("total_sales").cast("double") / F.col("channel_total").cast("double") * 100
    return (
        best.join(totals, "channel_id")
        .join(customers, "cust_id")
        .orderBy("channel_desc", "place")
        .select(
            "channel_desc",
            F.upper("cust_last_name").alias("cust_last_name"),
            F.upper("cust_first_name").alias("cust_first_name"),
            formats.plain_amount("total_sales").alias("amount_sold"),
            formats.plain_percent(share).alias("sales_percentage"),
        )
    )


def quarter_crosstab(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    countries: DataFrame,
    category: str,
    region: str,
    year: int,
) -> DataFrame:
    """Product by quarter for one category, region and year.

    ``category="%"`` takes every category.
    """
    wanted = products if category == "%" else products.where(same_text("prod_category", category))
    rows = (
        sales.where(dates.in_years("time_id", year, year))
        .select("prod_id", "cust_id", "amount_sold", F.quarter("time_id").alias("quarter"))
        .join(wanted.select("prod_id", "prod_name"), "prod_id")
        .join(regional_customers(customers, countries, [region]), "cust_id")
    )
    wide = crosstab(rows, ["prod_name"], "quarter", [1, 2, 3, 4], "amount_sold", "year_sum")
    return wide.orderBy(F.desc("year_sum"), "prod_name").select(
        F.col("prod_name").alias("product_name"),
        *[formats.plain_amount(c).alias(c) for c in ("q1", "q2", "q3", "q4", "year_sum")],
    )


def top_in_all_years(
    sales: DataFrame, customers: DataFrame, years: list[int], n: int = 300
) -> DataFrame:
    """Customers among the ``n`` best of one channel in every listed year."""
    per_year = (
        sales.where(dates.in_listed_years("time_id", years))
        .groupBy("channel_desc", "cust_id", F.year("time_id").alias("calendar_year"))
        .agg(F.sum("amount_sold").alias("total_sales"))
    )
    best = top_n(
        materialise(per_year), ["channel_desc", "calendar_year"], [By("total_sales", False), By("cust_id")], n
    )
    # The yearly rows of a qualifying customer are summed in the same pass in
    # which the years are counted.
    steady = (
        best.groupBy("channel_desc", "cust_id")
        .agg(
            periods_seen("calendar_year", years).alias("_years"),
            F.sum("total_sales").alias("amount_sold"),
        )
        .where(F.col("_years") == len(set(years)))
    )
    return (
        steady.join(customers, "cust_id")
        .orderBy("channel_desc", "cust_last_name", "cust_first_name", "cust_id")
        .select(
            "channel_desc",
            "cust_id",
            F.upper("cust_last_name").alias("cust_last_name"),
            F.upper("cust_first_name").alias("cust_first_name"),
            formats.plain_amount("amount_sold").alias("amount_sold"),
        )
    )


def top_in_all_years_by_join(
    sales: DataFrame, customers: DataFrame, years: list[int], n: int = 300
) -> DataFrame:
    """The same report by joining the ranked rows to the keys of all years."""
    per_year = (
        sales.where(dates.in_listed_years("time_id", years))
        .groupBy("channel_desc", "cust_id", F.year("time_id").alias("calendar_year"))
        .agg(F.sum("amount_sold").alias("total_sales"))
    )
    best = top_n(
        materialise(per_year), ["channel_desc", "calendar_year"], [By("total_sales", False), By("cust_id")], n
    )
    steady = keys_in_all_periods(best, ["channel_desc", "cust_id"], "calendar_year", years)
    return (
        best.join(steady, ["channel_desc", "cust_id"])
        .join(customers, "cust_id")
        .groupBy("channel_desc", "cust_id", "cust_last_name", "cust_first_name")
        .agg(F.sum("total_sales").alias("amount_sold"))
        .orderBy("channel_desc", "cust_last_name", "cust_first_name", "cust_id")
        .select(
            "channel_desc",
            "cust_id",
            F.upper("cust_last_name").alias("cust_last_name"),
            F.upper("cust_first_name").alias("cust_first_name"),
            formats.plain_amount("amount_sold").alias("amount_sold"),
        )
    )


def month_by_category(
    sales: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    countries: DataFrame,
    regions: dict[str, str],
    first: date,
    last: date,
) -> DataFrame:
    """Month and category with one sales column per region.

    ``regions`` maps region names to column names.
    """
    sums = (
        sales.where(dates.between_days("time_id", first, last))
        .select(
            "prod_id", "cust_id", "amount_sold", dates.month_label("time_id").alias("calendar_month_desc")
        )
        .join(products.select("prod_id", "prod_category"), "prod_id")
        .join(regional_customers(customers, countries, list(regions)), "cust_id")
        .groupBy("calendar_month_desc", "prod_category")
        .agg(*sum_columns("country_region", "amount_sold", regions))
    )
    return sums.orderBy("calendar_month_desc", "prod_category").select(
        "calendar_month_desc",
        "prod_category",
        *[formats.plain_amount(name).alias(name) for name in regions.values()],
    )


def channel_share(
    sales: DataFrame,
    customers: DataFrame,
    countries: DataFrame,
    regions: list[str],
    first_year: int,
    last_year: int,
) -> DataFrame:
    """Share of each channel in its region's year, next to the year before.

    One extra year is read so that the first reported year has a predecessor.
    """
    channel_sales = (
        sales.where(dates.in_years("time_id", first_year - 1, last_year))
        .select(
            "cust_id",
            "channel_id",
            "channel_desc",
            F.year("time_id").alias("calendar_year"),
            "amount_sold",
        )
        # A hot customer brings one row per channel and year.
        .groupBy("cust_id", "channel_id", "channel_desc", "calendar_year")
        .agg(F.sum("amount_sold").alias("amount_sold"))
        .join(regional_customers(customers, countries, regions), "cust_id")
        .groupBy("country_region_id", "country_region", "calendar_year", "channel_id", "channel_desc")
        .agg(F.sum("amount_sold").alias("amount_sold"))
    )
    # From here on there is one row per region, year and channel.
    shares = channel_sales.withColumn(
        "pct", frames.share_of_total("amount_sold", ["country_region_id", "calendar_year"])
    ).withColumn("pct_before", frames.previous("pct", ["country_region_id", "channel_id"], "calendar_year"))
    return (
        shares.where(F.col("calendar_year").between(first_year, last_year))
        .orderBy("country_region", "calendar_year", "channel_desc")
        .select(
            "country_region",
            "calendar_year",
            "channel_desc",
            F.concat(formats.grouped_integer("amount_sold"), F.lit(" $")).alias("amount_sold"),
            formats.percent("pct").alias("% BY CHANNELS"),
            formats.percent("pct_before").alias("% PREVIOUS PERIOD"),
            formats.percent(F.round(F.col("pct") - F.col("pct_before"), 2)).alias("% DIFF"),
        )
    )


def daily_sales(sales: DataFrame, first: date, last: date) -> DataFrame:
    """One row per day with sales in the period."""
    return (
        sales.where(dates.between_days("time_id", first, last))
        .groupBy(dates.day("time_id").alias("time_id"))
        .agg(F.sum("amount_sold").alias("sales"))
    )


def weekly_progress(
    sales: DataFrame, first: date, last: date, weeks: list[int], padding: tuple[int, int] = (2, 1)
) -> DataFrame:
    """Sales per day with the running sum of the week and a centred average.

    ``padding`` days are read before ``first`` and after ``last`` for the
    averages; they are not reported.
    """
    read_first = date.fromordinal(first.toordinal() - padding[0])
    read_last = date.fromordinal(last.toordinal() + padding[1])
    days = daily_sales(sales, read_first, read_last).select(
        dates.iso_week("time_id").alias("calendar_week_number"),
        "time_id",
        dates.day_name("time_id").alias("day_name"),
        "sales",
    )
    framed = days.select(
        "*",
        frames.running_sum("sales", ["calendar_week_number"], "time_id").alias("cum_sum"),
        frames.weekday_average("sales", "time_id", F.col("day_name")).alias("_average"),
    )
    return (
        framed.where(
            F.col("calendar_week_number").isin(weeks) & F.col("time_id").between(F.lit(first), F.lit(last))
        )
        .orderBy("calendar_week_number", "time_id")
        .select(
            "calendar_week_number",
            "time_id",
            "day_name",
            F.round("sales", 2).alias("sales"),
            F.round("cum_sum", 2).alias("cum_sum"),
            F.round("_average", 2).alias("centered_3_day_avg"),
        )
    )


def three_row_sum(days: DataFrame) -> DataFrame:
    """Each day with the sum of itself and the two daily rows before it."""
    return days.select(
        "time_id",
        dates.day_name("time_id").alias("day_name"),
        "sales",
        frames.moving_sum("sales", "time_id", 2).alias("three_row_running_sales"),
    ).orderBy("time_id")


def neighbour_day_average(days: DataFrame) -> DataFrame:
    """Each day with the average over the calendar day before and after it."""
    return days.select(
        "time_id",
        dates.day_name("time_id").alias("day_name"),
        "sales",
        F.round(frames.day_range_average("sales", "time_id", 1, 1), 6).alias(
            "date_range_centered_average"
        ),
    ).orderBy("time_id")


def year_group_sum(sales: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Channel sales per year with the sum over this and the previous year present."""
    yearly = (
        sales.where(dates.in_years("time_id", first_year, last_year))
        .groupBy(F.year("time_id").alias("calendar_year"), "channel_desc")
        .agg(F.sum("amount_sold").alias("amount_sold"))
    )
    return frames.with_groups_sum(
        yearly, "amount_sold", "calendar_year", 1, "current_and_previous_year_sales"
    ).orderBy("calendar_year", "channel_desc")


def latest_quarter_sales(transactions: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and transactions of the last quarter present in the data.

    transactions ``(sales_transaction_id, transaction_number,
    transaction_date)``; items ``(sales_transaction_id, product_id, quantity,
    line_total)``; products ``(product_id, product_name, category_name,
    brand_name, model_name)``. The quarter start is a scalar subquery, known
    before the main scan starts, so it filters in the scan.
    """
    start = transactions.agg(
        dates.quarter_start(F.max("transaction_date")).alias("quarter_start_date")
    )
    kind = dict(transactions.dtypes)["transaction_date"]
    lower = start.select(F.col("quarter_start_date").cast(kind)).scalar()
    upper = start.select(F.add_months("quarter_start_date", 3).cast(kind)).scalar()
    recent = transactions.where(
        (F.col("transaction_date") >= lower) & (F.col("transaction_date") < upper)
    )
    return (
        recent.join(items, "sales_transaction_id")
        .join(products, "product_id")
        .groupBy(
            dates.month_label("transaction_date").alias("transaction_month"),
            "category_name",
            "product_name",
            "brand_name",
            "model_name",
        )
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.sum("line_total").alias("total_revenue"),
            F.countDistinct("transaction_number").alias("total_transactions"),
        )
        .select(
            lower.cast("date").alias("quarter_start_date"),
            "transaction_month",
            "category_name",
            "product_name",
            "brand_name",
            "model_name",
            "total_units_sold",
            "total_revenue",
            "total_transactions",
        )
        .orderBy("transaction_month", "category_name", "product_name")
    )
