"""Reports on the fixtures: stated results, and equal results of all forms."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlark.plans import rental_reports as rr
from ledgerlark.plans import sales_reports as sr
from tests.conftest import rows


@pytest.fixture
def views(spark, rental_db):
    for name, df in vars(rental_db).items():
        df.createOrReplaceTempView(name)
    return spark


def test_titles_in_category(rental_db, views):
    args = (rental_db.film, rental_db.film_category, rental_db.category, "ANIMATION", 2017, 2019, 1)
    want = [("Love Actually", 2018, D("2.99")), ("lovely bones", 2019, D("4.99"))]
    assert rows(rr.titles_in_category(*args)) == want
    assert rows(rr.titles_in_category(*args, form="in")) == want
    cte = views.sql("""
        WITH ids AS (SELECT film_id FROM film_category JOIN category USING (category_id) WHERE lower(name) = 'animation')
        SELECT title, release_year, rental_rate FROM film JOIN ids USING (film_id)
        WHERE release_year BETWEEN 2017 AND 2019 AND rental_rate > 1 ORDER BY title""")
    assert rows(cte) == want


def test_store_revenue_forms_differ_where_stores_share_an_address(rental_db):
    payments = rr.payment_facts(rental_db.payment, rental_db.rental, rental_db.inventory)
    addresses = rr.store_addresses(rental_db.store, rental_db.address)
    since = date(2017, 4, 1)
    assert rows(rr.revenue_by_store(payments, addresses, since)) == [
        (2, "2 Side St", D("4.99")), (3, "1 Main St", D("3.98")),
    ]
    assert rows(rr.revenue_by_address(payments, addresses, date(2017, 1, 1))) == [
        ("1 Main St", D("11.95")), ("2 Side St", D("7.98")),
    ]


def test_top_actors_counts_by_id_not_by_name(rental_db):
    got = rows(rr.top_actors(rental_db.actor, rental_db.film_actor, rental_db.film, 2015))
    assert got == [("BOB", "BEE", 3), ("ANN", "AY", 2), ("ANN", "AY", 1), ("CY", "SEE", 1)]


def test_genre_counts_forms(rental_db):
    names = {"Drama": "drama", "travel": "travel", "documentary": "documentary"}
    args = (rental_db.film, rental_db.film_category, rental_db.category, names)
    want = [(2017, 0, 1, 1), (2016, 1, 0, 0), (2014, 1, 0, 0)]
    assert rows(rr.genre_counts(*args)) == want
    assert rows(rr.genre_counts(*args, form="spine")) == want


def staff_by_anti_join(spark):
    """The report written with a self anti join, as plain SQL."""
    return spark.sql("""
        WITH addresses AS (SELECT store_id, CASE WHEN address2 IS NULL OR address2 = '' THEN address
                           ELSE address || ', ' || address2 END AS store_address FROM store JOIN address USING (address_id)),
        y AS (SELECT * FROM payment WHERE payment_date >= timestamp_ntz'2017-01-01' AND payment_date < timestamp_ntz'2018-01-01'),
        last_rows AS (
            SELECT p.staff_id, i.store_id, a.store_address FROM y p JOIN rental r ON p.rental_id = r.rental_id
            JOIN inventory i ON r.inventory_id = i.inventory_id JOIN addresses a ON i.store_id = a.store_id
            LEFT JOIN y later ON p.staff_id = later.staff_id AND later.payment_date > p.payment_date
            WHERE later.payment_id IS NULL)
        SELECT s.first_name, s.last_name, v.revenue, l.store_id, l.store_address
        FROM staff s JOIN (SELECT staff_id, sum(amount) revenue FROM y GROUP BY 1) v USING (staff_id)
        JOIN (SELECT staff_id, min(store_id) store_id, min(store_address) store_address FROM last_rows GROUP BY 1) l USING (staff_id)
        ORDER BY revenue DESC, last_name, first_name LIMIT 3""")


def test_top_staff(rental_db, views):
    payments = rr.payment_facts(rental_db.payment, rental_db.rental, rental_db.inventory, how="left")
    addresses = rr.store_addresses(rental_db.store, rental_db.address)
    # Staff 2 earned most with the payment that has no rental; staff 4 has no store at all.
    got = rows(rr.top_staff(rental_db.staff, payments, addresses, 2017))
    assert got == rows(staff_by_anti_join(views))
    assert got == [
        ("Noa", "Nye", D("8.98"), 1, "1 Main St"),
        ("Mia", "Moss", D("8.97"), 3, "1 Main St"),
        ("Oli", "Oak", D("6.98"), 3, "1 Main St"),
    ]
    only = rows(rr.top_staff(rental_db.staff, payments, addresses, 2017, store_payments_only=True))
    assert only[0][:3] == ("Mia", "Moss", D("8.97")) and only[2] == ("Noa", "Nye", D("3.98"), 1, "1 Main St")


def test_top_rented(rental_db):
    assert rows(rr.top_rented(rental_db.film, rental_db.inventory, rental_db.rental)) == [
        ("Love Actually", 3, "Parental guidance suggested"),
        ("Glove", 2, "18+"),
        ("ALIEN", 1, "17+"),
        ("lovely bones", 1, "All ages"),
    ]
    labels = rental_db.film.where("film_id in (4, 6)").select("film_id", "title", "rating")
    never = rental_db.inventory.select(F.col("inventory_id"))
    assert {r[2] for r in rows(rr.top_rented(labels, rental_db.inventory, never))} == {"Unknown"}


def test_inactivity_and_gaps(rental_db, views):
    appeared = rr.appearances(rental_db.film_actor, rental_db.film)
    assert rows(rr.inactivity(rental_db.actor, appeared, F.lit(date(2026, 5, 5)))) == [
        ("CY", "SEE", 2026 - 2016, 10)[:2] + (2016, 10),
        ("ANN", "AY", 2018, 8),
        ("ANN", "AY", 2018, 8),
        ("BOB", "BEE", 2019, 7),
    ]
    gaps = rows(rr.longest_gap(rental_db.actor, appeared))
    # An actor with one year only is left out.
    assert gaps == [("ANN", "AY", 4), ("ANN", "AY", 3), ("BOB", "BEE", 2)]
    correlated = views.sql("""
        WITH y AS (SELECT DISTINCT actor_id, release_year FROM film_actor JOIN film USING (film_id)),
        n AS (SELECT a.actor_id, a.release_year, min(b.release_year) nxt FROM y a JOIN y b
              ON a.actor_id = b.actor_id AND b.release_year > a.release_year GROUP BY 1, 2)
        SELECT first_name, last_name, max(nxt - release_year) g FROM n JOIN actor USING (actor_id)
        GROUP BY actor_id, first_name, last_name ORDER BY g DESC, last_name, first_name""")
    assert gaps == rows(correlated)


def test_qualifying_customers(rental_db, views):
    got = rows(rr.qualifying_customers(rental_db.customer, rental_db.rental, rental_db.payment, (2, 2)).select(
        "customer_id", "rental_count", "payment_count"))
    assert got == [(1, 3, 6), (2, 2, 2), (3, 2, 2)]
    fan_out = views.sql("""
        SELECT c.customer_id, count(DISTINCT r.rental_id), count(DISTINCT p.payment_id)
        FROM customer c LEFT JOIN rental r ON r.customer_id = c.customer_id
        LEFT JOIN payment p ON p.customer_id = c.customer_id GROUP BY 1
        HAVING count(DISTINCT r.rental_id) >= 2 AND count(DISTINCT p.payment_id) >= 2 ORDER BY 1""")
    assert got == rows(fan_out)
    assert len(rows(rr.qualifying_customers(rental_db.customer, rental_db.rental, rental_db.payment, (0, 0), None))) == 4


def test_channel_share(star):
    got = rows(sr.channel_share(star.sales, star.customers, star.countries, ["AMERICAS", "asia", "Europe"], 1999, 2001))
    assert got == [
        ("Americas", 1999, "Direct", "200 $", "66.67 %", "100.00 %", "-33.33 %"),
        ("Americas", 1999, "Web", "100 $", "33.33 %", None, None),
        ("Americas", 2000, "Web", "5 $", "100.00 %", "33.33 %", "66.67 %"),
        ("Americas", 2001, "Direct", "50 $", "25.00 %", "66.67 %", "-41.67 %"),
        ("Americas", 2001, "Web", "150 $", "75.00 %", "100.00 %", "-25.00 %"),
        ("Asia", 2000, "Direct", "10 $", "0.00 %", None, None),
        ("Asia", 2000, "Web", "1,000,008 $", "100.00 %", None, None),
        ("Europe", 1999, "Web", "8 $", "100.00 %", "100.00 %", "0.00 %"),
        ("Europe", 2000, "Web", "8 $", "100.00 %", "100.00 %", "0.00 %"),
        ("Europe", 2001, "Web", "8 $", "100.00 %", "100.00 %", "0.00 %"),
    ]


def test_top_customers_by_channel(star):
    got = rows(sr.top_customers_by_channel(star.sales, star.customers, 2))
    assert got == [
        ("Direct", "AY", "ANN", "300.00", "83.3079 %"),
        ("Direct", "BEE", "BOB", "50.00", "13.8846 %"),
        ("Web", "SEE", "CY", "1000007.50", "99.9713 %"),
        ("Web", "AY", "ANN", "155.00", ".0155 %"),
    ]


def test_quarter_crosstab(star):
    got = rows(sr.quarter_crosstab(star.sales, star.products, star.customers, star.countries, "photo", "ASIA", 2000))
    assert got == [
        ("Lens", "10.01", ".00", ".10", ".00", "10.11"),
        ("Camera", ".00", ".00", ".00", "7.00", "7.00"),
    ]


def test_top_in_all_years_forms(star):
    want = [("Web", 4, "DEE", "DI", "24.00")]
    years = [1998, 1999, 2001]
    assert rows(sr.top_in_all_years(star.sales, star.customers, years)) == want
    assert rows(sr.top_in_all_years_by_join(star.sales, star.customers, years)) == want
    # With one place per year, another customer takes it in 1999.
    assert rows(sr.top_in_all_years(star.sales, star.customers, years, n=1)) == []


def test_month_by_category(star):
    got = rows(sr.month_by_category(
        star.sales, star.products, star.customers, star.countries,
        {"americas": "americas_sales", "europe": "europe_sales"}, date(2000, 1, 1), date(2000, 3, 31)))
    assert got == [
        ("2000-02", "PHOTO", ".00", "8.00"),
        ("2000-03", "Print", "5.00", ".00"),
    ]


def test_latest_quarter_sales(spark):
    transactions = spark.createDataFrame(
        [(1, "A", date(2026, 3, 31)), (2, "B", date(2026, 4, 1)), (3, "C", date(2026, 5, 2)), (4, "B2", date(2026, 5, 3))],
        "sales_transaction_id long, transaction_number string, transaction_date date")
    items = spark.createDataFrame(
        [(1, 1, 1, D("10.00")), (2, 1, 2, D("20.00")), (3, 1, 1, D("10.00")), (4, 1, 1, D("10.00")), (4, 2, 3, D("3.00"))],
        "sales_transaction_id long, product_id long, quantity int, line_total decimal(12,2)")
    products = spark.createDataFrame(
        [(1, "fridge", "cold", "s", "rb"), (2, "oven", "hot", "b", "x")],
        "product_id long, product_name string, category_name string, brand_name string, model_name string")
    start = date(2026, 4, 1)
    assert rows(sr.latest_quarter_sales(transactions, items, products)) == [
        (start, "2026-04", "cold", "fridge", "s", "rb", 2, D("20.00"), 1),
        (start, "2026-05", "cold", "fridge", "s", "rb", 2, D("20.00"), 2),
        (start, "2026-05", "hot", "oven", "b", "x", 3, D("3.00"), 1),
    ]


def test_frames_follow_calendar_distance(spark):
    days = [(date(1999, 12, d), D(v)) for d, v in ((4, 10), (5, 20), (6, 30), (7, 40), (9, 50), (10, 60), (11, 70), (12, 80), (13, 90))]
    sales = spark.createDataFrame([(d, v) for d, v in days for _ in (1, 2)], "time_id date, amount_sold decimal(10,2)")
    got = rows(sr.weekly_progress(sales, date(1999, 12, 6), date(1999, 12, 12), [49]))
    assert got == [
        (49, date(1999, 12, 6), "Monday", D("60.00"), D("60.00"), 50.0),
        (49, date(1999, 12, 7), "Tuesday", D("80.00"), D("140.00"), 70.0),
        (49, date(1999, 12, 9), "Thursday", D("100.00"), D("240.00"), 110.0),
        (49, date(1999, 12, 10), "Friday", D("120.00"), D("360.00"), 130.0),
        (49, date(1999, 12, 11), "Saturday", D("140.00"), D("500.00"), 140.0),
        (49, date(1999, 12, 12), "Sunday", D("160.00"), D("660.00"), 160.0),
    ]
    daily = sr.daily_sales(sales, date(1999, 12, 6), date(1999, 12, 10))
    assert [r[3] for r in rows(sr.three_row_sum(daily))] == [D("60.00"), D("140.00"), D("240.00"), D("300.00")]
    assert [r[3] for r in rows(sr.neighbour_day_average(daily))] == [70.0, 70.0, 110.0, 110.0]


def test_day_range_on_timestamps(spark):
    from ledgerlark.operators.frames import day_range
    from tests.conftest import at

    df = spark.createDataFrame(
        [(at("2024-01-01 12:00:00"), 1), (at("2024-01-02 12:00:00"), 2), (at("2024-01-03 12:00:01"), 4)],
        "t timestamp_ntz, v int")
    assert [r[0] for r in rows(df.select(day_range("sum(v)", "t", 1, 0), "t").orderBy("t"))] == [1, 3, 4]


def test_groups_frame_skips_missing_years(star):
    got = rows(sr.year_group_sum(star.sales.where("year(time_id) <> 2000"), 1999, 2001))
    assert got == [
        (1999, "Direct", D("200.00"), D("308.00")),
        (1999, "Web", D("108.00"), D("308.00")),
        (2001, "Direct", D("50.00"), D("516.00")),
        (2001, "Web", D("158.00"), D("516.00")),
    ]
