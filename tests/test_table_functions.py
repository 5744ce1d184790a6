from datetime import date
from decimal import Decimal as D

import pytest

from ledgerlark.plans import table_functions as tf
from ledgerlark.plans.rental_reports import payment_facts
from tests.conftest import bag, rows


@pytest.fixture
def payments(rental_db):
    return payment_facts(rental_db.payment, rental_db.rental, rental_db.inventory)


def test_revenue_by_category(rental_db, payments):
    got = rows(tf.revenue_by_category(payments, rental_db.film_category, rental_db.category, date(2017, 2, 15)))
    assert got == [("ANIMATION", D("10.96")), ("DOCUMENTARY", D("0.99"))]


def test_revenue_by_category_without_data_or_date(rental_db, payments):
    empty = tf.revenue_by_category(payments, rental_db.film_category, rental_db.category, date(2020, 6, 1))
    assert rows(empty) == []
    with pytest.raises(ValueError):
        tf.revenue_by_category(payments, rental_db.film_category, rental_db.category, None)


def test_current_quarter_takes_as_of(rental_db, payments):
    got = tf.revenue_by_category_this_quarter(
        payments, rental_db.film_category, rental_db.category, as_of=date(2017, 5, 5)
    )
    assert rows(got) == [("ANIMATION", D("4.99")), ("TRAVEL", D("3.98"))]
    now = tf.revenue_by_category_this_quarter(payments, rental_db.film_category, rental_db.category)
    assert rows(now) == []


def popular(rental_db, names):
    film = rental_db.film.join(
        rental_db.language.withColumnRenamed("name", "language_name"), "language_id"
    )
    paid = (
        rental_db.rental.join(rental_db.inventory, "inventory_id")
        .join(rental_db.payment.select("rental_id", "amount"), "rental_id", "left")
        .select("rental_id", "customer_id", "film_id", "amount")
    )
    return rows(tf.most_popular_by_country(paid, rental_db.customer, film, names))


def test_most_popular_by_country(rental_db):
    # Rental 1 was paid twice and counts twice.
    assert popular(rental_db, ["Brazil", " brazil ", "", "UNITED states", "Chile", "Atlantis"]) == [
        ("Atlantis", "-", "-", "-", "-", "-"),
        ("Brazil", "Love Actually", "PG", "English", "90", "2018"),
        ("Chile", "-", "-", "-", "-", "-"),
        ("United States", "Love Actually", "PG", "English", "90", "2018"),
    ]


@pytest.mark.parametrize("names", [None, [], ["", "   "], [None]])
def test_most_popular_by_country_guards(rental_db, names):
    with pytest.raises(ValueError):
        popular(rental_db, names)


def in_stock(rental_db, pattern):
    film = rental_db.film.join(
        rental_db.language.withColumnRenamed("name", "language_name"), "language_id"
    )
    return rows(tf.films_in_stock(film, rental_db.inventory, rental_db.rental, rental_db.customer, pattern))


def test_films_in_stock(rental_db):
    # Two rentals tie for the latest of film 1 and share its number; film 6 was never rented.
    got = in_stock(rental_db, "%LOVE%")
    assert sorted(got[:2]) == [(2, "Glove", "Old French", "Ada Z", "2017-04-05 09:00:00"),
                               (2, "Glove", "Old French", "Cat X", "2017-04-05 09:00:00")]
    assert sorted(got[2:4]) == [(4, "Love Actually", "English", "Ben Y", "2017-02-10 10:00:00"),
                                (4, "Love Actually", "English", "Cat X", "2017-02-10 10:00:00")]
    assert got[4:] == [
        (5, "lovely bones", "Old French", "Ben Y", "2017-04-01 09:00:00"),
        (6, "Unseen Love", "English", " ", "-"),
    ]


def test_films_without_a_free_copy_do_not_match(rental_db):
    assert in_stock(rental_db, "alien") == [
        (1, "Movie not found or not currently in stock", "-", "-", "-")
    ]


@pytest.mark.parametrize("pattern", [None, "", "   "])
def test_films_in_stock_guards(rental_db, pattern):
    with pytest.raises(ValueError):
        in_stock(rental_db, pattern)


def test_copies_in_and_out(rental_db):
    inventory, rental = rental_db.inventory, rental_db.rental
    assert bag(tf.copies(inventory, rental, film_id=1)) == [(2,)]
    assert bag(tf.copies(inventory, rental, in_stock=False, film_id=1)) == [(1,)]
    assert bag(tf.copies(inventory, rental, film_id=1, store_id=1)) == []
    everything = {r[0] for r in bag(tf.copies(inventory, rental))} | {
        r[0] for r in bag(tf.copies(inventory, rental, in_stock=False))
    }
    assert everything == {r.inventory_id for r in inventory.collect()}


def test_holder(rental_db):
    got = dict(bag(tf.holder(rental_db.inventory, rental_db.rental)))
    assert got == {1: 2, 2: None, 3: 1, 4: None, 5: None, 6: None, 7: None}
    state = tf.stock_state(rental_db.inventory, rental_db.rental)
    assert {r.inventory_id for r in state.where("not in_stock").collect()} == {1, 3}


def balances(rental_db, when):
    rentals = (
        rental_db.rental.join(rental_db.inventory.select("inventory_id", "film_id"), "inventory_id")
        .join(rental_db.film.select("film_id", "rental_rate", "rental_duration"), "film_id")
    )
    got = tf.customer_balance(rental_db.customer, rentals, rental_db.payment, when, "1.00")
    return {r.customer_id: (r.rental_fees, r.overdue_fees, r.payments, r.balance) for r in got.collect()}


def test_customer_balance_counts_open_overdue_rentals(rental_db):
    got = balances(rental_db, date(2017, 3, 31))
    # Customer 2 still holds a copy: 49 days, 3 allowed.
    assert got[2] == (D("2.99"), D("46.00"), D("2.99"), D("46.00"))
    # Customer 3 brought it back after 10 days.
    assert got[3] == (D("2.99"), D("7.00"), D("2.99"), D("7.00"))
    assert got[4] == (D("0.00"), D("0.00"), D("0.00"), D("0.00"))
    # Payment at 23:59:59 of the day counts; the open copy is 30 days out, 5 allowed.
    assert got[1] == (D("3.98"), D("25.00"), D("9.98"), D("19.00"))


def test_rewards_report(rental_db):
    recent = rental_db.payment.where("payment_date < timestamp_ntz'2017-05-01'")
    assert bag(tf.rewards_report(recent, 1, "1.99")) == [(1, 1, D("1.99")), (2, 1, D("4.99")), (3, 1, D("1.99"))]
    assert bag(tf.rewards_report(recent, 1, "1.99", inclusive=False)) == []
    with pytest.raises(ValueError):
        tf.rewards_report(recent, 0, "1.00")


def test_text_lists_are_ordered(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "c"), (2, None)], "k int, v string")
    assert bag(tf.text_lists(df, ["k"], "v", "vs")) == [(1, "a,b,b"), (2, "c")]
    assert bag(tf.text_lists(df, ["k"], "v", "vs", distinct=True)) == [(1, "a,b"), (2, "c")]
