from __future__ import annotations

import os
import sys
import tempfile
from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from ledgerlark.session import configure

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerlark-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def rows(df):
    """Rows as tuples, in the order of the result."""
    return [tuple(row) for row in df.collect()]


def bag(df):
    """Rows as tuples, in an order that does not depend on the plan."""
    return sorted(rows(df), key=repr)


D = Decimal


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def rental_db(spark):
    """A small rental database with ties, blanks, NULLs and open rentals."""

    def table(schema, data):
        return spark.createDataFrame(data, schema).cache()

    return SimpleNamespace(
        film=table(
            "film_id int, title string, release_year int, language_id int, rental_duration int,"
            " rental_rate decimal(4,2), length int, rating string",
            [
                (1, "Love Actually", 2018, 1, 3, D("2.99"), 90, "PG"),
                (2, "ALIEN", 2017, 1, 5, D("0.99"), 100, "R"),
                (3, "lovely bones", 2019, 2, 3, D("4.99"), 110, "G"),
                (4, "Zebra", 2016, 1, 4, D("3.99"), None, None),
                (5, "Glove", 2017, 2, 2, D("1.99"), 80, "NC-17"),
                (6, "Unseen Love", 2014, 1, 2, D("1.99"), 80, "X"),
            ],
        ),
        language=table("language_id int, name string", [(1, "english"), (2, "old FRENCH")]),
        category=table(
            "category_id int, name string",
            [(1, "Animation"), (2, "Drama"), (3, "Travel"), (4, "Documentary"), (5, "Empty")],
        ),
        film_category=table(
            "film_id int, category_id int", [(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 2), (2, 4)]
        ),
        actor=table(
            "actor_id int, first_name string, last_name string",
            [(1, "ANN", "AY"), (2, "BOB", "BEE"), (3, "ANN", "AY"), (4, "CY", "SEE")],
        ),
        film_actor=table(
            "actor_id int, film_id int",
            [(1, 1), (1, 2), (1, 6), (2, 3), (2, 4), (2, 5), (3, 1), (3, 6), (4, 4)],
        ),
        store=table("store_id int, address_id int", [(1, 1), (2, 2), (3, 1)]),
        address=table(
            "address_id int, address string, address2 string",
            [(1, "1 Main St", None), (2, "2 Side St", ""), (3, "3 Back St", "Floor 2")],
        ),
        inventory=table(
            "inventory_id int, film_id int, store_id int",
            [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 3, 2), (5, 4, 1), (6, 5, 3), (7, 6, 1)],
        ),
        customer=table(
            "customer_id int, store_id int, first_name string, last_name string, email string, country string",
            [
                (1, 1, "Ada", "Z", "ada@x.org", "Brazil"),
                (2, 1, "Ben", "Y", "ben@x.org", "Brazil"),
                (3, 2, "Cat", "X", "cat@x.org", "United States"),
                (4, 2, "Dan", "W", "dan@x.org", "Chile"),
            ],
        ),
        staff=table(
            "staff_id int, first_name string, last_name string",
            [(1, "Mia", "Moss"), (2, "Noa", "Nye"), (3, "Oli", "Oak"), (4, "Pat", "Poe")],
        ),
        rental=table(
            "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int,"
            " return_date timestamp_ntz, staff_id int",
            [
                (1, at("2017-01-10 10:00:00"), 1, 1, at("2017-01-12 10:00:00"), 1),
                (2, at("2017-02-10 10:00:00"), 1, 2, None, 1),
                (3, at("2017-02-10 10:00:00"), 2, 3, at("2017-02-20 10:00:00"), 2),
                (4, at("2017-03-01 09:00:00"), 3, 1, None, 2),
                (5, at("2017-04-01 09:00:00"), 4, 2, at("2017-04-02 09:00:00"), 3),
                (6, at("2017-04-05 09:00:00"), 6, 3, at("2017-04-09 09:00:00"), 3),
                (7, at("2017-04-05 09:00:00"), 6, 1, at("2017-04-06 09:00:00"), 1),
            ],
        ),
        payment=table(
            "payment_id int, customer_id int, staff_id int, rental_id int, amount decimal(5,2),"
            " payment_date timestamp_ntz",
            [
                (1, 1, 1, 1, D("2.99"), at("2017-01-10 11:00:00")),
                (2, 1, 1, 1, D("1.00"), at("2017-01-12 11:00:00")),
                (3, 2, 1, 2, D("2.99"), at("2017-02-10 11:00:00")),
                (4, 3, 2, 3, D("2.99"), at("2017-02-10 11:00:00")),
                (5, 1, 2, 4, D("0.99"), at("2017-03-31 23:59:59")),
                (6, 2, 3, 5, D("4.99"), at("2017-04-01 00:00:00")),
                (7, 3, 3, 6, D("1.99"), at("2017-04-05 10:00:00")),
                (8, 1, 1, 7, D("1.99"), at("2017-04-05 10:00:00")),
                (9, 4, 4, None, D("9.99"), at("2017-05-01 10:00:00")),
                (10, 1, 2, None, D("5.00"), at("2017-03-05 10:00:00")),
                (11, 1, 1, None, D("7.00"), at("2018-01-01 00:00:00")),
            ],
        ),
    )


@pytest.fixture(scope="session")
def star(spark):
    """A small sales star: a missing year, missing quarters, ties, a pad year."""

    def table(schema, data):
        return spark.createDataFrame(data, schema).cache()

    sales = [
        (1, 1, date(1998, 5, 1), 3, "Direct", D("100.00")),
        (1, 1, date(1999, 5, 1), 3, "Direct", D("200.00")),
        (2, 2, date(1999, 5, 2), 2, "Web", D("100.00")),
        (1, 2, date(2001, 2, 1), 3, "Direct", D("50.00")),
        (2, 1, date(2001, 3, 1), 2, "Web", D("150.00")),
        (1, 3, date(2000, 1, 15), 3, "Direct", D("10.01")),
        (1, 3, date(2000, 8, 15), 3, "Direct", D("0.10")),
        (2, 3, date(2000, 12, 31), 2, "Web", D("7.00")),
        (3, 3, date(2000, 2, 2), 2, "Web", D("1000000.50")),
        (3, 1, date(2000, 3, 31), 2, "Web", D("5.00")),
        (2, 4, date(2000, 2, 29), 2, "Web", D("8.00")),
        (2, 4, date(1998, 2, 28), 2, "Web", D("8.00")),
        (1, 4, date(2001, 1, 1), 2, "Web", D("8.00")),
        (1, 4, date(1999, 1, 1), 2, "Web", D("8.00")),
    ]
    return SimpleNamespace(
        sales=table(
            "prod_id int, cust_id int, time_id date, channel_id int, channel_desc string,"
            " amount_sold decimal(10,2)",
            sales,
        ),
        customers=table(
            "cust_id int, cust_first_name string, cust_last_name string, country_id int",
            [(1, "ann", "ay", 1), (2, "bob", "bee", 1), (3, "cy", "see", 2), (4, "di", "dee", 3)],
        ),
        countries=table(
            "country_id int, country_region_id int, country_region string",
            [(1, 10, "Americas"), (2, 20, "Asia"), (3, 30, "Europe"), (4, 40, "Oceania")],
        ),
        products=table(
            "prod_id int, prod_name string, prod_category string",
            [(1, "Lens", "Photo"), (2, "Camera", "PHOTO"), (3, "Book", "Print")],
        ),
    )
