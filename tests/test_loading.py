"""The load as a whole: what each step writes, and that a second run adds nothing."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import quality
from ledgerlark.plans import catalog, loading
from ledgerlark.plans.loading import load_favourites
from tests.conftest import SMALL, at, bag

NOW = date(2026, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, rental_db):
    db = dict(vars(rental_db))
    db["store"] = db["store"].withColumn("manager_staff_id", F.col("store_id") + 10)
    db["customer"] = db["customer"].withColumns(
        {"address_id": F.lit(3), "last_update": F.lit(None).cast("date")}
    )
    for name in ("film", "film_category", "actor", "film_actor", "inventory", "rental"):
        db[name] = db[name].withColumn("last_update", F.lit(None).cast("date"))
    return db


@pytest.fixture(scope="module")
def sources(spark):
    favourites = spark.createDataFrame(
        [
            ("River Song", 2016, 7, D("4.99"), 128, "PG-13", "drama", at("2017-01-10 10:00:00"), at("2017-01-17 10:00:00")),
            ("North Road", 2007, 14, D("9.99"), 148, "R", "TRAVEL", at("2017-02-11 11:00:00"), at("2017-02-25 11:00:00")),
            # Already in the catalogue, under another case.
            ("Alien", 2017, 21, D("19.99"), 142, "R", "Drama", at("2017-03-12 12:00:00"), at("2017-04-02 12:00:00")),
        ],
        "title string, release_year int, rental_duration int, rental_rate decimal(4,2), length int, rating string,"
        " category_name string, rental_date timestamp_ntz, return_date timestamp_ntz",
    )
    cast = spark.createDataFrame(
        [("River Song", 2016, "Rae", "Gold"), ("RIVER SONG", 2016, "Eve", "Rock"), ("alien", 2017, "Bob", "Bee")],
        "title string, release_year int, first_name string, last_name string",
    )
    return favourites, cast


OWNER = {"first_name": "NEW", "last_name": "OWNER", "email": "new@x.org"}


@pytest.fixture(scope="module")
def first(tables, sources):
    return load_favourites(tables, *sources, OWNER, 1, (3, 3), NOW)


def test_new_rows_get_ids_behind_the_old_ones(first):
    films = bag(first.affected["film"].select("film_id", "title", "language_id", "last_update"))
    assert films == [(7, "NORTH ROAD", 1, NOW), (8, "RIVER SONG", 1, NOW)]
    assert bag(first.affected["film_category"].select("film_id", "category_id")) == [(2, 2), (7, 3), (8, 2)]
    assert bag(first.affected["actor"].select("actor_id", "last_name")) == [(5, "ROCK"), (6, "GOLD")]
    assert bag(first.affected["film_actor"].select("film_id", "actor_id")) == [(2, 2), (8, 5), (8, 6)]
    # Film 2 already has a copy in store 1.
    assert bag(first.affected["inventory"].select("inventory_id", "film_id", "store_id")) == [(8, 7, 1), (9, 8, 1)]


def test_the_first_qualifying_customer_is_replaced(first):
    assert bag(first.affected["qualified"]) == [(1,)]
    assert bag(first.affected["customer"].select("customer_id", "last_name", "email", "address_id", "last_update")) == [
        (1, "OWNER", "new@x.org", 1, NOW)
    ]
    untouched = first.tables["customer"].where("customer_id <> 1")
    assert untouched.where("last_update is not null").count() == 0


def test_old_history_is_previewed_then_deleted(first, tables):
    assert bag(first.affected["preview"]) == [("PAYMENT", 6), ("RENTAL", 3)]
    assert first.affected["deleted_payment"].count() == 6
    assert first.affected["deleted_rental"].count() == 3


def test_new_history(first):
    columns = ["rental_id", "inventory_id", "customer_id", "staff_id", "rental_date"]
    # Ids of deleted rentals are not given out again.
    assert sorted(bag(first.affected["rental"].select(columns))) == [
        (8, 9, 1, 11, at("2017-01-10 10:00:00")),
        (9, 8, 1, 11, at("2017-02-11 11:00:00")),
        (10, 3, 1, 11, at("2017-03-12 12:00:00")),
    ]
    paid = bag(first.affected["payment"].select("payment_id", "rental_id", "amount", "payment_date"))
    # The price of a film that was there before is its own, not the proposed one.
    assert sorted(paid) == [
        (12, 8, D("4.99"), at("2017-01-10 11:00:00")),
        (13, 9, D("9.99"), at("2017-02-11 12:00:00")),
        (14, 10, D("0.99"), at("2017-03-12 13:00:00")),
    ]
    assert quality.duplicate_keys(first.tables["payment"], ["payment_id"]).count() == 0
    assert quality.orphans(first.tables["payment"], "rental_id", first.tables["rental"], "rental_id").count() == 0


def test_a_second_run_changes_nothing(first, sources):
    second = load_favourites(first.tables, *sources, OWNER, 1, (3, 3), date(2027, 1, 1))
    for name in ("film", "film_category", "actor", "film_actor", "inventory", "customer", "rental", "payment",
                 "deleted_payment", "deleted_rental"):
        assert second.affected[name].count() == 0, name
    for name in ("film", "rental", "payment", "customer"):
        assert bag(second.tables[name]) == bag(first.tables[name])


@pytest.mark.parametrize("name", ["load_steps", "load_tables"])
def test_the_pairs_of_the_lines_are_found_once(spark, monkeypatch, name):
    """And no table is copied between two runs, nor the lines read by what follows."""
    made, written, keep = [], [], loading.materialise

    def spy(df):
        written.append(set(df.columns))
        made.append([f for f in df.inputFiles() if "lineitem" in f])
        return keep(df)

    for module in (catalog, loading):
        monkeypatch.setattr(module, "materialise", spy)
    result = catalog.QUERIES[name](spark, SMALL)
    assert sum(map(bool, made)) == 1
    assert not [f for f in result.inputFiles() if "lineitem" in f]
    assert len(written) <= 26
