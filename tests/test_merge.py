"""Changes to tables: results, affected rows, and what a second run does."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlark.operators import merge
from tests.conftest import bag, rows


@pytest.fixture(scope="module")
def actors(spark):
    return spark.createDataFrame(
        [(1, "Rae", "GOLD", date(2020, 1, 1)), (2, None, "ROCK", None)],
        "actor_id int, first_name string, last_name string, last_update date",
    )


def test_insert_if_absent_ignores_case_and_takes_defaults(spark, actors):
    source = spark.createDataFrame(
        [("gold", "RAE"), ("ROCK", "EVE"), ("HART", "ELI"), ("HART", "ELI")],
        "last_name string, first_name string",
    )
    keys = ["first_name", "last_name"]
    change = merge.insert_if_absent(actors, source, keys, keys, {"last_update": date(2026, 1, 1)})
    # Only the target is searched, so the repeated new key goes in twice.
    assert bag(change.affected) == sorted(
        [(None, "EVE", "ROCK", date(2026, 1, 1))] + [(None, "ELI", "HART", date(2026, 1, 1))] * 2, key=repr
    )
    assert change.table.count() == 5
    again = merge.insert_if_absent(change.table, source, keys, keys)
    assert again.affected.count() == 0


def test_on_conflict_do_nothing(spark):
    target = spark.createDataFrame([(1, 1, "old")], "a int, b int, v string")
    batch = spark.createDataFrame(
        [(1, 1, "x"), (1, 2, "z"), (1, 2, "y"), (None, 2, "n"), (None, 2, "n"), (2, 1, None)],
        "a int, b int, v string",
    )
    change = merge.insert_on_conflict_nothing(target, batch, ["a", "b"], ["v"])
    assert bag(change.affected) == sorted(
        [(1, 2, "y"), (2, 1, None), (None, 2, "n"), (None, 2, "n")], key=repr
    )
    again = merge.insert_on_conflict_nothing(change.table, batch.where("a is not null"), ["a", "b"], ["v"])
    assert again.affected.count() == 0


key = st.tuples(st.integers(0, 6), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(key, max_size=8, unique_by=lambda r: r[0]), st.lists(key, min_size=1, max_size=15))
def test_insert_then_delete_restores_the_table(spark, old, new):
    schema = "k int, v int"
    target, batch = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    inserted = merge.insert_on_conflict_nothing(target, batch, ["k"], ["v"])
    keys = [r[0] for r in rows(inserted.table)]
    assert sorted(keys) == sorted({k for k, _ in old} | {k for k, _ in new})
    assert merge.insert_on_conflict_nothing(inserted.table, batch, ["k"], ["v"]).affected.count() == 0
    deleted = merge.delete_using(inserted.table, inserted.affected, "k")
    assert bag(deleted.table) == sorted(old, key=repr)
    assert bag(deleted.affected) == bag(inserted.affected)


def test_update_from_touches_and_stamps_named_rows_only(spark, actors):
    changes = spark.createDataFrame([(2, "Eve"), (9, "Nobody")], "actor_id int, first_name string")
    change = merge.update_from(
        actors, changes, "actor_id", ["first_name"], stamp=("last_update", F.lit(date(2026, 1, 1)))
    )
    assert bag(change.table) == [(1, "Rae", "GOLD", date(2020, 1, 1)), (2, "Eve", "ROCK", date(2026, 1, 1))]
    assert bag(change.affected) == [(2, "Eve", "ROCK", date(2026, 1, 1))]


def test_update_from_can_set_null(spark, actors):
    changes = spark.createDataFrame([(1, None)], "actor_id int, first_name string")
    assert bag(merge.update_from(actors, changes, "actor_id", ["first_name"]).affected) == [
        (1, None, "GOLD", date(2020, 1, 1))
    ]


def test_update_latest_row(spark, actors):
    change = merge.update_latest_row(actors, "actor_id", {"last_name": F.upper(F.lit("new"))})
    assert bag(change.affected) == [(2, None, "NEW", None)]
    assert change.table.count() == 2


def test_deletes(spark):
    table = spark.createDataFrame([(1, "a3"), (2, "a4"), (None, "a6"), (3, None)], "k int, t string")
    by_key = merge.delete_using(table, spark.createDataFrame([(1,), (3,)], "k int"), "k")
    assert bag(by_key.table) == sorted([(2, "a4"), (None, "a6")], key=repr)
    assert bag(by_key.affected) == sorted([(1, "a3"), (3, None)], key=repr)
    by_rule = merge.delete_where(table, F.replace("t", F.lit("a"), F.lit("")).cast("int") % 3 == 0)
    assert bag(by_rule.affected) == sorted([(1, "a3"), (None, "a6")], key=repr)
    assert bag(by_rule.table) == sorted([(2, "a4"), (3, None)], key=repr)


def test_preview_equals_what_is_deleted(spark):
    pay = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "payment_id int, customer_id int")
    rent = spark.createDataFrame([(1, 1), (2, 3)], "rental_id int, customer_id int")
    me = spark.createDataFrame([(1,)], "customer_id int")
    assert rows(merge.delete_preview({"payment": pay, "rental": rent}, me, "customer_id")) == [
        ("PAYMENT", 2), ("RENTAL", 1),
    ]
    assert merge.delete_using(pay, me, "customer_id").affected.count() == 2


def test_assign_keys_continue_behind_the_greatest(spark, actors):
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    assert bag(merge.assign_keys(new, "actor_id", [F.col("name")], actors).select("actor_id", "name")) == [
        (3, "a"), (4, "b"), (5, "c"),
    ]
    empty = merge.assign_keys(new, "actor_id", [F.col("name")], actors.limit(0))
    assert bag(empty.select("actor_id")) == [(1,), (2,), (3,)]


def test_generated_and_backfilled_columns(spark):
    items = spark.createDataFrame([(2, D("10.50")), (3, None)], "quantity int, unit_price decimal(10,2)")
    total = (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)")
    assert bag(merge.with_generated(items, {"line_total": total}).select("line_total")) == sorted(
        [(D("21.00"),), (None,)], key=repr
    )
    added = merge.add_column_backfilled(items, "record_ts", F.lit(date(2026, 1, 1)))
    assert {r.record_ts for r in added.collect()} == {date(2026, 1, 1)}
    kept = merge.add_column_backfilled(items, "unit_price", F.lit(D("1.00")))
    assert bag(kept.select("unit_price")) == [(D("1.00"),), (D("10.50"),)]


def test_change_log(spark):
    products = spark.createDataFrame(
        [(1, "oven", D("5.00"), 3, None, datetime(2020, 1, 1)), (2, "fridge", D("6.00"), 4, "x", None)],
        "product_id long, product_name string, unit_price decimal(10,2), stock_quantity int,"
        " product_display_name string, created_at timestamp_ntz",
    )
    changes = spark.createDataFrame(
        [
            (1, 1, " Product_NAME ", "  New Oven "),
            (2, 1, "product_name", "Newer Oven"),
            (3, 1, "unit_price", "7.505"),
            (4, 1, "unit_price", "cheap"),
            (5, 2, "stock_quantity", " 12 "),
            (6, 2, "stock_quantity", "12.5"),
            (7, 2, "warranty_months", "3"),
            (8, 9, "product_name", "ghost"),
            (9, 9, "unit_price", "ghost"),
            (10, 2, "product_display_name", None),
            (11, 2, "created_at", "2024-02-03 04:05:06"),
            (12, 2, None, "x"),
            (13, 2, "unit_price", "123456789.00"),
        ],
        "change_seq long, product_id long, column_name string, new_value string",
    )
    log = merge.apply_change_log(products, changes)
    assert bag(log.table) == [
        (1, "newer oven", D("7.51"), 3, None, datetime(2020, 1, 1)),
        (2, "fridge", D("6.00"), 12, None, datetime(2024, 2, 3, 4, 5, 6)),
    ]
    reasons = {r.change_seq: r.reason for r in log.decided.collect()}
    assert reasons == {
        1: None, 2: None, 3: None, 5: None, 10: None, 11: None,
        4: "value does not convert", 6: "value does not convert", 9: "value does not convert",
        13: "value does not convert", 7: "column not allowed", 12: "column not allowed",
        8: "product not found",
    }


def test_validate_new_items(spark):
    catalog = spark.createDataFrame([(" Alien",)], "title string")
    languages = spark.createDataFrame([(1, "English"), (2, "French")], "language_id int, name string")
    proposals = spark.createDataFrame(
        [
            (1, " New Movie ", 2025, "english"),
            (2, "new movie", 2025, "English"),
            (3, "Klingon Default", None, "Klingon"),
            (4, "", 2025, "English"),
            (5, None, 2025, "English"),
            (6, "Old", 1887, "English"),
            (7, "First", 1888, " FRENCH "),
            (8, "Far", 2032, "English"),
            (9, "Near", 2031, "English"),
            (10, "ALIEN ", None, "English"),
            (11, "No Year", None, "English"),
            (12, "late", 2025, "Elvish"),
            (13, "Late", 2025, "English"),
        ],
        "seq int, title string, release_year int, language string",
    )
    got = bag(merge.validate_new_items(catalog, proposals, languages, 2026))
    assert got == sorted(
        [
            (1, "New Movie", 2025, "English", None),
            (2, "new movie", 2025, "English", "title already exists"),
            (3, "Klingon Default", 2026, "Klingon", "language is unknown"),
            (4, "", 2025, "English", "title is blank"),
            (5, None, 2025, "English", "title is blank"),
            (6, "Old", 1887, "English", "year is not valid"),
            (7, "First", 1888, "French", None),
            (8, "Far", 2032, "English", "year is not valid"),
            (9, "Near", 2031, "English", None),
            (10, "ALIEN", 2026, "English", "title already exists"),
            (11, "No Year", 2026, "English", None),
            (12, "late", 2025, "Elvish", "language is unknown"),
            (13, "Late", 2025, "English", None),
        ],
        key=repr,
    )


def test_several_changes_for_one_key_change_one_row(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int")
    changes = spark.createDataFrame([(1, "z", 9), (1, "y", 8), (1, "y", 7)], "id int, name string, n int")
    change = merge.update_from(target, changes, "id", ["name", "n"])
    assert bag(change.table) == [(1, "y", 7), (2, "b", 2)]
    assert bag(change.affected) == [(1, "y", 7)]


def test_a_repeated_natural_key_does_not_multiply_rows(spark):
    from ledgerlark.operators.joins import resolve

    df = spark.createDataFrame([(1, " A "), (2, "b"), (3, None)], "i int, k string")
    lookup = spark.createDataFrame([(7, "a"), (5, "A"), (9, "b")], "id int, name string")
    assert bag(resolve(df, lookup, {"k": "name"}, ["id"], "left").select("i", "id")) == sorted(
        [(1, 5), (2, 9), (3, None)], key=repr
    )


def test_an_explicit_null_is_kept(spark):
    target = spark.createDataFrame([(1, "a")], "id int, name string")
    source = spark.createDataFrame([(2, None)], "id int, name string")
    assert bag(merge.insert_if_absent(target, source, ["id"], defaults={"name": "x"}).table) == [(1, "a"), (2, None)]
    lacking = source.select("id")
    assert bag(merge.insert_if_absent(target, lacking, ["id"], defaults={"name": "x"}).table) == [(1, "a"), (2, "x")]
