"""Deleting along declared keys."""

import pytest

from ledgerlark.operators.references import Key, delete_cascade, delete_order, descendants
from ledgerlark.plans.catalog import KEYS, QUERIES
from tests.conftest import SMALL, bag


def test_children_come_before_parents():
    order = delete_order(["region", "nation", "customer", "supplier", "orders", "lineitem"], KEYS)
    assert sorted(order) == sorted({k.child for k in KEYS} | {k.parent for k in KEYS})
    for key in KEYS:
        assert key.child == key.parent or order.index(key.child) < order.index(key.parent)


def test_circles_and_unknown_tables_are_refused():
    with pytest.raises(ValueError, match="circle"):
        delete_order(["a", "b"], [Key("a", "x", "b", "id"), Key("b", "y", "a", "id")])
    with pytest.raises(ValueError, match="unknown"):
        delete_order(["a"], [Key("a", "x", "b", "id")])


def test_descendants_over_many_levels(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 3), (5, 1), (6, 99), (7, 8), (8, 7), (9, 8), (10, None), (None, 1)]
    table = spark.createDataFrame(rows, "id int, head int")
    roots = spark.createDataFrame([(1,), (7,), (None,)], "id int")
    got = descendants(table, "id", "head", roots)
    assert bag(got.where("id is not null")) == sorted(
        [(1, 0), (2, 1), (3, 2), (4, 3), (5, 1), (7, 0), (8, 1), (9, 2)], key=repr)


def test_cascade(spark):
    tables = {
        "office": spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, None)], "office int, head int"),
        "person": spark.createDataFrame([(1, 3), (2, 4), (3, None), (4, 1)], "person int, office int"),
        "sale": spark.createDataFrame([(1, 1, 4), (2, 2, 4), (3, 2, 1), (4, None, None), (4, None, None)],
                                      "sale int, person int, office int"),
    }
    keys = [Key("office", "head", "office", "office"), Key("person", "office", "office", "office"),
            Key("sale", "person", "person", "person"), Key("sale", "office", "office", "office")]
    roots = spark.createDataFrame([(1,), (77,)], "id int")
    deleted = delete_cascade(tables, {"office": "office", "person": "person"}, keys, "office", roots)
    assert deleted.order == ["sale", "person", "office"]
    assert bag(deleted.doomed["office"].select("office")) == [(1,), (2,), (3,)]
    assert bag(deleted.doomed["person"].select("person")) == [(1,), (4,)]
    assert bag(deleted.doomed["sale"].select("sale")) == [(1,), (3,)]
    assert bag(deleted.left["sale"].select("sale")) == [(2,), (4,), (4,)]
    assert bag(deleted.left["person"].select("person")) == [(2,), (3,)]
    assert bag(deleted.left["office"].select("office")) == [(4,)]


def test_registered_queries_are_not_empty(spark):
    assert max(r.depth for r in QUERIES["offices_below"](spark, SMALL).collect()) >= 1
    assert QUERIES["dq_orphans_self_parts"](spark, SMALL).count() > 0
    counts = {r.table_name: r.deleted_rows for r in QUERIES["delete_nation_cascade"](spark, SMALL).collect()}
    assert counts["nation"] == 1 and counts["lineitem"] > 0
