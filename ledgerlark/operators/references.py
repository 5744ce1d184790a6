"""Deleting along declared keys: what goes with a row, and in which order tables are emptied."""

from __future__ import annotations

from functools import reduce
from graphlib import CycleError, TopologicalSorter
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import materialise


class Key(NamedTuple):
    """``child.column`` refers to ``parent.parent_column``; child and parent may be one table."""

    child: str
    column: str
    parent: str
    parent_column: str


def delete_order(tables: list[str], keys: list[Key]) -> list[str]:
    """Tables in an order in which each comes before those it refers to.

    A table may refer to itself; a longer cycle raises ``ValueError``.
    """
    known = {name: i for i, name in enumerate(tables)}
    after: dict[str, set[str]] = {name: set() for name in tables}
    for key in keys:
        if key.child not in known or key.parent not in known:
            raise ValueError(f"unknown table in {key}")
        if key.child != key.parent:
            after[key.parent].add(key.child)
    sorter = TopologicalSorter(after)
    try:
        sorter.prepare()
    except CycleError as error:
        raise ValueError(f"tables refer to each other in a circle: {error.args[1]}") from error
    order = []
    while sorter.is_active():
        ready = sorted(sorter.get_ready(), key=known.get)
        order += ready
        sorter.done(*ready)
    return order


def descendants(table: DataFrame, id_column: str, parent_column: str, roots: DataFrame) -> DataFrame:
    """``id`` of all rows that hang on a root, roots included, with the ``depth`` below the nearest root.

    ``roots`` holds ``id``. Each step joins one level, so there are as many steps as levels;
    rows that refer to each other in a circle are met once.
    """
    links = table.select(F.col(id_column).alias("id"), F.col(parent_column).alias("parent")).where(
        F.col("parent").isNotNull()
    ).distinct()
    links = materialise(links)
    level = materialise(roots.select("id").where(F.col("id").isNotNull()).distinct())
    found, depth = [level.withColumn("depth", F.lit(0))], 0
    while True:
        depth += 1
        below = links.join(level.select(F.col("id").alias("parent")), "parent", "left_semi").select("id").distinct()
        known = reduce(DataFrame.unionByName, found)
        level = materialise(below.join(known, "id", "left_anti"))
        if level.isEmpty():
            return known
        found.append(level.withColumn("depth", F.lit(depth)))


class Deleted(NamedTuple):
    """``order``: the tables as they are emptied; ``doomed`` and ``left``: their rows."""

    order: list[str]
    doomed: dict[str, DataFrame]
    left: dict[str, DataFrame]


def delete_cascade(tables: dict[str, DataFrame], ids: dict[str, str], keys: list[Key], start: str, roots: DataFrame) -> Deleted:
    """The rows of ``start`` whose id is in ``roots`` (``id``), and all rows that refer to them, over any
    number of tables and over references of a table to itself.

    ``ids`` names the id column of each table that others refer to. The doomed ids of a
    table are written before its children are read, and the tables come in ``delete_order``. Rows
    whose key is NULL, and rows without an id, stay.
    """
    order = delete_order(list(tables), keys)
    doomed: dict[str, DataFrame] = {}
    # Parents first: what is doomed in a table follows from the tables it refers to.
    for name in reversed(order):
        table = tables[name]
        hit = [roots.select("id")] if name == start else []
        if name in ids:
            own = F.col(ids[name]).alias("id")
            for key in keys:
                if key.child == name and key.parent != name and key.parent in doomed:
                    gone = doomed[key.parent].select(F.col("id").alias(key.column))
                    hit.append(table.join(gone, key.column, "left_semi").select(own))
            if not hit:
                continue
            found = reduce(DataFrame.unionByName, hit).distinct()
            itself = next((key for key in keys if key.child == key.parent == name), None)
            if itself is not None:
                found = descendants(table, ids[name], itself.column, found).select("id")
            # Only ids that the table has.
            doomed[name] = materialise(table.select(own).join(found, "id", "left_semi").distinct())
    gone, left = {}, {}
    for name in order:
        table = tables[name]
        if name in doomed:
            known = doomed[name].select(F.col("id").alias(ids[name]))
            gone[name] = table.join(known, ids[name], "left_semi")
            left[name] = table.join(known, ids[name], "left_anti")
            continue
        refers = [key for key in keys if key.child == name and key.parent in doomed]
        marked = table.withColumn("_gone", F.lit(False))
        for i, key in enumerate(refers):
            known = doomed[key.parent].select(F.col("id").alias(key.column), F.lit(True).alias(f"_by{i}"))
            marked = marked.join(known, key.column, "left").withColumn(
                "_gone", F.col("_gone") | F.coalesce(f"_by{i}", F.lit(False))
            ).drop(f"_by{i}")
        gone[name] = marked.where("_gone").select(*table.columns)
        left[name] = marked.where(~F.col("_gone")).select(*table.columns)
    return Deleted(order, gone, left)
