"""Run registered queries and their SQL side by side and report differences.

usage: python tools/compare.py [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import glob
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

from ledgerlark.plans.catalog import QUERIES
from ledgerlark.plans.oracle import ORACLE


def value(item):
    if isinstance(item, Decimal):
        raise TypeError("decimals are not comparable across engines")
    if isinstance(item, float):
        return round(item, 6)
    return item


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=lambda line: tuple(map(repr, line)))


def session():
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def connect(base):
    connection = duckdb.connect()
    for path in glob.glob(f"{base}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, connection, base, name):
    """None if equal, else a short description of the difference."""
    df = QUERIES[name](spark, base)
    got = table(df.columns, [tuple(row) for row in df.collect()])
    cursor = connection.execute(ORACLE[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = [line for line in got[1] if line not in set(want[1])][:3]
        missing = [line for line in want[1] if line not in set(got[1])][:3]
        return f"rows {len(got[1])} != {len(want[1])}, only here {extra}, only there {missing}"
    return None


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, connection = session(), connect(args.sf)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            difference = compare(spark, connection, args.sf, name) if name in ORACLE else "no SQL"
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:700]}"
        bad += difference is not None
        print(f"{'ok ' if difference is None else 'BAD'} {name} {time.time() - start:.1f}s {difference or ''}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
