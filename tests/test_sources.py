import os
import tempfile
from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from ledgerlark.functions import dates
from ledgerlark.operators import merge
from ledgerlark.session import materialise, shared_dir
from ledgerlark.sources import inline, tables
from tests.conftest import SMALL, bag, rows


def fresh():
    return tempfile.mkdtemp(prefix="ledgerlark-sources-") + "/table"


def test_values_and_series(spark):
    df = inline.values(spark, [(1, "a", None), (2, None, D("1.5"))], "k int, t string, v decimal(4,2)")
    assert rows(df) == [(1, "a", None), (2, None, D("1.50"))]
    assert df.dtypes == [("k", "int"), ("t", "string"), ("v", "decimal(4,2)")]
    assert rows(inline.series(spark, 3, 6)) == [(3,), (4,), (5,), (6,)]


def test_create_delete_third_truncate(spark):
    prefix, path = "veeeeeeery_long_string", fresh()
    made = inline.series(spark, 1, 3000).select(inline.numbered_text(prefix, F.col("n")).alias("col"))
    table = tables.create_table_as(made, path)
    assert table.where("col = 'VEEEEEEERY_LONG_STRING3000'").count() == 1
    change = merge.delete_where(table, inline.suffix_number(F.col("col"), prefix) % 3 == 0)
    assert (change.table.count(), change.affected.count()) == (2000, 1000)
    emptied = tables.truncate(spark, path)
    assert emptied.count() == 0 and emptied.columns == ["col"]


def test_append_reorders_casts_and_fills(spark):
    path = fresh()
    tables.create_table_as(
        spark.createDataFrame([(1, "a", date(2020, 1, 1))], "id long, name string, made date"), path
    )
    tables.append(
        spark.createDataFrame([("b", 2), (None, 3)], "name string, id int"),
        path,
        {"name": "?", "made": F.lit(date(2026, 1, 1))},
    )
    assert bag(spark.read.parquet(path)) == [
        (1, "a", date(2020, 1, 1)), (2, "b", date(2026, 1, 1)), (3, None, date(2026, 1, 1)),
    ]


def test_partitioned_write_prunes_on_read(spark):
    path = fresh()
    payments = spark.read.parquet(f"{SMALL}/orders.parquet").withColumn(
        "month", dates.month_label("o_orderdate")
    )
    table = tables.create_table_as(payments, path, ["month"])
    assert "month=1997-04" in os.listdir(path)
    april = table.where("month = '1997-04'")
    assert "PartitionFilters: [isnotnull(month" in april._jdf.queryExecution().executedPlan().toString()
    assert april.count() == payments.where("month = '1997-04'").count()
    assert table.count() == payments.count()


def test_intermediate_tables_go_to_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/") in folder
    df = materialise(spark.createDataFrame([(1, None, D("1.10"))], "a int, b string, c decimal(5,2)"))
    assert rows(df) == [(1, None, D("1.10"))]
    assert folder.removeprefix("file:") in df.inputFiles()[0].removeprefix("file://")


def test_clean_names(spark):
    assert bag(inline.clean_names(spark, [" A", "a ", "", None, "b"])) == [("a",), ("b",)]
    assert bag(inline.clean_names(spark, None)) == []
