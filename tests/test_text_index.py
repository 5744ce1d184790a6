"""Pattern search through pieces, against LIKE on every text."""

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.text import matches
from ledgerlark.operators import text_index
from ledgerlark.plans.catalog import QUERIES
from tests.conftest import SMALL, bag

TITLES = ["Love Actually", "GLOVE", "lovely bones", "50% off", "a_b c", "İstanbul love", "", "ab", None, "Kelvin K love",
          "aaaa", "back\\slash", "Lo ve"]


@pytest.fixture(scope="module")
def films(spark):
    return spark.createDataFrame(list(enumerate(TITLES)), "film_id int, title string")


@pytest.mark.parametrize("pattern", [
    "%love%", "love%", "%LOVE", "%lo_e%", "%50\\%%", "a\\_b%", "%", "%ab%", "%aaa%", "%aaaa%", "%i%stanbul%",
    "%K love%", "%zzz%", "glove", "%love%bones%", "%k love%", "%\\\\slash",
])
def test_found_as_without_the_index(films, pattern):
    index = text_index.gram_rows(films, "film_id", "title")
    got = text_index.matching(films, "film_id", "title", pattern, index)
    assert bag(got) == bag(films.where(matches("title", pattern)))


def test_pieces_of_patterns():
    assert text_index.pattern_grams("%Love_x%") == ["lov", "ove"]
    assert text_index.pattern_grams("a\\%b%") == ["a%b"]
    assert text_index.pattern_grams("%ab_c%") == []
    assert text_index.literal_runs("a%b_c\\_d") == ["a", "b", "c_d"]


def test_a_piece_reads_few_rows(spark, films, tmp_path):
    path = str(tmp_path / "index")
    text_index.gram_rows(films, "film_id", "title").write.parquet(path)
    index = spark.read.parquet(path)
    plan = text_index.matching(films, "film_id", "title", "%love%", index)._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [lov,ove])" in plan


def test_nothing_found_reads_no_fact(spark):
    found = QUERIES["like_not_found"](spark, SMALL)
    assert found.inputFiles() == []
    assert found.count() == 1


def test_found_reads_the_titles_found_alone(spark):
    rows = QUERIES["like_in_stock"](spark, SMALL)
    parts = spark.read.parquet(f"{SMALL}/part.parquet").where(F.upper("p_name").like("%RING%"))
    names = {r.p_name for r in parts.collect()}
    assert {r.film_title for r in rows.collect()} <= names


def test_a_task_sorts_a_bounded_number_of_pieces(spark, monkeypatch):
    """However well the pieces compress; and an id that comes twice finds its rows."""
    monkeypatch.setattr(text_index, "ROWS_A_TASK", 1000)
    many = spark.range(3000).select((F.col("id") % 2000).alias("film_id"), F.concat(F.lit("ring "), "id").alias("title"))
    index = text_index.gram_rows(many, "film_id", "title")
    sizes = [r["count"] for r in index.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 12_000 and max(sizes) < 2000
    assert "HashAggregate" not in index._jdf.queryExecution().executedPlan().toString()
    for pattern in ("%ring 1%9%", "%ring 2999%"):
        got = text_index.matching(many, "film_id", "title", pattern, index)
        assert bag(got) == bag(many.where(matches("title", pattern)))
