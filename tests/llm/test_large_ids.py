"""Ids above 2**53 beside a null id in one partition come back as they are."""

from __future__ import annotations

import pytest

from ledgerlark.llm import (
    decontaminate,
    fingerprint,
    near_dedup,
    packing,
    pii,
    quality,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)
from ledgerlark.llm.queries import vocabulary

BIG = 1 << 60
IDS = [None, BIG + 1, BIG + 3]
PASSAGE = " ".join(f"item{i}" for i in range(12))
TEXTS = ["first words of no account at all", f"second {PASSAGE} end", "third text which is like no other here"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(zip(IDS, TEXTS)), "doc_id bigint, text string").coalesce(1)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([("007", PASSAGE)], "item_id string, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.collect()), key=repr)


def test_operators(docs, labels, benchmark):
    words = vocabulary()
    want = sorted(IDS, key=repr)
    assert ids(near_dedup.near_duplicates(docs)) == want
    assert ids(pii.find_personal_data(docs)) == want
    assert ids(quality.score_quality(docs, labels)) == want
    assert ids(suffix_dedup.remove_repeats(docs)) == want
    assert ids(toxicity.score_toxicity(docs, labels)) == want
    assert ids(token_files.read_tokens(token_files.write_tokens(docs, words))) == want
    assert ids(fingerprint.fingerprints(docs)) == want
    assert ids(packing.pack_documents(docs, words)) == want
    hit = {r.doc_id: r.n_hit for r in decontaminate.find_contamination(docs, benchmark).collect()}
    assert hit == {None: 0, BIG + 1: 12, BIG + 3: 0}


def test_pages(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, "http://a.net/") for i in IDS], "page_id bigint, url string").coalesce(1)
    for most in (0, 1000):
        assert ids(url_filter.filter_urls(pages, rules, max_sent_rules=most), "page_id") == sorted(IDS, key=repr)


def test_stages(docs, labels, benchmark):
    want = sorted(IDS, key=repr)
    assert ids(toxicity.keep_clean(docs, labels)) == want
    assert ids(near_dedup.keep_one(docs)) == want
    assert ids(decontaminate.keep_clean(docs, benchmark)) == sorted([None, BIG + 3], key=repr)
    assert ids(pii.redact(docs)) == want


def test_item_ids_are_text(docs, benchmark):
    import hashlib

    found = {r.doc_id: r.items_sha256 for r in decontaminate.find_contamination(docs, benchmark).collect()}
    assert found[BIG + 1] == hashlib.sha256(b"007").hexdigest()


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_ties_go_to_the_longest_host(spark, most):
    rules = spark.createDataFrame(
        [("example.net", "/", "block"), ("net", "/abcdefgh", "allow")], "host string, path string, verdict string"
    )
    pages = spark.createDataFrame([(1, "http://example.net/abcdefgh")], "page_id bigint, url string")
    row = url_filter.filter_urls(pages, rules, max_sent_rules=most).first()
    assert (row.rule, row.verdict) == ("example.net/", "block")
