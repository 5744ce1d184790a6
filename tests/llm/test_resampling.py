from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import resampling
from ledgerlark.llm.resampling import bucket_counts, features, ranked, resample, text_buffer
from ledgerlark.session import materialise

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BIG = 1 << 60


def runs(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def crc(feature):
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % 10_000


def plain(docs, target, share=25):
    """The same with dictionaries and one sort."""
    s, t = [0] * 10_000, [0] * 10_000
    for _, text in docs:
        for f in runs(text)[1]:
            s[crc(f)] += 1
    for text in target:
        for f in runs(text)[1]:
            t[crc(f)] += 1
    all_s, all_t = sum(s), sum(t)

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    out = []
    for doc_id, text in docs:
        words, found = runs(text)
        weight = sum(gain(crc(f)) for f in found) // len(found) if found else 0
        name = f"7:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(found), weight, score, len(words) >= 20))
    able = sorted((o for o in out if o[4]), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    take = share * len(able) // 100
    return ([(*o[:4], i + 1 if i < take else None) for i, o in enumerate(able)]
            + [(*o[:4], None) for o in out if not o[4]])


def random_texts(n, seed):
    rng = random.Random(seed)
    some = ["Word", "the", "éÀ", "漢字", "x1", "İ", "a" * 70, "b" * 63, "c" * 64, "d" * 200]
    return ["".join(rng.choice(some) + rng.choice([" ", "-", "\n", "  ", " "]) for _ in range(rng.randrange(60)))
            for _ in range(n)]


@pytest.mark.parametrize("size", [1 << 20, 64, 7, 1])
def test_features_are_those_of_plain_strings(monkeypatch, size):
    monkeypatch.setattr(resampling, "_SLICE", size)
    texts = ["", "one", "two", *random_texts(40, 1), "", "x" * 500, "end", "", "No gap", "A1 b"]
    column = pa.array(["skipped", *texts]).slice(1)
    found: dict = {}
    words: dict = {}
    for buckets, text, of_words in features(*text_buffer(column)):
        for b, i in zip(buckets.tolist(), text.tolist()):
            found.setdefault(i, []).append(b)
        for i in of_words.tolist():
            words[i] = words.get(i, 0) + 1
    for i, text in enumerate(texts):
        want_words, want = runs(text)
        assert words.get(i, 0) == len(want_words)
        assert sorted(found.get(i, [])) == sorted(map(crc, want))


def test_no_text():
    assert list(features(*text_buffer(pa.array([], pa.string())))) == []
    assert list(features(*text_buffer(pa.array(["", ""], pa.string())))) == []
    assert len(list(features(*text_buffer(pa.array(["a b", "c"], pa.large_string()))))) == 1


def check(df, docs, target, share=25):
    want = plain(docs, target, share)
    got = [(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_draw_is_that_of_plain_loops(spark, make):
    texts = random_texts(300, 2) + ["the same text of Word the x1 " * 8] * 40
    target = ["word the word the 漢字", None, "x1 x1"]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    for share in (25, 0, 100, 7):
        check(resample(make(texts), benchmark, share), list(enumerate(texts)), target, share)


def test_odd_documents(spark, odd, nothing):
    benchmark = spark.createDataFrame([("a", "w1 w2 w3", 5)], "item_id string, text string, doc_id int")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check(resample(odd, benchmark, 50), docs, ["w1 w2 w3"], 50)
    check(resample(odd, benchmark.limit(0)), docs, [])
    assert resample(nothing, benchmark).collect() == []


def test_large_ids_beside_a_null(spark):
    docs = [(None, "a b " * 20), (BIG + 1, "c d " * 20), (BIG + 3, "c d " * 20), (BIG + 5, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    benchmark = spark.createDataFrame([("c",)], "text string")
    check(resample(frame, benchmark, 100), docs, ["c"], 100)


@pytest.mark.parametrize("hot", [0, 400])
def test_ranks_of_tied_scores_and_repeated_ids(spark, hot):
    """A third of all rows may be one row: its copies fall into several segments."""
    rng = np.random.default_rng(4)
    rows = [(int(i), int(s)) for i, s in zip(rng.permutation(800), rng.integers(0, 40, 800))]
    rows += [(5, 20)] * hot + [(None, 20)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, score bigint").repartition(6)
    from pyspark.sql import functions as F

    df = materialise(df.withColumn("row", F.monotonically_increasing_id()))
    got = ranked(df, 30, segment_rows=50).collect()
    order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    take = len(rows) * 30 // 100
    assert len(got) == len(rows)
    assert sorted((r.rank, r.doc_id, r.score) for r in got if r.rank) == sorted(
        (i + 1, *row) for i, row in enumerate(order[:take]))


def test_counts_of_all_tasks(make):
    texts = random_texts(50, 6)
    total = bucket_counts(make(texts))
    want = np.bincount([crc(f) for t in texts for f in runs(t)[1]], minlength=10_000)
    assert total.tolist() == want.tolist()
