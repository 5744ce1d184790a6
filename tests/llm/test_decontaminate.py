from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from ledgerlark.llm.decontaminate import MAX_SENT, find_contamination, keep_clean
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[i : i + 10]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        words = words_of(text)
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                of = windows.get(tuple(words[i : i + n]))
                if of:
                    hit |= set(range(i, i + n))
                    found |= of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return Counter(out)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def mixture(seed):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.choice([1, 3, 9, 10, 11, 40]), 60)) for i in range(30)]
    items += [(100, None), (101, "... !"), (None, sentence(rng, 12, 60)), (3, sentence(rng, 15, 60)),
              (200, "la la la la la la la la la la la la")]
    docs = []
    for i in range(60):
        words = sentence(rng, rng.choice([0, 5, 50, 200]), 60).split()
        for _ in range(rng.randrange(3)):
            item = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(item) + 1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = item[a : a + rng.choice([5, 9, 10, 12, 40])]
        docs.append((i, rng.choice([" ", ", ", "\n- "]).join(words)))
    docs += [(90, "la " * 300), (91, "LA-la " * 6), (92, None), (92, items[5][1])]
    return docs, items


@pytest.mark.parametrize("seed, sent", [(1, MAX_SENT), (2, MAX_SENT), (1, 0)])
def test_equals_brute_force(spark, seed, sent):
    docs, items = mixture(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = find_contamination(df, benchmark(spark, items), max_sent=sent)
    assert Counter(map(tuple, got.collect())) == brute(docs, items)


def test_odd_documents(odd, spark):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, rows[0][1] or "x"), (2, next(t for i, t in rows if i == 4)), (3, "漢字 😀")]
    got = find_contamination(odd, benchmark(spark, items))
    assert Counter(map(tuple, got.collect())) == brute(rows, items)
    clean = keep_clean(odd, benchmark(spark, items))
    assert clean.columns == odd.columns
    want = [k for k, n in brute(rows, items).items() for _ in range(n) if not k[5]]
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(k[0]) for k in want)


def test_empty_tables(odd, nothing, spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert find_contamination(nothing, none).collect() == []
    assert not any(r.contaminated for r in find_contamination(odd, none).collect())
    assert keep_clean(odd, none).count() == odd.count()
