from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm import near_dedup
from ledgerlark.llm.components import components
from ledgerlark.llm.near_dedup import keep_one, near_duplicates
from tests.llm.conftest import SCHEMA, sentence


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Component (least id) of every row, by comparing all rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    ids: dict[int, list] = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc_id)
    least = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return [(doc_id, len(s), least[root(i)]) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def edit(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(25):
        base = sentence(rng, rng.choice([5, 8, 40, 150]))
        rows.append(base)
        rows += [edit(rng, base, rng.choice([0, 1, 1, 2, 4, 6])) for _ in range(rng.randrange(5))]
    rows += [rows[0].upper(), rows[1] + "  ", sentence(rng, 4), sentence(rng, 3)]
    return rows


def got_of(df):
    return [(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(make, seed):
    texts = corpus(seed)
    got = got_of(near_duplicates(make(texts)))
    assert Counter(got) == Counter(brute(list(enumerate(texts))))


def test_the_threshold_is_met_exactly(make):
    words = [f"a{i}" for i in range(11)]  # 7 shingles
    texts = [" ".join(words), " ".join(words[:10])]  # 6 of 7
    texts += [" ".join(f"b{i}" for i in range(12)), " ".join(f"b{i}" for i in range(10))]  # 6 of 8: 75
    texts += [" ".join(f"c{i}" for i in range(11)), " ".join(f"c{i}" for i in range(9))]  # 5 of 7: 71
    assert [r[2] for r in sorted(got_of(near_duplicates(make(texts))))] == [0, 0, 2, 2, 4, 5]


@pytest.mark.parametrize("leaf, wide, levels", [(4, 1000, 12), (4, 8, 12), (2, 4, 2)])
def test_large_groups_and_a_shared_passage(make, monkeypatch, leaf, wide, levels):
    monkeypatch.setattr(near_dedup, "LEAF", leaf)
    monkeypatch.setattr(near_dedup, "WIDE", wide)
    monkeypatch.setattr(near_dedup, "LEVELS", levels)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "VERIFY", 10)
    monkeypatch.setattr(near_dedup, "MAX_SENT", 20)
    rng = random.Random(3)
    base = sentence(rng, 200, 10**6)
    passage = sentence(rng, 30, 10**6)
    texts = [edit(rng, base, 5) for _ in range(90)]  # many pairs of which are not linked
    texts += [passage + " " + sentence(rng, 60, 10**6) for _ in range(60)]
    got = got_of(near_duplicates(make(texts)))
    assert Counter(got) == Counter(brute(list(enumerate(texts))))


@pytest.mark.parametrize("n", [6, 20, 80, 300, 2000])
def test_sketches_let_pairs_at_the_threshold_pass(n):
    rng = np.random.default_rng(n)
    for _ in range(50):
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        shared = -(-6 * len(base) // 7)
        other = np.unique(np.concatenate([
            rng.permutation(base)[:shared],
            rng.integers(0, 2**63, len(base) - shared, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
        ]))
        bits = np.unpackbits(near_dedup.sketches(np.concatenate([base, other]), np.array([len(base), len(other)])), axis=1)
        alike = np.array([(bits[0] == bits[1]).sum()])
        assert near_dedup.may_link(alike, np.array([float(len(base))]))[0]


def test_odd_documents(odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    result = near_duplicates(odd)
    assert Counter(got_of(result)) == Counter(brute(rows))
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in result.collect())


def test_empty_table(nothing):
    assert near_duplicates(nothing).collect() == []
    assert keep_one(nothing).collect() == []


def test_keep_one(odd, spark):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    rows = Counter((r.doc_id, r.text) for r in kept.collect())
    texts = {r.doc_id: r.text for r in odd.collect()}
    # Of 4, 5, 6 and the null id that are alike the first; of 9 each text once.
    assert [k[0] for k in rows].count(4) == 1 and texts[4]
    assert not any(k[0] in (5, 6) for k in rows)
    assert sum(n for k, n in rows.items() if k[0] == 9) == 2
    assert sum(n for k, n in rows.items() if k[1] is None or not k[1].strip()) == 4
    assert kept.where("row = 'x' and path = 'p'").count() == kept.count()
    assert SCHEMA.startswith("doc_id")


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (5, 5)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {(r.a, r.b) for r in got} == {(i, 0) for i in range(1, 61)} | {(101, 100), (103, 100)}
