from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from ledgerlark.llm.fingerprint import Sampler, edited, fingerprints, likeness


def similarity(a, b):
    def weights(text):
        words = text.lower().split()
        return Counter(zip(words, words[1:]))

    x, y = weights(a), weights(b)
    keys = set(x) | set(y)
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys)


@pytest.mark.parametrize("n, size", [(300, 5000), (300, 12), (2000, 40), (60, 3)])
def test_collision_rate_is_the_weighted_similarity(n, size):
    rng = np.random.default_rng(n + size)
    words = [f"w{i}" for i in rng.integers(0, size, n)]
    other = words[: 2 * n // 3] + [f"w{i}" for i in rng.integers(0, size, n // 3)]
    a, b = " ".join(words), " ".join(other)
    signs = Sampler(samples=3000).sign([a, b])
    assert abs(likeness(signs[:1], signs[1:])[0] - similarity(a, b)) < 0.04


def test_equal_texts_and_texts_without_words():
    signs = Sampler().sign(["a b c", "", "  ", "A B  c", "a", "b"])
    assert (signs[0] == signs[3]).all() and (signs[1] == signs[2]).all()
    assert likeness(signs[:1], signs[1:2])[0] == 0 and likeness(signs[4:5], signs[5:6])[0] < 0.2


def check(df, rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), r[1] or ""))
    texts = [t or "" for _, t in order]
    following = texts[1:] + texts[:1]
    want = Counter(
        (i, len(t), hashlib.sha256(edited(t, f).encode()).hexdigest())
        for (i, _), t, f in zip(order, texts, following)
    )
    got = df.collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    sampler = Sampler()
    near = {}
    for (i, _), t, f in zip(order, texts, following):
        x = sampler.sign([t, edited(t, f), f])
        near.setdefault((i, len(t)), set()).add((likeness(x[:1], x[1:2])[0], likeness(x[:1], x[2:])[0]))
    assert all((r.near_edited, r.near_next) in near[r.doc_id, r.n_chars] for r in got)


def test_follows_descending_ids(make):
    texts = [f"text {i} " * (i % 40) for i in range(300)]
    check(fingerprints(make(texts)), list(enumerate(texts)))


def test_odd_documents(odd):
    check(fingerprints(odd), [(r.doc_id, r.text) for r in odd.collect()])


def test_one_document_and_none(make, nothing):
    one = fingerprints(make(["only one text"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints(nothing).collect() == []


@pytest.mark.parametrize("n, seeds", [(2_000, 12), (200_000, 3)])
def test_rate_is_the_generalised_jaccard_similarity(n, seeds):
    """Weighted terms, in texts that have far more of them than any table has rows."""
    found = []
    for seed in range(seeds):
        words = [f"w{seed}x{i}" for i in range(n)]
        text, heavier = " ".join(words), " ".join([*words, *words[: n // 5] * 4])
        sampler = Sampler(64 if n < 10_000 else 256, seed)
        found.append(likeness(sampler.sign([text]), sampler.sign([heavier]))[0])
    # n pairs of words against n with a fifth of them five times.
    assert abs(np.mean(found) - 1 / 1.8) < 0.03
