from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import zstandard

from ledgerlark.llm.suffix_dedup import HOT, LoserTree, decode_run, encode_run, regions, remove_repeats, united
from ledgerlark.llm.suffix_dedup import _number_of_parts as number_of_parts
from ledgerlark.llm.suffix_dedup import _runs as make_runs


def brute(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in raw for p in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def corpus(seed, letters):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice(letters) for _ in range(n))

    passages = [noise(n) for n in (19, 20, 21, 30, 45, 80, 200)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += [noise(rng.randrange(30)), p[a:] if rng.random() < 0.5 else p]
        texts.append("".join(parts))
    return [*texts, texts[0], texts[1], "ab" * 60, "a" * 90, "é" * 15, ""]


@pytest.mark.parametrize("seed, letters, hot", [
    (1, "ab", HOT), (2, "abcdefghijklmnopqrst", HOT), (3, "aé漢😀", HOT), (4, "abcdefgh", 1), (1, "ab", 0),
])
def test_equals_brute_force(make, seed, letters, hot):
    texts = corpus(seed, letters)
    got = remove_repeats(make(texts), length=20, gram=8, hot=hot)
    assert Counter(map(tuple, got.collect())) == brute(enumerate(texts), 20)


def test_production_length(make):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    line = noise(199)
    passage = noise(420)
    texts = [noise(300) + passage + noise(100), passage[50:300] + noise(30), line + noise(9), noise(9) + line,
             passage[:200] + "x" + passage[200:], noise(100), passage * 2]
    got = remove_repeats(make(texts))
    assert Counter(map(tuple, got.collect())) == brute(enumerate(texts), 200)


def hot_frame(text: bytes, copies: int) -> pd.DataFrame:
    """Copies of a text whose anchors are all frequent."""
    found = [r for r in regions(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]), 20, 8)]
    codes = np.concatenate([((s << 16) | ((e - s) << 8) | (a - s)) * 2 + 1 for _, _, s, e, a in found])
    return pd.DataFrame({"place": range(copies), "mark": 1, "regions": [codes] * copies,
                         "packed": [zstandard.ZstdCompressor().compress(text)] * copies})


def test_a_run_gives_on_one_occurrence_of_a_frequent_string():
    text = bytes(random.Random(4).randbytes(300))
    out = pd.concat(list(make_runs(4, 20, 8)(iter([hot_frame(text, 400)]))))
    strings = Counter()
    for run in out.run.dropna():
        for _, right, sides in decode_run(run):
            for left, refs in sides:
                strings[left + right] += 1
                assert len(refs) <= 1
    assert strings == Counter(text[p : p + 20] for p in range(281))
    ranges = out[out.part < 0]
    assert Counter(ranges.place) == Counter(range(400)) and set(ranges.span) == {300}


@pytest.mark.parametrize("copies, fan", [(40, 2), (40, 64), (3, 2), (1, 2)])
def test_frequent_strings_meet_in_rounds(make, copies, fan):
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared, once = noise(150), [noise(60) for _ in range(12)]
    texts = [shared] * copies + [noise(5) + shared[20:90] + noise(9), *once, *(t[10:45] for t in once[:6])]
    got = remove_repeats(make(texts), length=20, gram=8, hot=0, fan=fan)
    assert Counter(map(tuple, got.collect())) == brute(enumerate(texts), 20)


def test_parts_grow_with_the_regions(spark, make):
    anchors = spark.createDataFrame([(1, 900), (2, 100)], "h bigint, n bigint")
    least = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert number_of_parts(anchors, 200, 64, 336 * 1000) == least
    assert number_of_parts(anchors, 200, 64, 336) == 1000
    assert number_of_parts(anchors.limit(0), 200, 64, 336) == least
    texts = corpus(5, "abcd")
    got = remove_repeats(make(texts), length=20, gram=8, part_bytes=64)
    assert Counter(map(tuple, got.collect())) == brute(enumerate(texts), 20)


def test_at_least_two_runs_meet(make):
    with pytest.raises(ValueError):
        remove_repeats(make(["x"]), fan=1)


def test_odd_documents(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(map(tuple, remove_repeats(odd).collect())) == brute(rows, 200)
    assert remove_repeats(nothing).collect() == []


def test_gram_must_fit(make):
    with pytest.raises(ValueError):
        remove_repeats(make(["x"]), gram=60)


def test_regions_cover_every_string_once():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, n, dtype=np.uint8)) for n in (0, 10, 20, 500, 0, 21, 3000, 19)]
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    seen = Counter()
    for h, own, s, e, a in regions(data, np.cumsum(size) - size, size, 20, 8):
        for t, x, y, z in zip(own, s, e, a):
            assert x <= z and y <= z <= x + 12 and z + 8 <= y + 20 or y <= z
            for p in range(x, y + 1):
                assert p <= z and z + 8 <= p + 20
                seen[int(t), p] += 1
    assert seen == Counter((t, p) for t, b in enumerate(texts) for p in range(len(b) - 19))


def test_loser_tree_gives_the_order_and_the_common_prefixes():
    rng = random.Random(2)
    for runs in (0, 1, 2, 5, 8):
        lists = [{bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))): {b"": [(1, 2, 3)]}
                  for _ in range(rng.randrange(20))} for _ in range(runs)]
        merged = list(LoserTree([decode_run(encode_run(x)) for x in lists]))
        strings = [s for _, s, _ in merged]
        assert strings == sorted(s for x in lists for s in x)
        for (_, before, _), (shared, here, _) in zip(merged, merged[1:]):
            want = 0
            while want < min(len(before), len(here)) and before[want] == here[want]:
                want += 1
            assert shared == want


def test_ranges_that_touch_are_one():
    starts, ends = united(np.array([5, 0, 3, 20]), np.array([9, 3, 4, 25]))
    assert list(zip(starts, ends)) == [(0, 4), (5, 9), (20, 25)]
