from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from ledgerlark.llm import ball_codes
from ledgerlark.llm.ball_codes import balls_of, compress, nearest, reassign, vector_codes, with_label_errors

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error int, moved string, vector int, codes int"
BIG = 1 << 60


def plain(rows, parts, entries, rounds):
    """The same by loops over every entry, in Python's whole numbers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def place(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [place(p, c[p])[1] for c in cut]
            new = []
            for e, entry in enumerate(books[p]):
                mine = [c[p] for c, o in zip(cut, own) if o == e]
                new.append([sum(col) // len(mine) for col in zip(*mine)] if mine else entry)
            books[p] = new
    out = []
    for row, c in zip(kept, cut):
        found = [place(p, c[p]) for p in range(parts)]
        out.append((row[0], row[2], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


def vectors(n, length, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (12, length))
    values = (centres[rng.integers(0, 12, n)] + rng.normal(0, spread / 4, (n, length))).astype(np.float32)
    return [(i, v.tolist(), int(i % 5) if i % 7 else None) for i, v in enumerate(values)]


def odd_rows():
    rows = vectors(60, 32, 1)
    same = [0.5] * 32
    rows += [(100 + i, same, 9) for i in range(40)] + [rows[3], rows[3]]
    rows += [(1, None, 1), (2, [1.0] * 31 + [None], 1), (3, [float("nan")] + [0.0] * 31, 1),
             (4, [float("inf")] + [0.0] * 31, 2), (5, [], 1), (6, [0.1] * 16, 1), (7, [0.1] * 5, 1),
             (None, [0.25] * 32, None), (None, [0.2] * 32, 3), (BIG + 1, [0.3] * 32, 1), (BIG + 3, [0.7] * 32, 1),
             (8, [1e30] + [0.0] * 31, 4)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "m", 2, 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("n, length, spread, rounds", [(400, 32, 0.2, 2), (300, 64, 0.01, 3), (90, 16, 40.0, 0), (20, 32, 0.5, 2)])
def test_codes_are_those_of_plain_loops(spark, n, length, spread, rounds):
    rows = vectors(n, length, 3, spread)
    codes = compress(frame(spark, rows).repartition(5), rounds=rounds)
    want, books = plain(rows, 16, 64, rounds)
    assert sorted(map(tuple, codes.rows.collect()), key=repr) == sorted(want, key=repr)
    assert codes.codebooks.tolist() == books


def test_skipping_loses_nothing():
    rng = np.random.default_rng(5)
    for length, reach in [(1, 3), (2, 5), (4, 30), (4, 1 << 26)]:
        centre = rng.integers(-reach, reach + 1, (1, 24, length))
        centre[0, 5] = centre[0, 17]  # two entries in one place
        part = rng.integers(-reach, reach + 1, (500, length))
        was, far = nearest(part, rng.permutation(centre[0]))
        radius = np.zeros((1, 24), np.int64)
        np.maximum.at(radius[0], was, ((part - centre[0][was]) ** 2).sum(1))
        got = reassign(part, was, balls_of(centre, radius), 0)
        apart = ((part[:, None].astype(object) - centre[0][None].astype(object)) ** 2).sum(-1)
        assert got[0].tolist() == [min(range(24), key=lambda e: (row[e], e)) for row in apart]
        assert got[1].tolist() == apart.min(1).tolist()


def test_stable_cores_and_rings_skip():
    """Parts close to their entry are compared with no other."""
    centre = np.array([[[0, 0], [100, 0], [1000, 0]]])
    part = np.array([[1, 1], [49, 0], [60, 0], [990, 0]])
    own = np.array([0, 0, 0, 2])
    balls = balls_of(centre, np.array([[3600, 0, 100]]))
    assert balls.far[0, 0, 0] == 10_000 and balls.far[0, 0, 1] == np.iinfo(np.int64).max
    assert balls.far[0, 2, 0] == np.iinfo(np.int64).max
    assert reassign(part, own, balls, 0)[0].tolist() == [0, 0, 1, 2]


def test_odd_vectors(spark, monkeypatch):
    rows = odd_rows()
    kept = [r for r in rows if r[1] is not None and len(r[1]) == 32 and r[0] not in (2, 3, 4) or r[0] in (2, 3, 4)]
    held = [(i, [min(x, 262144.0) if x is not None and x == x and x != float("inf") else x for x in v], l)
            for i, v, l in kept if v is not None and len(v) == 32]
    want, books = plain(held, 16, 64, 2)
    sums: dict = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    want = sorted(((i, c, e, sums[l], digest) for i, l, c, e in want), key=repr)
    for few in (100_000, 0):
        monkeypatch.setattr(ball_codes, "SENT_LABELS", few)
        got = vector_codes(frame(spark, rows).repartition(3)).collect()
        assert sorted(map(tuple, got), key=repr) == want


def test_no_vectors(spark):
    assert vector_codes(frame(spark, [])).collect() == []
    assert vector_codes(frame(spark, [(1, None, 1), (2, [0.5] * 5, 2)])).collect() == []


def test_a_label_may_hold_nearly_all(spark):
    rows = spark.createDataFrame([(i, 1 if i % 10 else None, "00", i) for i in range(1000)],
                                 "vec_id bigint, label int, code string, error bigint")
    got = {(r.label, r.label_error) for r in with_label_errors(rows).collect()}
    assert got == {(1, sum(i for i in range(1000) if i % 10)), (None, sum(range(0, 1000, 10)))}


def test_entries_fit_a_byte(spark):
    with pytest.raises(ValueError):
        compress(frame(spark, []), entries=257)
