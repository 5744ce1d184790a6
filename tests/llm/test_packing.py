from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerlark.llm.packing import Capacities, best_fit, cut_pieces, pack, pack_documents
from ledgerlark.llm.queries import vocabulary
from ledgerlark.llm.token_ids import WordEncoder

WORDS = vocabulary()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def test_ids_are_those_of_the_library(tokenizer):
    rng = random.Random(5)
    odd = "ab <|>endoftxt\n\t'é́Ǆ1２ 漢Σ.,!\x1c "
    texts = ["", " ", "a<|endoftext|>b <|startoftext|>", "don't 'll x's", "İstanbul ΣΑΣ", "foo.. bar!? (baz)",
             "ÉCOLE école école."] + ["".join(rng.choice(odd) for _ in range(200)) for _ in range(200)]
    for most in (700_000, 400):
        encoder = WordEncoder(WORDS, most=most)
        for lo in range(0, len(texts), 20):
            ids, counts = encoder.encode(texts[lo : lo + 20])
            want = [e.ids for e in tokenizer.encode_batch(texts[lo : lo + 20], add_special_tokens=False)]
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


@pytest.mark.parametrize("capacities", [
    Capacities(100), Capacities(100, pieces=3), Capacities(100, attention=2000),
    Capacities(100, pieces=4, attention=3000, weights=(1, 1, 1), rule="dot"),
])
def test_no_capacity_is_exceeded(capacities):
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 60, 400))[::-1].copy()
    sequence, offset = best_fit(lengths, capacities)
    room = capacities.vector()
    for s in range(sequence.max() + 1):
        own = lengths[sequence == s]
        if len(own) > 1:
            assert (np.array([own.sum(), len(own), (own**2).sum()]) <= room).all()
        assert (np.sort(offset[sequence == s]) == np.sort(np.cumsum(own) - own)).all()
    if capacities.pieces is None and capacities.attention is None:
        assert sequence.max() + 1 <= np.ceil(lengths.sum() / 100) + 1


def test_unknown_rule():
    with pytest.raises(ValueError):
        best_fit(np.array([1]), Capacities(10, rule="first"))


def check(df, rows, tokenizer, tokens):
    want = Counter()
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), tokens)):
            part = ids[start : start + tokens]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    got = df.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= tokens
    return len(places)


def test_documents(make, tokenizer):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["word", "Token", "überall", "12"]) for _ in range(rng.randrange(200)))
             for _ in range(150)]
    df = pack_documents(make(texts), WORDS, capacities=Capacities(128))
    n = check(df, list(enumerate(texts)), tokenizer, 128)
    total = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    assert n <= -(-total // 128) + 2


def test_many_groups(make, tokenizer):
    texts = ["word " * (i % 50) for i in range(120)]
    pieces = cut_pieces(make(texts), WORDS, tokens=64)
    check(pack(pieces, Capacities(64), group=16), list(enumerate(texts)), tokenizer, 64)


def test_odd_documents(odd, nothing, tokenizer):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(pack_documents(odd, WORDS), rows, tokenizer, 2048)
    assert pack_documents(nothing, WORDS).collect() == []
