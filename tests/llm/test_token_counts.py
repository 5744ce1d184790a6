from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from ledgerlark.llm import token_counts
from ledgerlark.llm.queries import vocabulary
from ledgerlark.llm.token_counts import Cutter, chunks, count_tokens, cutter_of, packed, unpacked

BYTES = vocabulary("byte_bpe_50k.json")
BIG = 1 << 60


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    some = "ab don't 'll x's\n\t  \r\x1c\x1f\x85\xa0.,!<|>12é漢ẞİ 　\U0001f600ՠ\U00016e40ⅷ"
    return ["".join(rng.choice(some) for _ in range(rng.randrange(120))) for _ in range(n)]


def test_counts_are_those_of_the_library(library):
    cutter = Cutter(BYTES)
    texts = random_texts(3000, 1) + [
        "", " ", "\n\n", "a<|endoftext|> b<|endoftext|>", "<|endoftext|", "word " * 50, "  a   b", "x" * 3000,
    ]
    table = dict(zip([" word", "a", " "], cutter.lengths([" word", "a", " "])))
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [cutter.count(t, table) for t in texts] == want
    assert [cutter.count(t, {}) for t in texts] == want


def test_every_letter_and_digit(library):
    """One text per block of characters, those of a later Unicode than the library's included."""
    cutter = Cutter(BYTES)
    blocks = ["".join(f"a{c}b 1{c}2 .{c}, {c}" for c in map(chr, range(at, at + 64)))
              for at in [*range(0, 0x3100, 64), *range(0xA700, 0xAC00, 64), *range(0x1E900, 0x1EF00, 64)]]
    want = [len(e.ids) for e in library.encode_batch(blocks, add_special_tokens=False)]
    assert [cutter.count(t, {}) for t in blocks] == want


def test_pieces_of_a_long_text(library, monkeypatch):
    for text in [*random_texts(50, 3), "a b  c\n\nd " * 40, "x" * 900, " " * 700 + "x"]:
        parts = list(chunks(text, 20))
        assert "".join(parts) == text
        assert [t for p in parts for t in token_counts.CUT.findall(p)] == token_counts.CUT.findall(text)


def test_a_full_cache_starts_again(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 3)
    monkeypatch.setattr(token_counts, "CACHE_CHARS", 4)
    cutter = Cutter(BYTES)
    texts = random_texts(200, 4)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [cutter.count(t, {}) for t in texts] == want


def test_the_table_goes_and_returns():
    words = [" the", "\n", "é漢", " "]
    assert unpacked(packed(words, [1, 2, 3, 4])) == dict(zip(words, [1, 2, 3, 4]))
    assert unpacked(packed([], [])) == {}


def check(df, rows, library, limit=1024):
    want = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > limit))
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_odd_documents(odd, nothing, library):
    check(count_tokens(odd, BYTES), [(r.doc_id, r.text) for r in odd.collect()], library)
    assert count_tokens(nothing, BYTES).collect() == []


@pytest.mark.parametrize("sample, size", [(0, 10), (5, 10), (1000, 100_000)])
def test_the_table_decides_speed_alone(make, library, sample, size):
    texts = random_texts(120, 5) + ["the same words again"] * 60
    df = count_tokens(make(texts), BYTES, limit=30, sample=sample, size=size)
    check(df, list(enumerate(texts)), library, 30)


def test_large_ids_beside_a_null(spark, library):
    rows = [(None, "a b"), (BIG + 1, "c"), (BIG + 3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    check(count_tokens(docs, BYTES), rows, library)


def test_no_pretoken_of_the_corpus_is_shuffled(make):
    plan = count_tokens(make(["a b c"] * 50).coalesce(2), BYTES)
    assert "Aggregate" not in plan._jdf.queryExecution().toString()
    assert cutter_of(BYTES) is cutter_of(BYTES)
