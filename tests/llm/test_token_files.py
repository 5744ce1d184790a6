from __future__ import annotations

import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlark.llm.context_coder import decode_ids, encode_ids
from ledgerlark.llm.queries import vocabulary
from ledgerlark.llm.token_files import file_of, read_file, read_tokens, write_tokens

WORDS = vocabulary()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 65535)), max_size=300), st.integers(1, 40))
def test_round_trip(values, block):
    ids = np.array(values, np.uint32)
    assert (decode_ids(encode_ids(ids, block=block, lanes=5), lanes=3) == ids).all()


def test_wide_ids_and_limits():
    ids = np.array([0, 1, 2**31 - 1, 65536, 7] * 50, np.uint32)
    assert (decode_ids(encode_ids(ids, id_bits=31)) == ids).all()
    with pytest.raises(ValueError):
        encode_ids(ids)


def test_adapts():
    rng = np.random.default_rng(1)
    same = np.tile(rng.integers(0, 49408, 50), 80).astype(np.uint32)
    assert len(encode_ids(same)) < 0.15 * 2 * len(same)
    noise = rng.integers(0, 49408, 4000).astype(np.uint32)
    assert len(encode_ids(noise)) < 1.1 * 2 * len(noise)


def test_order_0_predicts():
    """Ids drawn one by one, so that only how often each is met can be learned."""
    rng = np.random.default_rng(4)
    share = 1 / np.arange(1, 65) ** 2
    share /= share.sum()
    ids = rng.permutation(49408)[:64][rng.choice(64, 30_000, p=share)].astype(np.uint32)
    entropy = -(share * np.log2(share)).sum()
    assert 8 * len(encode_ids(ids, block=3000)) / len(ids) < entropy + 1
    # Rare ids share their upper bits.
    near = (40_000 + rng.integers(0, 128, 8192)).astype(np.uint32)
    data = encode_ids(near)
    assert (decode_ids(data) == near).all()
    assert 8 * len(data) / len(near) < 10.5


@pytest.mark.parametrize("id_bits", [3, 9, 10, 16, 31])
def test_any_width_at_its_worst(id_bits):
    """Ids that always go against what was learned do not outgrow the room kept for them."""
    rng = np.random.default_rng(id_bits)
    top = (1 << id_bits) - 1
    ids = np.where(np.arange(4096) % 256 < 250, 0, rng.integers(0, top + 1, 4096)).astype(np.uint32)
    for values in (ids, rng.integers(0, top + 1, 4096).astype(np.uint32), np.full(4096, top, np.uint32)):
        assert (decode_ids(encode_ids(values, id_bits=id_bits, block=512)) == values).all()


def test_blocks_are_independent():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 300, 1000).astype(np.uint32)
    alone = [encode_ids(ids[i : i + 100], block=100) for i in range(0, 1000, 100)]
    assert (np.concatenate([decode_ids(x) for x in alone]) == ids).all()
    whole = encode_ids(ids, block=100)
    assert all(x[-20:] in whole for x in alone)


def test_time_grows_with_few_steps_an_id():
    """Coding and decoding take a small multiple of sorting the ids, which many steps an id do not."""
    rng = np.random.default_rng(6)
    ids = (49408 * rng.random(1 << 20) ** 3).astype(np.uint32)
    ratios = []
    for _ in range(3):
        begin = time.process_time()
        ids.astype(np.int64).argsort()
        sort = time.process_time() - begin
        begin = time.process_time()
        assert (decode_ids(encode_ids(ids)) == ids).all()
        ratios.append((time.process_time() - begin) / sort)
    assert min(ratios) < 45


@pytest.mark.parametrize("id_bits", [1, 4, 16, 31])
def test_counts_of_any_kind(id_bits):
    """Blocks of one id, of ids that all differ, of ids met twice, and their mixture."""
    top = (1 << id_bits) - 1
    rng = np.random.default_rng(id_bits)
    kinds = [np.zeros(100), np.full(100, top), np.arange(100) % (top + 1), np.arange(100) // 2 % (top + 1),
             rng.integers(0, top + 1, 100), [top]]
    ids = np.concatenate(kinds).astype(np.uint32)
    assert (decode_ids(encode_ids(ids, id_bits=id_bits, block=100)) == ids).all()
    assert (decode_ids(encode_ids(ids, id_bits=id_bits, block=250, lanes=2)) == ids).all()


def test_damage_is_found():
    ids = np.arange(3000, dtype=np.uint32) % 700
    data = file_of([1, 2], [1000, 2000], ids)
    assert (read_file(data)[2] == ids).all()
    for at in (2, 20, 60, 100, len(data) // 2, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            read_file(bytes(broken))
    with pytest.raises(ValueError):
        read_file(data[:-5])


def check(df, rows):
    tokenizer = Tokenizer.from_file(WORDS)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = Counter(), 0
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[doc_id, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert Counter(map(tuple, df.collect())) == want


def test_documents(make):
    texts = [f"Some text {i}, " * (i % 30) for i in range(200)]
    check(read_tokens(write_tokens(make(texts), WORDS)), list(enumerate(texts)))
    check(read_tokens(write_tokens(make(texts), WORDS, file_ids=500)), list(enumerate(texts)))


def test_odd_documents(odd, nothing):
    check(read_tokens(write_tokens(odd, WORDS)), [(r.doc_id, r.text) for r in odd.collect()])
    assert read_tokens(write_tokens(nothing, WORDS)).collect() == []
