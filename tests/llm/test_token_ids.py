from __future__ import annotations

import random
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from ledgerlark.llm.queries import vocabulary
from ledgerlark.llm.token_ids import WordEncoder


def letters() -> list[str]:
    """Letters that decompose, or that grow in lower case, and some that do neither."""
    odd = [chr(c) for c in range(0xC0, 0x2000) if chr(c).isalpha()
           and (len(unicodedata.normalize("NFD", chr(c))) > 1 or len(chr(c).lower()) > 1)]
    odd += [chr(c) for c in (0x958, 0x959, 0x95C, 0x9DC, 0xFB2A, 0xFB2C, 0xFB31, 0x130, 0x1E9E, 0x3A3, 0x212B)]
    return odd + list("abcXYZéÉ漢한") * 20


def test_ids_of_letters_that_change_under_normal_forms():
    path = vocabulary("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), WordEncoder(path)
    rng = random.Random(8)
    some, marks = letters(), ".,<!'\"-: \n"
    texts = ["İ.", "İ<", "BİLGİ.", "क़.", "אשׁ.", "İ İ. İ.İ"]
    texts += ["".join(rng.choice(some) if rng.random() < 0.7 else rng.choice(marks) for _ in range(rng.randrange(1, 30)))
              for _ in range(10_000)]
    for lo in range(0, len(texts), 500):
        part = texts[lo : lo + 500]
        ids, counts = encoder.encode(part)
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_words_met_again_are_kept():
    """A full table keeps what was looked up more than once, and ids stay those of the library."""
    path = vocabulary("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), WordEncoder(path, most=200)
    rng = random.Random(9)
    often = ["the", "House,", "élan", "x1", "Öl!", "of"]
    for i in range(60):
        texts = [" ".join(often + ["".join(rng.choices("abcdeé", k=6)) for _ in range(20)]) + "." for _ in range(2)]
        ids, counts = encoder.encode(texts)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        assert len(encoder.places) < 400
        assert i == 0 or all(word in encoder.places for word in often)
    encoder.places.fresh.clear()
    before = len(encoder.places)
    encoder._forget()
    assert set(often) <= set(encoder.places) and len(encoder.places) < before
