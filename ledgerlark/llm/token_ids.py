"""Exact token ids of whole texts, with each distinct word encoded once."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import compress
from string import punctuation
from unicodedata import normalize

import numpy as np

# So many stretches are looked up at once.
_STEP = 100_000


def _cut(word: str) -> tuple[str, str]:
    """A word and the marks behind it, if their ids are those of the whole.

    Letters end before marks in any case, and A-Z are lower-cased by the library. Where its
    normal form or lower case turns a letter into a letter and a mark, the word stays whole.
    """
    base = word.rstrip(punctuation)
    if not base.isalpha():
        return word, ""
    if base.isascii():
        return base.lower(), word[len(base) :]
    if not normalize("NFC", base).lower().isalpha():
        return word, ""
    return base, word[len(base) :]


@lru_cache(maxsize=1)
def encoder_of(path: str, by_word: bool = True) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs, so that it stays filled."""
    return WordEncoder(path, by_word=by_word)


class _Places(dict):
    """A number for every stretch, in the order in which they are first met."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.fresh.append(word)
        return place


class WordEncoder:
    """Ids of ``tokenizers`` for whole texts.

    No rule of the vocabularies used here reaches across a space or a line end,
    so the ids of a text are those of its stretches between them. A stretch is
    encoded by the library when it is first met and kept in a table of at most
    about ``most`` stretches; when it is full, only those are kept that were looked up in
    more than one step, or none if these are too many. Vocabularies of which
    that does not hold (byte-level ones, where a space belongs to the word behind
    it) take ``by_word=False`` and are encoded text by text.
    """

    def __init__(self, path: str, most: int = 700_000, by_word: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.by_word = most, by_word
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.array(
            [(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)]
        )
        self._clear()

    def _clear(self) -> None:
        self.places = _Places()
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0
        # Where the ids of each stretch start, and how many there are.
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        # In how many steps each was looked up, 2 at most.
        self.met = np.zeros(1 << 16, np.uint8)

    def _forget(self) -> None:
        """Keep the stretches that were looked up in more than one step."""
        again = self.met[: len(self.places)] > 1
        kept = np.flatnonzero(again)
        words, (ids, counts) = list(compress(self.places, again.tolist())), self._gather(kept)
        self._clear()
        if len(kept) > self.most // 2:
            return
        self.places.update(zip(words, range(len(words))))
        self._grow()
        self._add(np.arange(len(words)), ids, counts)
        self.met[: len(words)] = 1

    def _grow(self) -> None:
        """Room for all stretches."""
        while len(self.places) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])

    def _ids(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches, one after the other, and the number of each."""
        ids = self.tokenizer.encode_batch_fast([" ".join(stretches)], add_special_tokens=False)[0].ids
        ids = np.array(ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) == len(stretches):
            return ids, np.diff(ends, prepend=-1)
        found = self.tokenizer.encode_batch_fast(stretches, add_special_tokens=False)
        each = [np.array(e.ids, np.uint32) for e in found]
        return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(i) for i in each])

    def _add(self, places: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[places] = self.used + np.cumsum(counts) - counts
        self.size[places] = counts
        self.used += len(ids)

    def _learn(self) -> None:
        """Ids of all stretches met for the first time."""
        places = self.places
        new, places.fresh = places.fresh, []
        letters, others, joint, parts = [], [], [], []
        for word in new:
            if word.isalpha() and (word.islower() or not word.isascii()):
                letters.append(word)
                continue
            base, tail = _cut(word)
            if tail or base != word:
                joint.append(places[word])
                parts += (places[base], places[tail])
            else:
                others.append(word)
        # Words and marks that were only met as parts.
        for word in places.fresh:
            (letters if word.isalpha() else others).append(word)
        places.fresh = []
        self._grow()
        # Letters alone are one word to the library, so their ids end where a word ends.
        for i in range(0, len(letters), 5000):
            some = letters[i : i + 5000]
            self._add(np.array([places[w] for w in some]), *self._ids(some))
        if others:
            found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            self._add(np.array([places[w] for w in others]),
                      np.concatenate([np.array(e.ids, np.uint32) for e in found]),
                      np.array([len(e.ids) for e in found]))
        if joint:
            ids, n = self._gather(np.array(parts))
            self._add(np.array(joint), ids, n[::2] + n[1::2])

    def _gather(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.size[place]
        ends = np.cumsum(n)
        within = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[place] - ends + n, n)
        return self.flat[within], n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
            ids = [np.array(e.ids, np.uint32) for e in found]
            return (np.concatenate([np.zeros(0, np.uint32), *ids]),
                    np.array([len(i) for i in ids], np.int64))
        parts, counts = [np.zeros(0, np.uint32)], []
        words: list[str] = []
        sizes: list[int] = []
        for text in texts:
            found = text.replace("\n", " ").split(" ")
            words += found
            sizes.append(len(found))
        for i in range(0, len(words), _STEP):
            ids, n = self._encode_words(words[i : i + _STEP])
            parts.append(ids)
            counts.append(n)
        ends = np.cumsum(np.array(sizes, np.int64))
        total = np.concatenate([[0], np.cumsum(np.concatenate(counts or [np.zeros(0, np.int64)]))])
        return np.concatenate(parts), (total[ends] - total[ends - np.array(sizes, np.int64)]).astype(np.int64)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.places) > self.most:
            self._forget()
        found = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        if self.places.fresh:
            self._learn()
        self.met[found] = np.minimum(self.met[found] + np.uint8(1), 2)
        return self._gather(found)
