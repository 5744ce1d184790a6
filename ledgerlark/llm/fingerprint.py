"""Document fingerprints by consistent weighted sampling.

A text is a set of weighted terms: its runs of ``SHINGLE`` words, each with the
number of times it occurs. Every one of the ``samples`` draws one term so that the
chance of a heavier one is larger and two texts draw the same (term, level) with
the probability of their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger. The draw is the one of improved consistent
weighted sampling: for a term of weight w, with r and c from Gamma(2, 1) and b
uniform, all fixed by term and sample,

    t = floor(ln w / r + b),   ln a = ln c - r (t - b) - r,

and the term with the least ln a is drawn, at level t.

The triples (r, c, b) come from one table that depends on the seed alone; a hash of
term and sample chooses the row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import given_back, mixed, range_number, rolled, seeds, texts_of, word_table

SAMPLES = 64
SHINGLE = 2
SEED = 9
#: Values of the table of exponentials, picked by 16 bits of a hash each.
TABLE = 1 << 16
#: Terms whose draws are made at once.
BLOCK = 1 << 14
#: Characters worked on at once.
STEP = 1_000_000

# Words stand between the ASCII white space.
GAPS = np.zeros(256, bool)
GAPS[[9, 10, 11, 12, 13, 32]] = True


class Sampler:
    def __init__(self, samples: int = SAMPLES, seed: int = SEED, shingle: int = SHINGLE):
        self.samples, self.shingle = samples, shingle
        self.exponential = -np.log((np.arange(TABLE) + 0.5) / TABLE).astype(np.float32)
        mix = seeds(4 * samples, seed + 1).astype(np.uint32).reshape(4, samples)
        self.xor, self.odd = mix[0], mix[1] | np.uint32(1)
        self.xor_c, self.odd_c = mix[2], mix[3] | np.uint32(1)

    def _draws(self, term: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, ln c and b of each term in the ``k``-th sample, from the term's whole hash.

        The sum of two exponentials is Gamma(2, 1), and each exponential has 16 bits of
        its own, so no two of even many millions of terms need share their draws. In a long
        text the least value comes from a very large r, so the last step of the table goes
        on with 16 more bits: behind any point an exponential starts anew.
        """
        x = self._mixed(term, self.xor[k], self.odd[k])
        y = self._mixed(term, self.xor_c[k], self.odd_c[k])
        low, high = np.uint32(0xFFFF), np.uint32(16)
        one, two = x & low, x >> high
        r = self.exponential[one] + self.exponential[two]
        for step, shift in ((one, np.uint32(0)), (two, high)):
            if np.count_nonzero(step) == len(step):
                continue
            at = np.flatnonzero(step == 0)
            more = self._mixed(y[at], self.odd[k], self.odd_c[k]) >> shift & low
            r[at] += np.float32(np.log(TABLE)) + self.exponential[more] - self.exponential[0]
        log_c = np.log(self.exponential[y & low] + self.exponential[y >> high])
        b = ((x * np.uint32(0x9E3779B1)) ^ y) * np.uint32(0xC2B2AE3D)
        return r, log_c, (b >> np.uint32(8)).astype(np.float32) * np.float32(2.0**-24)

    @staticmethod
    def _mixed(term: np.ndarray, xor: np.uint32, odd: np.uint32) -> np.ndarray:
        x = (term ^ xor) * odd
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        return x ^ (x >> np.uint32(16))

    @staticmethod
    def _place(log_a: np.ndarray) -> np.ndarray:
        """ln a in 32 bits, in the same order."""
        bits = log_a.astype(np.float32).view(np.uint32)
        return bits ^ ((bits.view(np.int32) >> 31).view(np.uint32) | np.uint32(1 << 31))

    def terms(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct terms of each text as 32-bit hashes, their weights, and where
        the terms of each text start. A text of fewer words than a shingle is one
        term; one without words has the term 0."""
        words, n = word_table(texts, GAPS)
        first = np.cumsum(n) - n
        grams = rolled(words, self.shingle)
        count = np.maximum(n - self.shingle + 1, 1)
        owner = np.repeat(np.arange(len(texts)), count)
        start = np.cumsum(count) - count
        hashes = np.zeros(len(owner), np.uint64)
        full = n >= self.shingle
        inside = np.repeat(full, count)
        within = np.arange(len(owner)) - np.repeat(start, count)
        hashes[inside] = grams[(np.repeat(first, count) + within)[inside]]
        for i in np.flatnonzero(~full & (n > 0)):
            with np.errstate(over="ignore"):
                hashes[start[i]] = mixed(words[first[i] : first[i] + n[i]] + np.uint64(1)).sum()
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        # Sorted by text and hash; equal neighbours are one heavier term.
        key = np.sort((owner.astype(np.uint64) << np.uint64(32)) | short)
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        weight = np.diff(np.append(at, len(key)))
        starts = np.searchsorted(key[at] >> np.uint64(32), np.arange(len(texts), dtype=np.uint64))
        return key[at].astype(np.uint32), weight, starts

    def sign(self, texts: list[str]) -> np.ndarray:
        """The signatures, one row of 16-bit draws per text."""
        out = np.zeros((len(texts), self.samples), np.uint16)
        if not texts:
            return out
        term, weight, starts = self.terms(texts)
        heavy = np.flatnonzero(weight > 1)
        log_w = np.log(weight[heavy]).astype(np.float32)
        # Blocks of terms whose draws stay in the processor's cache.
        blocks = [(lo, min(lo + BLOCK, len(term))) for lo in range(0, len(term), BLOCK)]
        cuts = np.searchsorted(heavy, [lo for lo, _ in blocks] + [len(term)])
        key = np.empty(len(term), np.uint64)
        # Little-endian halves of each key: the place above, the draw below.
        draw, place = key.view(np.uint32)[::2], key.view(np.uint32)[1::2]
        for k in range(self.samples):
            draw[:] = term
            for (lo, hi), first, last in zip(blocks, cuts, cuts[1:]):
                r, log_c, b = self._draws(term[lo:hi], k)
                place[lo:hi] = self._place(log_c - r * (1 - b))
                if first < last:
                    some = heavy[first:last]
                    r, log_c, b = r[some - lo], log_c[some - lo], b[some - lo]
                    t = np.floor(log_w[first:last] / r + b)
                    place[some] = self._place(log_c - r * (t - b) - r)
                    draw[some] += (t.astype(np.int64) * 0x9E3779B1).astype(np.uint32)
            least = np.minimum.reduceat(key, starts)
            out[:, k] = mixed(least & np.uint64(0xFFFFFFFF)) >> np.uint64(48)
        return out


def as_text(signature: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in signature]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal draws, the estimate of the similarity."""
    return (a == b).mean(axis=1, dtype=np.float64)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much from the start of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _in_order(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows cut by descending id into ranges, each with the first row of the next.

    The cuts are quantiles of the ids, some for each shuffle partition, so the
    texts are shuffled once and no task holds more than it streams. A row that a
    range borrows from the next has ``borrowed`` set.
    """
    whole = texts_of(docs, id_column, text_column).withColumn(
        "place", F.coalesce("doc_id", F.lit(-(2**63)))
    )
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = whole.withColumn("span", range_number(whole, "place", n))
    tops = {r.span: r.top for r in ranged.groupBy("span").agg(F.max("place").alias("top")).collect()}
    order = sorted(tops, reverse=True)
    # One row for each range: the place that follows its last.
    follows = [(a, tops[b]) for a, b in zip(order, [*order[1:], *order[:1]])]
    bridge = docs.sparkSession.createDataFrame(follows, "into int, place long")
    borrowed = (
        whole.join(F.broadcast(bridge), "place")
        .groupBy("into", "place")
        .agg(F.min("text").alias("text"))
        .select("text", "place", F.col("into").alias("span"), F.lit(True).alias("borrowed"))
    )
    return (
        ranged.drop("doc_id").withColumn("borrowed", F.lit(False)).unionByName(borrowed)
        .repartition("span")
        .sortWithinPartitions("span", "borrowed", F.desc("place"), "text")
        .select("span", "borrowed", "place", "text")
    )


def fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    samples: int = SAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they are.

    ``near_edited`` compares a text with its edited one, ``near_next`` with the
    next document by descending id; the first follows the last. Null texts count
    as empty; null ids come last; rows that share an id are ordered by text, so
    repeated rows follow each other. Texts without words are alike to each other
    alone. Extra columns are left out.
    """

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler(samples, seed)
        held: list[tuple] = []
        size = 0

        def flush() -> pd.DataFrame:
            own = [i for i in range(len(held) - 1)
                   if not held[i][1] and held[i][0] == held[i + 1][0]]
            changed = [edited(held[i][3], held[i + 1][3]) for i in own]
            signs = sampler.sign([row[3] for row in held])
            again = sampler.sign(changed)
            here, after = signs[own], signs[[i + 1 for i in own]]
            return pd.DataFrame({
                "doc_id": [held[i][2] for i in own],
                "n_chars": [len(held[i][3]) for i in own],
                "edited_sha256": [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed],
                "fingerprint": as_text(here), "edited_fingerprint": as_text(again),
                "near_edited": likeness(here, again), "near_next": likeness(here, after),
            })

        for frame in frames:
            for span, borrowed, place, text in zip(frame.span, frame.borrowed, frame.place, frame.text):
                held.append((span, borrowed, place, text))
                size += len(text)
                if size >= STEP and len(held) > 1:
                    yield flush()
                    held = held[-1:]
                    size = len(text)
        if len(held) > 1:
            yield flush()

    return given_back(_in_order(docs, id_column, text_column).mapInPandas(
        sign, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    ))
