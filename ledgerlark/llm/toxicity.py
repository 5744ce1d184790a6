"""Toxicity by a bidirectional gated recurrent network with attention, in numpy.

A word goes in as an embedding of its hash and as the mean of the embeddings of its
runs of three characters. A text is cut into windows of ``WINDOW`` words that start every
``HOP`` words, so that neighbours overlap and every word is inside one. Over each
window one recurrent pass runs forward and one backward, attention pools their
states, and a linear layer gives the window's logit. The most toxic window decides a
text; in training, too, each text learns through the window that is its most toxic
so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerlark.llm.common import carried, chunked, given_back, mixed, texts_of, whole_text, word_bounds
from ledgerlark.llm.labelled import fold_of, sample, trained

WINDOW, HOP = 48, 36
HIDDEN, WORD_DIM, GRAM_DIM = 8, 8, 8
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << 12
#: Documents of each label that the network is trained on, at most.
PER_LABEL = 3000
#: Words of fewer sample texts are known by their characters alone.
LEAST_TEXTS = 8
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
SEED = 7

# Between words: all ASCII but digits and letters.
GAPS = np.ones(256, bool)
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Words:
    """The words of some texts as table rows, and the windows over them."""

    def __init__(self, texts: list[str]):
        buffer, start, end, n = word_bounds(texts, GAPS)
        self.n_texts = len(texts)
        lower = buffer + np.uint8(32) * ((buffer >= 65) & (buffer <= 90))
        lower[GAPS[buffer]] = 0
        # Each word's bytes and one byte behind, which stands for its end.
        size = end - start + 1
        self.first = np.cumsum(size) - size
        self.size = size
        inside = np.arange(int(size.sum())) + np.repeat(start - self.first, size)
        place = np.arange(len(inside)) - np.repeat(self.first, size)
        here = lower[inside].astype(np.int32)
        two = (lower[np.maximum(inside - 2, 0)] * (place > 0)).astype(np.int32)
        self.grams = (two * 7919 + lower[inside - 1] * np.int32(271) + here) % GRAM_ROWS
        code = mixed((place.astype(np.uint64) << np.uint64(8)) + here.astype(np.uint64) + np.uint64(1))
        hashes = np.add.reduceat(code, self.first) if len(start) else np.zeros(0, np.uint64)
        self.rows = (mixed(hashes) % np.uint64(WORD_ROWS)).astype(np.int64)
        # Windows: the words of each, -1 behind the last word of a text.
        count = np.maximum(1, -(-(n - WINDOW) // HOP) + 1)
        self.text_of = np.repeat(np.arange(len(n)), count)
        self.n_windows = count
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        begin = (np.cumsum(n) - n)[self.text_of] + nth * HOP
        stop = np.cumsum(n)[self.text_of]
        index = begin[:, None] + np.arange(WINDOW)
        self.windows = np.where(index < stop[:, None], index, -1)

    def only(self, windows: np.ndarray) -> Words:
        """The words of these windows alone, which become its windows."""
        used, place = np.unique(windows, return_inverse=True)
        place = place.reshape(windows.shape)
        spare = int(len(used) > 0 and used[0] < 0)
        used = used[spare:]
        few = object.__new__(Words)
        few.n_texts, few.windows = self.n_texts, place - spare
        few.rows, few.size = self.rows[used], self.size[used]
        few.first = np.cumsum(few.size) - few.size
        inside = np.arange(int(few.size.sum())) + np.repeat(self.first[used] - few.first, few.size)
        few.grams = self.grams[inside]
        return few


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGru:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)

        def weights(*shape):
            return rng.normal(0, (1 / shape[-2]) ** 0.5, shape).astype(np.float32)

        self.p = {
            "words": rng.normal(0, 0.1, (WORD_ROWS, WORD_DIM)).astype(np.float32),
            "grams": rng.normal(0, 0.3, (GRAM_ROWS, GRAM_DIM)).astype(np.float32),
            "input": weights(2, WORD_DIM + GRAM_DIM, 3 * HIDDEN),
            "again": weights(2, HIDDEN, 3 * HIDDEN),
            "bias": np.zeros((2, 3 * HIDDEN), np.float32),
            "look": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
            "out": rng.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
            "shift": np.zeros(1, np.float32),
        }

    def inputs(self, words: Words) -> np.ndarray:
        """One row per word, and a last row of zeros for the places behind a text."""
        x = np.zeros((len(words.rows) + 1, WORD_DIM + GRAM_DIM), np.float32)
        if len(words.rows):
            x[:-1, :WORD_DIM] = self.p["words"][words.rows]
            for lo in range(0, len(words.rows), 20_000):
                hi = min(lo + 20_000, len(words.rows))
                a, b = words.first[lo], words.first[hi - 1] + words.size[hi - 1]
                sums = np.add.reduceat(self.p["grams"][words.grams[a:b]], words.first[lo:hi] - a)
                x[lo:hi, WORD_DIM:] = sums / words.size[lo:hi, None]
        return x

    def run(self, x: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of the windows; with ``keep`` also what the way back needs."""
        steps = windows.T
        full = (steps >= 0).astype(np.float32)[:, :, None]
        states = np.empty((WINDOW, len(windows), 2 * HIDDEN), np.float32)
        kept = []
        for d in (0, 1):
            fed = x @ self.p["input"][d] + self.p["bias"][d]
            again, h = self.p["again"][d], np.zeros((len(windows), HIDDEN), np.float32)
            order = range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1)
            side = slice(d * HIDDEN, (d + 1) * HIDDEN)
            for t in order:
                a, g = fed[steps[t]], h @ again
                gates = _sigmoid(a[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(a[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                if keep:
                    kept.append((d, t, h, z, r, new, g[:, 2 * HIDDEN :]))
                h = (new + z * (h - new)) * full[t]
                states[t, :, side] = h
        score = states @ self.p["look"]
        score[full[:, :, 0] == 0] = -30.0
        weight = np.exp(score - score.max(0)) * full[:, :, 0]
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.p["out"] + self.p["shift"][0]
        return (logits, states, weight, pooled, kept, full) if keep else logits

    def text_logits(self, texts: list[str]) -> np.ndarray:
        """The logit of each text's most toxic window; all windows are scored."""
        words = Words(texts)
        logits = self.window_logits(self.inputs(words), words.windows)
        return np.maximum.reduceat(logits, np.cumsum(words.n_windows) - words.n_windows)

    def window_logits(self, x: np.ndarray, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.run(x, windows[lo : lo + 4096]) for lo in range(0, len(windows), 4096)])

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.text_logits(texts).astype(np.float64), -30, 30)))

    def gradients(self, words: Words, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of each text through its most toxic window.

        All windows are scored, some at a time; the way back is held for one a text.
        """
        logits = self.window_logits(self.inputs(words), words.windows)
        order = np.lexsort((-logits, words.text_of))
        starts = np.cumsum(words.n_windows) - words.n_windows
        words = words.only(words.windows[order[starts]])
        x, windows = self.inputs(words), words.windows
        logits, states, weight, pooled, kept, full = self.run(x, windows, keep=True)
        p = self.p
        delta = ((_sigmoid(logits) - labels) / len(labels)).astype(np.float32)
        grad = {name: np.zeros_like(value) for name, value in p.items()}
        grad["out"], grad["shift"] = delta @ pooled, np.array([delta.sum()], np.float32)
        d_pooled = delta[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        toward = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (toward - (weight * toward).sum(0))
        grad["look"] = np.einsum("tn,tnh->h", d_score, states)
        d_states += d_score[:, :, None] * p["look"]
        d_fed = [np.zeros((len(x), 3 * HIDDEN), np.float32) for _ in (0, 1)]
        carry, last = None, None
        for d, t, h, z, r, new, again_new in reversed(kept):
            if d != last:
                carry, last = np.zeros_like(h), d
            side = slice(d * HIDDEN, (d + 1) * HIDDEN)
            dh = (carry + d_states[t, :, side]) * full[t]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (h - new) * z * (1 - z)
            d_r = d_new * again_new * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_new], 1)
            d_g = np.concatenate([d_z, d_r, d_new * r], 1)
            grad["again"][d] += h.T @ d_g
            carry = dh * z + d_g @ p["again"][d].T
            # One window per text, so no word stands twice in a step.
            d_fed[d][windows[:, t]] += d_a
        d_x = np.zeros_like(x)
        for d in (0, 1):
            d_fed[d][-1] = 0
            grad["input"][d] = x.T @ d_fed[d]
            grad["bias"][d] = d_fed[d].sum(0)
            d_x += d_fed[d] @ p["input"][d].T
        for i in range(WORD_DIM):
            grad["words"][:, i] = np.bincount(words.rows, d_x[:-1, i], minlength=WORD_ROWS)
        per_gram = np.repeat(d_x[:-1, WORD_DIM:] / words.size[:, None], words.size, axis=0)
        for i in range(GRAM_DIM):
            grad["grams"][:, i] = np.bincount(words.grams, per_gram[:, i], minlength=GRAM_ROWS)
        return grad


def _log_odds(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word row, how much likelier a text with it is labelled 1, and whether
    enough texts have it for it to be learned at all."""
    seen = np.zeros((2, WORD_ROWS))
    for text, label in zip(texts, labels):
        seen[int(label), np.unique(Words([text]).rows)] += 1
    n = np.bincount(labels.astype(int), minlength=2) + 1.0
    odds = np.log((seen[1] + 0.5) / n[1]) - np.log((seen[0] + 0.5) / n[0])
    return odds.astype(np.float32), seen.sum(0) >= LEAST_TEXTS


def fit(texts: list[str], labels: list[int], epochs: int = 8, least_steps: int = 300,
        batch: int = 48, rate: float = 0.01, seed: int = SEED) -> BiGru:
    """A network trained by Adam. The first number of each word's embedding starts as
    its log odds in the sample. Without rows, or with one label alone, the network
    gives nearly that label's share."""
    net = BiGru(seed)
    y = np.array(labels, np.float32)
    net.p["shift"][0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if len(set(labels)) < 2:
        net.p["out"][:] = 0
        return net
    odds, known = _log_odds(texts, y)
    net.p["words"][:, 0] = 0.5 * odds
    net.p["words"][~known] = 0
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    batches = -(-len(y) // batch)
    epochs = max(epochs, -(-least_steps // batches))
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            rows = order[lo : lo + batch]
            # Where a text is toxic is not known, so all of it is seen.
            grad = net.gradients(Words([texts[i] for i in rows]), y[rows])
            grad["words"][~known] = 0
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for name, value in net.p.items():
                g, m, v = grad[name], first[name], second[name]
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                value -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-6)
    return net


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """held_out, score and predicted of every document.

    The network is trained on at most ``per_label`` labelled documents of each label
    that are not held out, and scores all windows of every whole text. Null texts
    count as empty; a text without words has one empty window. Repeated rows get
    equal scores; extra columns are left out.
    """
    net = learned(docs, labels, label, per_label)
    score = scorer(net)
    rows = carried(texts_of(docs).withColumn("held_out", fold_of("doc_id", FOLDS) == HELD_OUT))
    scored = rows.mapInPandas(score, "doc_id bigint, held_out boolean, score double")
    return given_back(scored).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def learned(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL
) -> BiGru:
    """The network of a bounded sample of the rows that are not held out."""
    rows = sample(docs, labels, label, fold_of("doc_id", FOLDS) != HELD_OUT, per_label)
    return trained(rows, fit)


def scorer(net: BiGru):
    """A function for ``mapInPandas`` that replaces ``text`` by ``score``."""

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in chunked(frame):
                yield part.drop(columns="text").assign(score=net.scores(part.text.tolist()))

    return score


def keep_clean(
    docs: DataFrame, labels: DataFrame, text_column: str = "text", per_label: int = PER_LABEL,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic.

    Null texts are scored as empty ones, and repeated rows stay or go alike.
    """
    net = learned(docs, labels, per_label=per_label)

    def score(texts: pd.Series) -> pd.Series:
        parts = [net.scores(part.text.tolist()) for part in chunked(pd.DataFrame({"text": texts}))]
        return pd.Series(np.concatenate([np.zeros(0), *parts]))

    found = F.pandas_udf(score, DoubleType())(whole_text(text_column))
    return docs.where(found < threshold)
