"""Text quality by a byte-level convolutional network in numpy.

The filters look at ``WIDTH`` bytes every ``STRIDE`` bytes of the whole text. Their
responses are max-pooled over blocks, and over chunks of ``CHUNK`` blocks that
overlap by one block; the pooled responses of all chunks, their mean and their
greatest, are combined into one probability.

A filter over bytes is a sum of one table row for each byte it sees, so a forward
pass is ``WIDTH`` table look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import carried, chunked, given_back, texts_of
from ledgerlark.llm.labelled import PER_LABEL, fold_of, sample, trained

WIDTH, STRIDE, FILTERS = 8, 2, 16
#: Filter positions in a block, and blocks in a chunk; chunks start every CHUNK - 1 blocks.
BLOCK, CHUNK = 32, 4
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
SEED = 4

_BYTES = BLOCK * STRIDE


def laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each padded with zeros to whole chunks, and the chunks
    of each. A filter that reaches beyond a text's last block only sees the zeros that
    every text starts with, never bytes of two texts."""
    parts, n_chunks = [], []
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        blocks = -(-(len(raw) + WIDTH) // _BYTES)
        chunks = max(1, -(-(blocks - 1) // (CHUNK - 1)))
        size = ((CHUNK - 1) * chunks + 1) * _BYTES
        parts.append(bytes(WIDTH) + raw + bytes(size - WIDTH - len(raw)))
        n_chunks.append(chunks)
    return (np.frombuffer(b"".join([*parts, bytes(WIDTH)]), np.uint8),
            np.array(n_chunks, np.int64))


class ByteNet:
    """The network: filter tables, filter biases, and the weights behind the pooling."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.tables = rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def responses(self, data: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Filter responses at the positions of blocks ``lo`` to ``hi``."""
        first, n = lo * _BYTES, (hi - lo) * BLOCK
        out = None
        for w in range(WIDTH):
            rows = self.tables[w][data[first + w : first + w + STRIDE * n : STRIDE]]
            out = rows if out is None else np.add(out, rows, out=out)
        return out.reshape(hi - lo, BLOCK, FILTERS)

    def chunk_starts(self, n_chunks: np.ndarray) -> np.ndarray:
        """The first block of every chunk."""
        blocks = (CHUNK - 1) * n_chunks + 1
        first = np.cumsum(blocks) - blocks
        within = np.arange(n_chunks.sum()) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
        return np.repeat(first, n_chunks) + (CHUNK - 1) * within

    def pooled(self, data: np.ndarray, n_chunks: np.ndarray) -> np.ndarray:
        """Filter responses of every chunk, max-pooled."""
        total = int(((CHUNK - 1) * n_chunks + 1).sum())
        blocks = np.concatenate(
            [self.responses(data, lo, min(lo + 512, total)).max(1) for lo in range(0, total, 512)]
        )
        start = self.chunk_starts(n_chunks)
        best = blocks[start]
        for i in range(1, CHUNK):
            np.maximum(best, blocks[start + i], out=best)
        return np.maximum(best + self.bias, 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        data, n_chunks = laid_out(texts)
        pooled = self.pooled(data, n_chunks)
        start = np.cumsum(n_chunks) - n_chunks
        mean = np.add.reduceat(pooled, start) / n_chunks[:, None]
        most = np.maximum.reduceat(pooled, start)
        features = np.concatenate([mean, most], 1).astype(np.float64)
        logit = (features * self.out).sum(1) + self.shift[0]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def gradients(self, texts: list[str], labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean logistic loss over a batch, for each of the parameters."""
        data, n_chunks = laid_out(texts)
        start = self.chunk_starts(n_chunks)
        total = int(((CHUNK - 1) * n_chunks + 1).sum())
        at = np.empty((total, FILTERS), np.uint8)  # position in each block
        blocks = np.empty((total, FILTERS), self.tables.dtype)
        for lo in range(0, total, 512):
            responses = self.responses(data, lo, min(lo + 512, total))
            at[lo : lo + 512] = best_at = responses.argmax(1)
            blocks[lo : lo + 512] = np.take_along_axis(responses, best_at[:, None], 1)[:, 0]
        stacked = np.stack([blocks[start + i] for i in range(CHUNK)])
        which = stacked.argmax(0)
        pooled = np.maximum(stacked.max(0) + self.bias, 0)
        doc = np.repeat(np.arange(len(texts)), n_chunks)
        first = np.cumsum(n_chunks) - n_chunks
        mean = np.add.reduceat(pooled, first) / n_chunks[:, None]
        most = np.maximum.reduceat(pooled, first)
        features = np.concatenate([mean, most], 1)
        p = 1 / (1 + np.exp(-np.clip(features @ self.out + self.shift[0], -30, 30)))
        delta = ((p - labels) / len(texts)).astype(np.float32)
        d_features = delta[:, None] * self.out
        d_pooled = (d_features[:, :FILTERS] / n_chunks[:, None])[doc]
        best = pooled == most[doc]
        d_pooled += d_features[doc, FILTERS:] * best / np.add.reduceat(best, first, dtype=np.int64)[doc]
        d_pooled *= pooled > 0
        # Each pooled response comes from one position, and so from WIDTH table rows.
        block = start[:, None] + which
        position = (block * BLOCK + at[block, np.arange(FILTERS)]) * STRIDE
        d_tables = np.zeros(self.tables.size, np.float64)
        filters = np.arange(FILTERS)
        for w in range(WIDTH):
            cell = (w * 256 + data[position + w].astype(np.int64)) * FILTERS + filters
            d_tables += np.bincount(cell.ravel(), d_pooled.ravel(), minlength=self.tables.size)
        return [d_tables.reshape(self.tables.shape).astype(np.float32), d_pooled.sum(0),
                (delta @ features).astype(np.float32), np.array([delta.sum()], np.float32)]


def fit(texts: list[str], labels: list[int], epochs: int = 24, least_steps: int = 600,
        batch: int = 64, rate: float = 0.01, seed: int = SEED) -> ByteNet:
    """A network trained by Adam. Both labels weigh as they do in the sample; without
    rows, or with one label alone, the network gives nearly that label's share."""
    net = ByteNet(seed)
    y = np.array(labels, np.float32)
    net.shift[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if len(set(labels)) < 2:
        net.out[:] = 0
        return net
    rng = np.random.default_rng(seed)
    state = [net.tables, net.bias, net.out, net.shift]
    first = [np.zeros_like(p) for p in state]
    second = [np.zeros_like(p) for p in state]
    batches = -(-len(y) // batch)
    epochs = max(epochs, -(-least_steps // batches))
    step, steps = 0, epochs * batches
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            rows = order[lo : lo + batch]
            # Where a text shows its label is not known, so it is seen whole.
            some = [texts[i] for i in rows]
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for p, g, m, v in zip(state, net.gradients(some, y[rows]), first, second):
                m += 0.1 * (g - m)
                v += 0.005 * (g * g - v)
                p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-6)
    return net


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """held_out, score and predicted of every document.

    The network is trained on at most ``per_label`` labelled documents of each label
    that are not held out, and scores every whole text. Null texts count as empty,
    and empty ones get a score as well; repeated rows get equal scores; extra
    columns are left out.
    """
    net = trained(sample(docs, labels, label, fold_of("doc_id", FOLDS) != HELD_OUT, per_label), fit)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in chunked(frame):
                yield pd.DataFrame({
                    "doc_id": part.doc_id, "held_out": part.held_out,
                    "score": net.scores(part.text.tolist()),
                })

    rows = carried(texts_of(docs).withColumn("held_out", fold_of("doc_id", FOLDS) == HELD_OUT))
    scored = rows.mapInPandas(score, "doc_id bigint, held_out boolean, score double")
    return given_back(scored).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
