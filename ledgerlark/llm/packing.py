"""Best-fit packing of token pieces under several capacities at once.

Each sequence has a vector of capacities: tokens, number of pieces, and attention
cost (the sum of squared piece lengths). A piece goes to the open sequence that
has room under every one of them and whose residual vector, scaled by the
capacities and weighted, is the smallest behind the piece (``norm``) or points
most like the piece (``dot``). Pieces are placed by decreasing length.

Placing one piece looks at the residuals of a whole group, so the pieces are dealt
out to groups of a fixed size, however many there are, and every group is packed
on its own. A group leaves a sequence or two that others could have filled, out of
some thousand.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import carried, given_back, texts_of
from ledgerlark.llm.token_ids import encoder_of
from ledgerlark.session import materialise

#: Pieces that one task packs together.
GROUP = 4096

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Capacities:
    """What one sequence holds. The defaults of pieces and attention cost are
    those that the tokens imply, so that only tokens bind unless they are set."""

    tokens: int = 2048
    pieces: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"

    def vector(self) -> np.ndarray:
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"no such rule: {self.rule}")
        return np.array(
            [self.tokens, self.pieces or self.tokens, self.attention or self.tokens**2], np.float64
        )


def cut_pieces(
    docs: DataFrame, vocabulary: str, end_id: int = 0, tokens: int = 2048, by_word: bool = True
) -> DataFrame:
    """The pieces of every whole text: its ids with ``end_id`` behind them, and only
    those of more than ``tokens`` ids cut, each piece but the last ``tokens`` long.

    Null and empty texts are one piece of the end id alone. Repeated rows give
    repeated pieces; extra columns are left out.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(vocabulary, by_word)
        for frame in frames:
            for i in range(0, len(frame), 256):
                part = frame.iloc[i : i + 256]
                ids, counts = encoder.encode(part.text.tolist())
                rows, at = [], 0
                for doc_id, n in zip(part.doc_id.tolist(), counts.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    for piece, start in enumerate(range(0, n + 1, tokens)):
                        some = own[start : start + tokens]
                        rows.append((doc_id, piece, start, len(some), zlib.crc32(some.tobytes())))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return given_back(carried(texts_of(docs)).mapInPandas(cut, PIECES))


def best_fit(lengths: np.ndarray, capacities: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece, for lengths in the order of placing.

    A piece over a capacity on its own gets a sequence of its own.
    """
    room = capacities.vector()
    weights = np.array(capacities.weights)
    need = np.stack([lengths, np.ones_like(lengths), lengths.astype(np.float64) ** 2], 1) / room
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = np.zeros(len(lengths) + 1, np.int64)
    residual = np.zeros((256, 3))  # of the open sequences
    label = np.zeros(256, np.int64)
    n_open, n_all = 0, 0
    least = np.minimum.accumulate(need[::-1], 0)[::-1]  # of this piece and all behind it
    for i, want in enumerate(need):
        best = -1
        if n_open:
            left = residual[:n_open] - want
            fits = (left > -1e-12).all(1)
            if capacities.rule == "norm":
                score = (left * left) @ weights
            else:
                score = -(residual[:n_open] @ (weights * want))
            if fits.any():
                best = int(np.where(fits, score, np.inf).argmin())
        if best < 0:
            if n_open == len(label):
                residual = np.concatenate([residual, np.zeros_like(residual)])
                label = np.concatenate([label, np.zeros_like(label)])
            best = n_open
            residual[best], label[best] = 1.0, n_all
            n_open, n_all = n_open + 1, n_all + 1
        sequence[i], offset[i] = label[best], used[label[best]]
        used[label[best]] += lengths[i]
        residual[best] -= want
        if i + 1 < len(need) and (residual[best] < least[i + 1] - 1e-12).any():
            # Nothing that follows fits here.
            n_open -= 1
            residual[best], label[best] = residual[n_open], label[n_open]
    return sequence, offset


def pack(pieces: DataFrame, capacities: Capacities = Capacities(), group: int = GROUP) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of ``pieces`` (see ``cut_pieces``).

    The pieces are written first, so that they are encoded once and every row
    keeps the number by which it is dealt to its group. Numbers of sequences are
    unique, with gaps.
    """
    numbered = materialise(pieces.withColumn("_row", F.monotonically_increasing_id()))
    groups = max(1, -(-numbered.count() // group))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "_row"],
                                  ascending=[False, True, True, True])
        sequence, offset = best_fit(frame.length.to_numpy(), capacities)
        own = frame["_group"].to_numpy().astype(np.int64) << 32
        return frame.assign(sequence_id=own + sequence, offset=offset).drop(columns=["_row", "_group"])

    return given_back(
        carried(numbered).withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
        .groupBy("_group")
        .applyInPandas(place, PIECES + ", sequence_id bigint, offset bigint")
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 0, capacities: Capacities = Capacities()
) -> DataFrame:
    """All documents cut and packed; see ``cut_pieces`` and ``pack``."""
    return pack(cut_pieces(docs, vocabulary, end_id, capacities.tokens), capacities)
