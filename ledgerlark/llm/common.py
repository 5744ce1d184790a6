"""Small pieces that several text operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def whole_text(column: str | Column = "text") -> Column:
    """The text as it is; a null text counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so that extra columns never clash or travel."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), whole_text(text_column).alias("text")
    )


#: What stands for a null id where rows pass through pandas, which would turn a column of
#: whole numbers with a null in it into floating point and round large ids.
NO_ID = -(1 << 63)


def carried(rows: DataFrame, column: str = "doc_id") -> DataFrame:
    """``rows`` with ids that pass through pandas as whole numbers; see ``given_back``."""
    return rows.withColumn(column, F.coalesce(column, F.lit(NO_ID)))


def given_back(rows: DataFrame, column: str = "doc_id") -> DataFrame:
    """``rows`` with the null ids that ``carried`` replaced."""
    return rows.withColumn(column, F.nullif(F.col(column), F.lit(NO_ID)))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, ``row``, so that their names meet no others."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each value."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x = x ^ (x >> _S33)
    x = x * _M2
    return x ^ (x >> _S33)


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` well-spread 64-bit numbers that depend only on ``seed``."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.uint64(seed))


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of true values."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def chunked(frame, chars: int = 1_000_000):
    """Slices of a pandas frame with about so many characters of ``text`` each."""
    sizes = frame.text.str.len().to_numpy()
    group = (np.cumsum(sizes) - sizes) // chars
    cuts = np.flatnonzero(np.diff(group)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(frame)]):
        if hi > lo:
            yield frame.iloc[lo:hi]


def word_bounds(
    texts: list[str], is_gap: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where words start and end in them, and words per text.

    ``is_gap`` marks the 256 byte values that separate words; words never cross
    texts.
    """
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    gap = bytes([int(np.flatnonzero(is_gap)[0])])
    buffer = np.frombuffer(gap.join([b"", *encoded, b""]), dtype=np.uint8)
    inside = ~is_gap[buffer]
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    ends_of_texts = np.cumsum(np.array([len(t) + 1 for t in encoded], dtype=np.int64))
    before = np.concatenate([[0], np.searchsorted(start, ends_of_texts, side="right")])
    return buffer, start, end, np.diff(before)


def word_table(texts: list[str], is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as 64-bit hashes of their A-Z lower-cased bytes, and the
    number of words of each text; see ``word_bounds``."""
    buffer, start, end, n_words = word_bounds(texts, is_gap)
    hashes = np.zeros(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + (1 << 20))))
        a, b = int(start[lo]), int(end[hi - 1])
        part = buffer[a:b]
        first = start[lo:hi] - a
        lower = part + np.uint8(32) * ((part >= 65) & (part <= 90))
        place = np.arange(b - a) - np.repeat(first, np.diff(np.append(first, b - a)))
        # The sum of mixed (place in word, byte) pairs makes one 64-bit hash.
        code = mixed(((place.astype(np.uint64) + np.uint64(1)) << np.uint64(8)) | lower)
        code[is_gap[part]] = 0
        hashes[lo:hi] = mixed(np.add.reduceat(code, first))
        lo = hi
    return hashes, n_words


def rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values, in order; shorter inputs give none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
        return mixed(out)


def range_number(df: DataFrame, column: str, ranges: int) -> Column:
    """For each value of a bigint column, the number of its range, ascending.

    The cuts are quantiles, so the ranges hold about as many rows each; a value
    is never in two of them.
    """
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(column, shares, 20 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col(column)))
