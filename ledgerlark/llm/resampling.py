"""Importance resampling of documents towards a target distribution.

Features are single words and pairs of neighbouring words, hashed into buckets by
CRC-32. The buckets of all documents and of all target texts give each bucket a gain, the
logarithm of its target share over its source share, and a document's weight is the mean
gain of its features. A fixed random number per document turns weights into scores whose
highest are a draw without replacement (Gumbel top-k).

The draw sorts by regular sampling. Every partition is sorted where it lies; rows at
regular places of these runs give the splitters; each run is cut at the splitters, and
segments are exchanged and merged; the numbers of rows ahead of a segment make local
places exact ranks. Segments that lie behind the draw are counted and not exchanged.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.common import whole_text
from ledgerlark.session import materialise

BUCKETS = 10_000
LEAST_WORDS = 20
#: Rows of a segment, about, and regular samples per segment that the driver sorts.
SEGMENT_ROWS = 1_000_000
SAMPLES = 64

# Words longer than this are hashed one by one.
_SHORT = 63
# Bytes that are looked at together.
_SLICE = 1 << 20

_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x41:0x5B] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of one more byte, and, for n up to ``_SHORT``, of n more zero bytes (by the four
    bytes of the value that is shifted)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    step = step.astype(np.uint32)
    zeros = np.zeros((_SHORT + 1, 4, 256), np.uint32)
    for k in range(4):
        zeros[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, _SHORT + 1):
        zeros[n] = step[zeros[n - 1] & 255] ^ (zeros[n - 1] >> np.uint32(8))
    return step, zeros


_STEP, _ZEROS = _crc_tables()
_BLANK = np.uint32(zlib.crc32(b" "))


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each value as if ``n`` zero bytes followed."""
    return (_ZEROS[n, 0, crc & 255] ^ _ZEROS[n, 1, (crc >> np.uint32(8)) & 255]
            ^ _ZEROS[n, 2, (crc >> np.uint32(16)) & 255] ^ _ZEROS[n, 3, crc >> np.uint32(24)])


def _word_crcs(lower: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of every word, byte by byte over all words that are that long."""
    by_size = np.argsort(-size, kind="stable")
    at, left = start[by_size], size[by_size]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for j in range(min(int(left[0]), _SHORT) if len(left) else 0):
        n = int(np.searchsorted(-left, -j, side="left"))  # words with more than j bytes
        crc[:n] = _STEP[(crc[:n] ^ lower[at[:n] + j]) & 255] ^ (crc[:n] >> np.uint32(8))
    out = np.empty_like(crc)
    out[by_size] = ~crc
    for i in np.flatnonzero(size > _SHORT):
        out[i] = zlib.crc32(lower[start[i] : start[i] + size[i]].tobytes())
    return out


def _pair_crcs(lower, start, size, crc, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each word behind the word of CRC ``before`` and a blank."""
    ahead = _shifted(before, np.ones(len(before), np.int64)) ^ _BLANK
    out = _shifted(ahead, np.minimum(size, _SHORT)) ^ crc
    for i in np.flatnonzero(size > _SHORT):
        out[i] = zlib.crc32(lower[start[i] : start[i] + size[i]].tobytes(), int(ahead[i]))
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column without nulls, and where each text starts (and the last ends)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def features(buffer: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple]:
    """Buckets of all features of all texts, slice by slice, and the text of each; also the texts
    of the words alone.

    A slice ends where no word goes on, so words stay whole; the word ahead of a slice
    is carried into it. Memory follows the slice, or one word if that is longer.
    """
    lo, n = 0, len(buffer)
    last_crc, last_text = np.uint32(0), -1
    while lo < n:
        hi = min(lo + _SLICE, n)
        while hi < n and _IN_WORD[buffer[hi - 1]]:
            gap = np.flatnonzero(~_IN_WORD[buffer[hi : hi + _SLICE]])
            ends = int(offsets[np.searchsorted(offsets, hi)])  # of the text
            found = hi + int(gap[0]) + 1 if len(gap) else min(hi + _SLICE, n)
            hi = min(found, ends)
            if hi == ends:
                break
        lower = _LOWER[buffer[lo:hi]]
        inside = _IN_WORD[lower]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        starts = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi)] - lo
        first[starts] = inside[starts]
        starts = starts[starts > 0]
        last[starts - 1] = inside[starts - 1]
        start = np.flatnonzero(first)
        size = np.flatnonzero(last) + 1 - start
        if len(start):
            text = np.searchsorted(offsets, start + lo, side="right") - 1
            crc = _word_crcs(lower, start, size)
            before = np.concatenate([[last_crc], crc[:-1]]).astype(np.uint32)
            paired = np.flatnonzero(np.concatenate([[last_text], text[:-1]]) == text)
            pair = _pair_crcs(lower, start[paired], size[paired], crc[paired], before[paired])
            last_crc, last_text = crc[-1], text[-1]
            found = np.concatenate([crc, pair]) % np.uint32(buckets)
            yield found.astype(np.int64), np.concatenate([text, text[paired]]), text
        lo = hi


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over a column ``text`` without nulls; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found, _, _ in features(*text_buffer(batch.column("text")), buckets):
                total += np.bincount(found, minlength=buckets)
        bucket = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(total[bucket])], names=["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for row in (
        texts.select("text").mapInArrow(count, "bucket bigint, n bigint")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    ):
        total[row.bucket] = row.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the logarithm of each bucket's smoothed target share over its source share."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


WEIGHTS = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """Words, features and the floored mean gain of every row of ``docs`` (doc_id, text)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n_words, n_features, total = (np.zeros(rows, np.int64) for _ in range(3))
            for found, text, of_words in features(*text_buffer(batch.column("text")), len(gain)):
                n_words += np.bincount(of_words, minlength=rows)
                n_features += np.bincount(text, minlength=rows)
                # Whole numbers below 2**53 in a slice, so the doubles are exact.
                total += np.bincount(text, weights=gain[found], minlength=rows).astype(np.int64)
            mean = total // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, (n_words, n_features, mean))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.select("doc_id", "text").mapInArrow(weigh, WEIGHTS)


def _order() -> list:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]


def _key(score: int, doc_id: int | None, row: int) -> tuple:
    """What ``_order`` sorts by, as a tuple that sorts upwards."""
    return -score, doc_id is None, doc_id or 0, row


def _with(df: DataFrame, name: str) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])


def ranked(rows: DataFrame, share: float | int = 25, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``rows`` (doc_id, score, a unique ``row`` and more) with ``rank``, 1 for the highest score.

    Only the highest ``share`` per cent, rounded down, have a rank. ``rows`` must be a
    written table: it is read twice. Equal scores go by the smaller id, null ids last,
    and equal ids by ``row``, so that a key of any size falls into several segments.
    """
    n = rows.count()
    take = math.floor(share * n / 100)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // segment_rows))
    stride = max(1, n // (SAMPLES * parts))
    runs = rows.sortWithinPartitions(*_order())

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            regular = np.arange((stride // 2 - place) % stride, batch.num_rows, stride)
            place += batch.num_rows
            yield batch.take(pa.array(regular))

    names = ["score", "doc_id", "row"]
    found = runs.select(*names).mapInArrow(sample, "score bigint, doc_id bigint, row bigint").collect()
    found = sorted(_key(*sampled) for sampled in found)
    splitters = sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segment of every row: a run is sorted, so a batch is cut at the splitters within it."""
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            columns = [batch.column(name) for name in names]

            def key(i: int) -> tuple:
                return _key(*(column[i].as_py() for column in columns))

            first = bisect.bisect_left(splitters, key(0))
            last = bisect.bisect_left(splitters, key(size - 1))
            ends = [bisect.bisect_right(range(size), splitters[s], key=key) for s in range(first, last)]
            segment = np.repeat(np.arange(first, last + 1), np.diff([0, *ends, size]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment)], names=[*batch.schema.names, "segment"])

    segments = materialise(runs.mapInArrow(cut, _with(rows, "segment")))
    sizes = dict(segments.groupBy("segment").count().collect())
    ahead, upto = {}, 0
    for segment in sorted(sizes):
        if upto >= take:
            break
        ahead[segment] = upto
        upto += sizes[segment]
    drawn = max(ahead, default=-1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ranks of merged segments: the rows ahead of the segment and the place in it."""
        now, at = -1, 0
        for batch in batches:
            segment = batch.column("segment").to_numpy()
            starts = np.flatnonzero(np.diff(segment, prepend=now))
            rank = np.arange(1, len(segment) + 1) + at
            for i in starts.tolist():
                rank[i:] = np.arange(1, len(segment) - i + 1) + ahead[int(segment[i])]
            if len(segment):
                now, at = int(segment[-1]), int(rank[-1])
            inside = pa.array(rank, mask=rank > take)
            yield pa.RecordBatch.from_arrays([*batch.columns, inside], names=[*batch.schema.names, "rank"])

    merged = (
        segments.where(F.col("segment") <= drawn)
        .repartition(drawn + 1 if drawn >= 0 else 1, "segment")
        .sortWithinPartitions("segment", *_order())
        .mapInArrow(place, _with(segments, "rank"))
    )
    behind = segments.where(F.col("segment") > drawn).withColumn("rank", F.lit(None).cast("bigint"))
    return merged.unionByName(behind).drop("segment")


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: float | int = 25,
    seed: int = 7,
    least_words: int = LEAST_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``.

    The highest ``share`` per cent of the documents with at least ``least_words`` words
    are drawn; the others have no rank. Null and empty texts, and texts without words, have no
    feature and weigh 0; null ids share the random number of an empty id and come last among
    equal scores. Repeated rows are drawn one by one, in any order where they are wholly
    alike. An empty table gives none, and an empty target is a target without words. Extra
    columns are left out whatever their names.
    """
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), whole_text(text_column).alias("text"))
    gain = gains(bucket_counts(texts), bucket_counts(target.select(whole_text(target_column).alias("text"))))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    # Written once: the rows are numbered here, and ranked from the table.
    weighed = materialise(
        weights(texts, gain)
        .withColumn("score", (F.col("weight") + noise).cast("bigint"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    able = ranked(weighed.where(F.col("n_words") >= least_words), share)
    rest = weighed.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return able.select(*columns).unionByName(rest.select(*columns))
