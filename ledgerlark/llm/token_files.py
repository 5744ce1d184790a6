"""Token ids of a corpus in coded files, in order of the documents, and back.

A file holds whole documents: their ids and sizes, and all their token ids as one
``context_coder`` file. Files are rows of a table in the shared folder, numbered by
the range of document ids they hold and their place in it, so that any store that
Spark writes to will do and each can be read alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.common import range_number, texts_of
from ledgerlark.llm.context_coder import BLOCK, LANES, decode_ids, encode_ids
from ledgerlark.llm.token_ids import encoder_of
from ledgerlark.session import materialise

MAGIC = b"TOKF\x01"
#: Stands for a null document id, and sorts first.
NO_ID = -(2**63)
#: A file is closed behind the document that fills it.
FILE_IDS = BLOCK * LANES


def file_of(doc_ids: list[int], sizes: list[int], ids: np.ndarray, id_bits: int = 16) -> bytes:
    table = np.array([doc_ids, sizes], "<i8").tobytes()
    head = MAGIC + len(doc_ids).to_bytes(8, "little") + table
    return head + zlib.crc32(head).to_bytes(4, "little") + encode_ids(ids, id_bits)


def read_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, sizes and all token ids; a ``ValueError`` if any is damaged."""
    start = len(MAGIC) + 8
    n = int.from_bytes(data[len(MAGIC) : start], "little")
    stop = start + 16 * n
    if data[: len(MAGIC)] != MAGIC or zlib.crc32(data[:stop]) != int.from_bytes(data[stop : stop + 4], "little"):
        raise ValueError("the table of documents is damaged")
    doc_ids, sizes = np.frombuffer(data[start:stop], "<i8").reshape(2, n)
    ids = decode_ids(data[stop + 4 :])
    if int(sizes.sum()) != len(ids):
        raise ValueError("ids are missing")
    return doc_ids, sizes, ids


def write_tokens(
    docs: DataFrame, vocabulary: str, end_id: int = 1, id_bits: int = 16, file_ids: int = FILE_IDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The table of files (``span``, ``file``, ``n_ids``, ``data``) of every whole text's ids.

    ``end_id`` is put behind each document. Documents stand in order of their ids,
    null ids first and rows that share an id by text. Null texts are empty and give
    the end id alone.
    """
    whole = texts_of(docs, id_column, text_column).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), "text"
    )
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = encoder_of(vocabulary), np.array([end_id], np.uint32)
        span, number = None, 0
        doc_ids: list[int] = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []

        def close() -> pd.DataFrame:
            ids = np.concatenate(parts)
            data = file_of(doc_ids, sizes, ids, id_bits)
            return pd.DataFrame({"span": [span], "file": [number], "n_ids": [len(ids)], "data": [data]})

        for frame in frames:
            for lo in range(0, len(frame), 256):
                some = frame.iloc[lo : lo + 256]
                ids, counts = encoder.encode(some.text.tolist())
                at = 0
                for own, doc_id, n in zip(some.span.tolist(), some.place.tolist(), counts.tolist()):
                    if parts and (own != span or sum(sizes) >= file_ids):
                        yield close()
                        number = number + 1 if own == span else 0
                        doc_ids, sizes, parts = [], [], []
                    if own != span:
                        span, number = own, 0
                    doc_ids.append(doc_id)
                    sizes.append(n + 1)
                    parts += (ids[at : at + n], end)
                    at += n
        if parts:
            yield close()

    return materialise(
        whole.withColumn("span", range_number(whole, "place", ranges))
        .repartitionById(ranges, "span").sortWithinPartitions("span", "place", "text")
        .mapInPandas(code, "span int, file int, n_ids bigint, data binary")
    )


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for span, number, data in zip(frame.span, frame.file, frame.data):
            doc_ids, sizes, ids = read_file(data)
            ends = np.cumsum(sizes)
            raw = memoryview(ids.astype("<u4").tobytes())
            yield pd.DataFrame({
                "span": np.int32(span), "file": np.int32(number), "place": doc_ids, "n_tokens": sizes,
                "within": ends - sizes,
                "ids_crc32": [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())],
            })


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone.

    ``start`` counts the ids of all documents before it. Files are counted within
    their range and the ranges, of which there are as many as shuffle partitions,
    among each other.
    """
    rows = files.select("span", "file", "data").mapInPandas(
        _read, "span int, file int, place bigint, n_tokens bigint, within bigint, ids_crc32 bigint"
    )
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    spans = files.groupBy("span").agg(F.sum("n_ids").alias("n")).select(
        "span", F.coalesce(F.sum("n").over(before.orderBy("span")), F.lit(0)).alias("span_start")
    )
    starts = files.select(
        "span", "file",
        F.coalesce(F.sum("n_ids").over(before.partitionBy("span").orderBy("file")), F.lit(0)).alias("file_start"),
    ).join(spans, "span")
    return rows.join(starts, ["span", "file"]).select(
        F.when(F.col("place") != NO_ID, F.col("place")).alias("doc_id"),
        (F.col("span_start") + F.col("file_start") + F.col("within")).alias("start"),
        "n_tokens", "ids_crc32",
    )
