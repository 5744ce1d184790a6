"""Benchmark decontamination by winnowing.

The smallest of every ``WINDOW - K + 1`` consecutive hashes of ``K`` words is kept
as a fingerprint, on both sides, so that every shared run of ``WINDOW`` words has a
fingerprint in common. Documents and benchmark meet in a join on the fingerprints;
every hit is extended along its diagonal for as long as the words agree, and a run
counts once it is as long as a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlark.llm.common import carried, chunked, given_back, rolled, texts_of, whole_row, whole_text, word_bounds, word_table

WINDOW = 10
K = 5
#: Up to so many benchmark fingerprints (16 MB) are sent to the tasks, which then
#: give only the fingerprints that can match; more meet all of them in the join.
MAX_SENT = 2_000_000

# Between words: all ASCII but digits and letters.
GAPS = np.ones(256, bool)
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_PRINT = "fp bigint, pos int"


def _ends(n_words: np.ndarray) -> np.ndarray:
    """For each word, where the words of its text end."""
    return np.repeat(np.cumsum(n_words), n_words)


def fingerprints(
    words: np.ndarray, n_words: np.ndarray, short: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of texts and the word that each starts at, counted over all texts.

    Besides the winnowed ones there are all runs of the lengths ``short``, by
    which items of fewer words than a window are found.
    """
    ends = _ends(n_words)
    prints, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    starts = np.flatnonzero(np.arange(len(words)) + WINDOW <= ends)
    if len(starts):
        grams = rolled(words, K)
        view = sliding_window_view(grams, WINDOW - K + 1)[starts]
        # The rightmost of equal ones, as a window that moves on then keeps it.
        kept = np.unique(starts + WINDOW - K - view[:, ::-1].argmin(1))
        prints.append(grams[kept])
        places.append(kept)
    for n in short:
        at = np.flatnonzero(np.arange(len(words)) + n <= ends)
        if len(at):
            prints.append(rolled(words, n)[at] ^ np.uint64(n))
            places.append(at)
    return np.concatenate(prints), np.concatenate(places)


def _item_rows(benchmark: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per distinct item: id, words, and where its fingerprints stand."""
    items = benchmark.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"), whole_text(text_column).alias("text")
    ).distinct()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for item_id, text in zip(frame.item_id, frame.text):
                words, n = word_table([text], GAPS)
                if not len(words):
                    continue
                short = [len(words)] if len(words) < WINDOW else []
                fp, pos = fingerprints(words, n, short)
                rows.append((item_id, words.view(np.int64).tolist(), len(words),
                             fp.view(np.int64).tolist(), pos.tolist()))
            yield pd.DataFrame(rows, columns=["item_id", "words", "n", "fps", "places"])

    return items.mapInPandas(
        cut, "item_id string, words array<bigint>, n int, fps array<bigint>, places array<int>"
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text_column: str = "text",
    max_sent: int = MAX_SENT,
) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    A word is hit inside any occurrence of a window of an item: ``WINDOW``
    consecutive words, or all words of an item that has fewer. Null texts, and
    texts without words, have no windows. Repeated documents are judged row by
    row; repeated items count once per id; item ids are taken as text, and a null one
    counts as the empty id. Extra columns are left out.
    """
    whole = texts_of(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))
    hits = _hits(whole, benchmark, item_column, text_column, max_sent)
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    return given_back(carried(whole.join(hits, same, "left").select("doc_id", "text", "hits")).mapInPandas(
        _extend, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint,"
        " items_sha256 string, contaminated boolean",
    ))


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id",
    text_column: str = "text", max_sent: int = MAX_SENT,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of an item.

    Null and empty texts hold none, so their rows stay; repeated rows stay or go alike.
    """
    whole = texts_of(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))
    found = _hits(whole, benchmark, item_column, text_column, max_sent)
    rows = docs.select(
        whole_row(docs), F.col(id_column).cast("bigint").alias("doc_id"),
        F.xxhash64(whole_text(text_column)).alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    text = F.coalesce(F.col("row").getField(text_column), F.lit(""))
    clean = F.col("hits").isNull() | (_count_hits(text, F.col("hits")) == 0)
    return rows.join(found, same, "left").where(clean).select("row.*")


@F.pandas_udf(LongType())
def _count_hits(texts: pd.Series, hits: pd.Series) -> pd.Series:
    return pd.Series([
        0 if found is None else int(_marked(text, found)[0].sum()) for text, found in zip(texts, hits)
    ], dtype="int64")


def _hits(
    whole: DataFrame, benchmark: DataFrame, item_column: str, text_column: str, max_sent: int
) -> DataFrame:
    """Of each document that shares a fingerprint: the items, and on which diagonals."""
    items = _item_rows(benchmark, item_column, text_column).persist()
    short = sorted(r.n for r in items.where(F.col("n") < WINDOW).select("n").distinct().collect())
    marks = items.select("item_id", "words", F.explode(F.arrays_zip("fps", "places")).alias("m"))
    marks = marks.select("item_id", "words", F.col("m.fps").alias("fp"),
                         F.col("m.places").alias("item_pos"))
    wanted = [r.fp for r in marks.select("fp").distinct().limit(max_sent + 1).collect()]
    sent = np.sort(np.array(wanted, np.int64)) if len(wanted) <= max_sent else None

    def prints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in chunked(frame):
                words, n = word_table(part.text.tolist(), GAPS)
                fp, at = fingerprints(words, n, short)
                fp = fp.view(np.int64)
                if sent is not None:
                    near = np.searchsorted(sent, fp)
                    kept = near < len(sent)
                    kept[kept] = sent[near[kept]] == fp[kept]
                    fp, at = fp[kept], at[kept]
                firsts = np.cumsum(n) - n
                owner = np.searchsorted(np.cumsum(n), at, side="right")
                yield pd.DataFrame({
                    "doc_id": part.doc_id.to_numpy()[owner], "text_hash": part.text_hash.to_numpy()[owner],
                    "fp": fp, "pos": (at - firsts[owner]).astype(np.int32),
                })

    # A document is its id and text, so that rows that share an id stay apart.
    return given_back(
        carried(whole).mapInPandas(prints, f"doc_id bigint, text_hash bigint, {_PRINT}")
        .join(marks.select("fp", "item_id", "words", "item_pos"), "fp")
        .groupBy("doc_id", "text_hash", "item_id", "words")
        .agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("diagonals"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("item_id", "words", "diagonals")).alias("hits"))
    ).withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})


def _extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    nothing = hashlib.sha256(b"").hexdigest()
    for frame in frames:
        for part in chunked(frame):
            n_words = word_bounds(part.text.tolist(), GAPS)[3]
            n_hit = np.zeros(len(part), np.int64)
            n_items = np.zeros(len(part), np.int64)
            digest = [nothing] * len(part)
            for i, (text, hits) in enumerate(zip(part.text, part.hits)):
                if hits is None:
                    continue
                hit, found = _marked(text, hits)
                n_hit[i], n_items[i] = hit.sum(), len(found)
                digest[i] = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            yield pd.DataFrame({"doc_id": part.doc_id, "n_words": n_words, "n_hit": n_hit,
                                "n_items": n_items, "items_sha256": digest, "contaminated": n_hit > 0})


def _marked(text: str, hits: list) -> tuple[np.ndarray, set[str]]:
    """Which words are hit, and the items that hit them."""
    words = word_table([text], GAPS)[0]
    hit, found = np.zeros(len(words), bool), set()
    for item in hits:
        if _mark(words, item, hit):
            found.add(item["item_id"])
    return hit, found


def _mark(words: np.ndarray, item: dict, hit: np.ndarray) -> bool:
    """Mark the words of all runs that reach a window; whether there is one."""
    own = np.array(item["words"], np.int64).view(np.uint64)
    need, any_run = min(WINDOW, len(own)), False
    for diagonal in item["diagonals"]:
        lo, hi = max(0, diagonal), min(len(words), diagonal + len(own))
        same = np.concatenate([[False], words[lo:hi] == own[lo - diagonal : hi - diagonal], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= need:
                hit[lo + a : lo + b] = True
                any_run = True
    return any_run

