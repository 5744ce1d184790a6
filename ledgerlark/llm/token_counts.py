"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A byte-level vocabulary cuts a text into pre-tokens (a word with the blank ahead of
it, a run of digits, of marks, or of white space) and splits each on its own, so a
text has as many tokens as its pre-tokens have together. The first tier is a table of
the most frequent pre-tokens and their lengths, sent to all tasks; the second is a cache
of each worker, filled by the library with what the table lacks. The corpus is counted
where it is read: no pre-token of it is ever shuffled.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import whole_text

#: Documents, about, that are looked through for frequent pre-tokens. The table decides
#: how fast a count is, never what it is.
SAMPLE = 4000
#: Pre-tokens in the table, none longer than ``TABLE_CHARS``: a few MB at most.
TABLE = 32_768
TABLE_CHARS = 64
#: Pre-tokens that a worker keeps before its cache starts again, and their longest.
CACHE = 500_000
CACHE_CHARS = 256

#: White space as byte-level vocabularies see it (fixed values).
SPACE = "\t-\r \x85\xa0" + "".join(
    f"{chr(first)}-{chr(last)}"
    for first, last in [(0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
                        (0x205F, 0x205F), (0x3000, 0x3000)]
)
#: How byte-level vocabularies cut (fixed values).
CUT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
_SAFE = regex.compile(rf"(?<=[^{SPACE}])[{SPACE}]")
_LETTER, _DIGIT, _BLANK = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(f"[{SPACE}]")
_CHUNK = 1 << 18

COUNTS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


class Cutter:
    """Pre-tokens and token counts of one byte-level vocabulary of ``tokenizers``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.agrees: dict[str, bool] = {}
        self.seen: dict[str, int] = {}

    def _agree(self, char: str) -> bool:
        """Whether the library puts ``char`` in the class that ``CUT`` puts it in: the two
        may know different versions of Unicode."""
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        if len(cut(f"a{char}a")) == 1:
            found = _LETTER
        elif len(cut(f"1{char}1")) == 1:
            found = _DIGIT
        elif len(cut(f".{char}.")) == 1:
            return not (_LETTER.match(char) or _DIGIT.match(char) or _BLANK.match(char))
        else:
            found = _BLANK
        return found.match(char) is not None

    def is_plain(self, text: str) -> bool:
        """Whether ``CUT`` cuts this text as the library does."""
        if any(special in text for special in self.special):
            return False
        if text.isascii():
            return True
        chars = set(text)
        for char in chars - self.agrees.keys():
            self.agrees[char] = self._agree(char)
        return all(map(self.agrees.__getitem__, chars))

    def lengths(self, pretokens: list[str]) -> list[int]:
        """Tokens of each pre-token, each encoded on its own."""
        found = self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)
        return [len(e.ids) for e in found]

    def count(self, text: str, table: dict[str, int]) -> int:
        """Tokens of a whole text.

        A text with a special string, or with a character that the library and ``CUT``
        class differently, is left to the library as a whole.
        """
        if not self.is_plain(text):
            return len(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        total = 0
        for chunk in chunks(text):
            pretokens = CUT.findall(chunk)
            found = list(map(table.get, pretokens))
            if None in found:
                misses = [token for token, n in zip(pretokens, found) if n is None]
                total += sum(n for n in found if n is not None) + self._count_misses(misses)
            else:
                total += sum(found)
        return total

    def _count_misses(self, misses: list[str]) -> int:
        if len(self.seen) > CACHE:
            self.seen.clear()
        new = list(dict.fromkeys(token for token in misses if token not in self.seen))
        known = dict(zip(new, self.lengths(new))) if new else {}
        self.seen.update((token, n) for token, n in known.items() if len(token) <= CACHE_CHARS)
        return sum(known[token] if token in known else self.seen[token] for token in misses)


def chunks(text: str, size: int = _CHUNK) -> Iterator[str]:
    """Pieces of a long text, cut only ahead of white space that follows none.

    Every pre-token ends there in any case, so the pieces have those of the text.
    """
    at = 0
    while at + size < len(text):
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


@lru_cache(maxsize=2)
def cutter_of(path: str) -> Cutter:
    """One cutter for all tasks that a Python worker runs, so that its cache stays filled."""
    return Cutter(path)


def frequent_pretokens(
    docs: DataFrame, vocabulary: str, text_column: str = "text", sample: int = SAMPLE, size: int = TABLE
) -> list[str]:
    """The most frequent pre-tokens of about ``sample`` documents, chosen by a hash.

    Each task adds up its own documents and gives on its most frequent ``size``; these
    summaries of the sample are all that is shuffled.
    """
    n = docs.count()
    texts = docs.select(whole_text(text_column).alias("text"))
    if n > sample:
        # A row is chosen by its position, so that rows alike are not all chosen or all left.
        share = max(1, int(sample / n * (1 << 30)))
        texts = texts.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < share)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        cutter = cutter_of(vocabulary)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for chunk in chunks(text) if cutter.is_plain(text) else ():
                    counts.update(t for t in CUT.findall(chunk) if len(t) <= TABLE_CHARS)
                    if len(counts) > 8 * size:
                        counts = Counter(dict(counts.most_common(4 * size)))
        most = counts.most_common(size)
        if most:
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in most], pa.string()), pa.array([c for _, c in most], pa.int64())],
                names=["pretoken", "n"],
            )

    found = texts.mapInArrow(summarise, "pretoken string, n bigint")
    most = found.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(size)
    return [row.pretoken for row in most.select("pretoken").collect()]


def packed(pretokens: list[str], lengths: list[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The table as it is sent: all pre-tokens in one string, where each ends, and its tokens."""
    parts = [token.encode("utf-8") for token in pretokens]
    return b"".join(parts), np.cumsum([len(p) for p in parts], dtype=np.uint32), np.array(lengths, np.uint16)


def unpacked(table: tuple[bytes, np.ndarray, np.ndarray]) -> dict[str, int]:
    blob, ends, lengths = table
    starts = np.concatenate([[0], ends[:-1]]).astype(int).tolist()
    return {blob[a:b].decode("utf-8"): n for a, b, n in zip(starts, ends.tolist(), lengths.tolist())}


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
    size: int = TABLE,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row of ``docs``.

    Counts are those of ``tokenizers`` for the whole text, without added special tokens;
    special strings inside a text count as the library's default has them. Null and empty
    texts have no bytes and no tokens. Null ids, ids of any size and repeated rows come
    back as they are, one row each; an empty table gives none; extra columns are left out
    whatever their names. Very long texts are counted piece by piece.
    """
    frequent = frequent_pretokens(docs, vocabulary, text_column, sample, size)
    lengths = cutter_of(vocabulary).lengths(frequent) if frequent else []
    table = docs.sparkSession.sparkContext.broadcast(packed(frequent, lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = cutter_of(vocabulary)
        lookup = None
        for batch in batches:
            if lookup is None:
                lookup = unpacked(table.value)
            n = [cutter.count(text, lookup) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array(n, pa.int64()),
                    pa.array([each > limit for each in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    text = whole_text(text_column)
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        text.alias("text"),
    ).mapInArrow(count, COUNTS)
