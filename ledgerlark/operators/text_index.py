"""Searching texts by pattern through an index of three-letter pieces.

``LIKE '%word%'`` reads every text. The index holds one row per text and distinct piece of
three characters, sorted by piece and cut into files of bounded size, so the pieces of a pattern read a few row groups; only the
texts that have all of them are compared with the pattern itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.text import matches

GRAM = 3
#: Rows of the index that one task sorts.
ROWS_A_TASK = 250_000


def grams_of(text: str | Column) -> Column:
    """The distinct pieces of the lowered text."""
    lowered = F.lower(F.col(text) if isinstance(text, str) else text)
    last = F.length(lowered) - (GRAM - 1)
    pieces = F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(lowered, i, F.lit(GRAM)))
    return F.when(last > 0, F.array_distinct(pieces))


def gram_rows(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The index as rows ``(gram, id)``, sorted so that files and row groups hold few pieces each; a
    piece that many texts share fills several. Rows that repeat an id repeat its pieces.

    The pieces are counted first, and dealt to as many tasks as ``ROWS_A_TASK`` asks for: what a
    task holds does not grow with the texts. So their number is stated, and not left to
    adaptive execution, which goes by compressed bytes.
    """
    texts = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    n = texts.agg(F.sum(F.greatest(F.length(F.lower("text")) - (GRAM - 1), F.lit(0)))).first()[0] or 0
    tasks = max(1, -(-n // ROWS_A_TASK))
    rows = texts.repartition(tasks, "id", "text").select(F.explode(grams_of("text")).alias("gram"), "id")
    return rows.repartitionByRange(tasks, "gram", "id").sortWithinPartitions("gram", "id")


def literal_runs(pattern: str) -> list[str]:
    """The parts of a LIKE pattern that stand for themselves; ``\\`` takes the next sign literally."""
    runs, at, i = [""], 0, 0
    while i < len(pattern):
        sign = pattern[i]
        if sign == "\\" and i + 1 < len(pattern):
            i += 1
            runs[-1] += pattern[i]
        elif sign in "%_":
            runs.append("")
        else:
            runs[-1] += sign
        i += 1
    return [run for run in runs if run]


def pattern_grams(pattern: str) -> list[str]:
    """Pieces that every match has. Letters beyond ASCII are left out, since lower case may
    change their number."""
    found = set()
    for run in literal_runs(pattern):
        lowered = run.lower()
        for i in range(len(lowered) - GRAM + 1):
            piece = lowered[i : i + GRAM]
            if piece.isascii() and run.isascii():
                found.add(piece)
    return sorted(found)


def _all_seen(grams: list[str]) -> Column:
    """Whether a text has all of the pieces, however often its id comes."""
    seen = [F.max(F.col("gram") == piece) for piece in grams]
    return reduce(lambda left, right: left & right, seen).alias("_all")


def matching(df: DataFrame, id_column: str, text_column: str, pattern: str, index: DataFrame | None) -> DataFrame:
    """Rows of ``df`` whose text is LIKE ``pattern`` in any case.

    With an ``index`` (see ``gram_rows``) only texts that have all pieces of the pattern are read
    further. A pattern without a piece of three signs is compared with every text.
    """
    grams = pattern_grams(pattern) if index is not None else []
    if grams:
        having = (
            index.where(F.col("gram").isin(grams)).groupBy("id").agg(_all_seen(grams))
            .where("_all").select(F.col("id").alias(id_column))
        )
        df = df.join(having, id_column, "left_semi")
    return df.where(matches(text_column, pattern))
