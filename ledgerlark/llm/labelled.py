"""Bounded samples of labelled documents to train classifiers on."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import texts_of

T = TypeVar("T")

#: Documents of each label that a classifier is trained on, at most.
PER_LABEL = 1500


def fold_of(id_column: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(0))


def sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_label: int = PER_LABEL
) -> DataFrame:
    """``doc_id``, whole ``text`` and ``label`` of at most ``per_label`` documents of each label.

    ``learn`` says of ``doc_id`` which rows may be learned from. The rows with the
    least hash of their id are taken, so that the sample does not depend on the
    order of the rows. Rows without an id or a label are left out; of several
    labels of one id the least holds; of several texts the least.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    )
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most 2 * per_label rows of two numbers.
    return (
        texts_of(docs).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    )


def trained(rows: DataFrame, fit: Callable[[list[str], list[int]], T]) -> T:
    """What ``fit`` makes of a sample, in the order of its ids, in one task.

    The sample is bounded, and so is the model that comes back. A task has one
    thread for its linear algebra, and a lost one gives the same model again.
    """

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [frame for frame in frames if len(frame)]
        if parts:
            whole = pd.concat(parts).sort_values("doc_id")
            model = fit(whole.text.tolist(), whole.label.tolist())
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    made = rows.repartition(1).mapInPandas(learn, "model binary").collect()
    return pickle.loads(made[0].model) if made else fit([], [])
