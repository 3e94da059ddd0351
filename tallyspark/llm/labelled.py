"""Labelled documents for fitting: a bounded sample outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold

#: Labelled rows that a classifier is fitted on at most: those with the least hash of the id.
MAX_ROWS = 20_000
FOLDS = 5


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """(text, label) of at most `max_rows` labelled documents whose fold is not 0; rows without a label do not count.

    Only ids and labels are sorted to choose the rows. `labels` is a table of ids; a document labelled several times
    occurs as often.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != 0))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(max_rows).select("doc_id", F.col(label).cast("int").alias("_label"))
    # At most max_rows ids and labels: the texts stay where they are, and the chosen ones are written once.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return joined.select("text", F.col("_label").alias("label"))


def held_out() -> Column:
    return fold(F.col("doc_id"), FOLDS) == 0
