"""A corpus from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import pii, quality, toxicity
from tallyspark.llm.common import free_name, table, written
from tallyspark.llm.packing import pack
from tallyspark.llm.simhash import near_duplicates

#: Documents of less quality go, as do documents of at least this toxicity.
LEAST_QUALITY = 0.3
MOST_TOXICITY = 0.5
#: Near-duplicates share this part of their runs of five words.
WORDS, SIMILARITY = 5, 0.8
CAPACITY = 1024


def _kept(scored: DataFrame, condition, docs: DataFrame) -> DataFrame:
    return scored.where(condition).select(*(F.col(f"`{c}`") for c in docs.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of `labels.quality` does not reject. Null and empty texts are scored like any other."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = free_name(docs, "_quality")
    return _kept(quality.score(docs, model, column=score), F.col(score) >= LEAST_QUALITY, docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of `labels.toxic` does not reject."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = free_name(docs, "_toxicity")
    return _kept(toxicity.score(docs, model, column=score), F.col(score) < MOST_TOXICITY, docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates; texts without words are one group.

    Rows are numbered, and the kept ones are told as one bit each, in words of 64 rows: texts stay where they are as long
    as these words are few enough to be broadcast.
    """
    row, word, bits = (free_name(docs, c) for c in ("_row", "_word", "_bits"))
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id"), "text"), WORDS, SIMILARITY)
    words = found.where("row = group_row").groupBy(F.shiftright("row", 6).alias(word)).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(row & 63 as int))")).alias(bits)
    )
    marked = rows.join(written(words, "kept"), F.shiftright(row, 6) == F.col(word))
    kept = marked.where(F.getbit(bits, F.col(row).bitwiseAND(F.lit(63)).cast("int")) == 1)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind, and n_chars of what is left."""
    return pii.mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their ids, window and offset."""
    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack(docs, path, ranks, CAPACITY, keep=["doc_id"])


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("pii", pii_masking),
    ("packing", packing),
]

#: No stage but the last could be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read again for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
