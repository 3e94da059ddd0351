"""Registered queries of the corpus operators: each takes whole tables and returns whole results."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, infill, pii, quality, sketch, toxicity
from .common import fold, table
from .digest_index import exact_duplicates
from .embeddings import embedding_groups
from .labelled import held_out
from .ngram import ngram_scores
from .packing import pack, windows
from .sharding import histogram_shards
from .simhash import simhash_groups
from .whitening import whiten


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_clauses").alias("n_clauses"),
    )


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, folder, "documents"), path, pattern, keep=["doc_id"])
    decoded = bpe.decode(
        encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "ids"),
        path,
        pattern,
        keep=["doc_id", "n_tokens", "ids_sha256"],
    )
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Whole rows move to their shards; the checksum is taken of the text that arrived there."""
    shards = histogram_shards(table(spark, folder, "documents"), 8)
    checksum = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    return shards.select(
        "doc_id", "size", checksum, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_groups(table(spark, folder, "embeddings"), 0.95)


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"), keep=["doc_id"])
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_disguised")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op7_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", fold(F.col("doc_id"), 7) == 2)
    return ngram_scores(docs.select("doc_id", "text", "held_out"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_groups(table(spark, folder, "documents"), words=3, budget=3, keep=["doc_id"])
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprints(table(spark, folder, "documents"), keep=["doc_id"])


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Windows with their ids are put together; each piece's checksum is taken of its ids in the window."""
    path, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed = windows(pack(table(spark, folder, "documents"), path, ranks, 1024, keep=["doc_id"]))
    ids = F.expr("substring(ids, 4 * piece.offset + 1, 4 * piece.length)")
    return packed.withColumn("piece", F.explode("pieces")).select(
        "piece.doc_id",
        "piece.start",
        F.col("piece.length").cast("long").alias("length"),
        F.crc32(ids).alias("ids_crc32"),
        "piece.doc_tokens",
        "sequence_id",
        F.col("piece.offset").cast("long").alias("offset"),
    )


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents come to a new index as two deliveries, so that the second one meets digests of the first."""
    docs = table(spark, folder, "documents")
    return exact_duplicates(docs, batch=F.concat(F.lit("delivery-"), fold(F.col("doc_id"), 2)))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whiten(table(spark, folder, "embeddings"), 16, keep=["vec_id"])
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op13_infill(spark: SparkSession, folder: str) -> DataFrame:
    shape = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    moved = infill.infill(table(spark, folder, "documents"), keep=["doc_id"])
    digest = F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256")
    back = infill.restore(moved.select(*shape, "output", digest), keep=[*shape, "output_sha256"])
    return back.select(*shape, "output_sha256", F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_sharding": op3_sharding,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_simhash": op8_simhash,
    "op9_fingerprints": op9_fingerprints,
    "op10_packing": op10_packing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_whitening": op12_whitening,
    "op13_infill": op13_infill,
}

ORACLE: dict[str, str] = {
    "op11_exact_dedup": r"""
        WITH hashed AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), ranked AS (
            SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id
            FROM hashed
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """,
    "op13_infill": """
        WITH hashed AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents
        ), words AS (
            SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
            FROM hashed
        ), cut AS (
            SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM words
        ), parts AS (
            SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM parts
    """,
}
