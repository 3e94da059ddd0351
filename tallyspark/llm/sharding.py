"""Byte-balanced sharding by histogram sort."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written
from .histogram import range_of, split_points

KEYS = ["_text_key", "_id_key", "_row_key"]


def histogram_shards(
    docs: DataFrame,
    n_shards: int = 8,
    payload: list[str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    tolerance: float = 1e-4,
    range_bytes: int = 128 << 20,
) -> DataFrame:
    """Shards 0..n-1 of nearly equal bytes, as the columns `payload` (default: all) with size, shard and slot.

    Rows are ordered by a hash of the text, a hash of the id and their place in the stored table. The order is never
    produced by sorting all rows: exact byte counts below candidate boundaries give the shard boundaries and, between
    them, finer boundaries of about `range_bytes`, so that each range is one task of known size. Rows then move once, to
    their range, and the slot is the row's number in the range plus the known number of rows before it. Equal texts are
    neighbours in this order, so a group of copies stays in one shard unless a boundary has to cut it; a group that
    holds a third of all rows is cut by its ids, and rows that agree in text and id by their place.

    Size is the number of UTF-8 bytes of the text plus one. A null text has no bytes and its key equals that of other
    null texts; an empty text has no bytes either, with its own key. Null ids are ordinary equal ids. Repeated rows are
    kept as often as they occur. Columns of the input that are named like a result column are left out of the default
    payload. An empty table gives an empty result. Boundaries number at most 4096, as each becomes a comparison.
    """
    out = ["size", "shard", "slot"]
    hidden = [*KEYS, "_range"]
    payload = [c for c in docs.columns if c not in out and c not in hidden] if payload is None else payload
    keyed = docs.select(
        *(F.col(f"`{c}`") for c in payload if c not in out),
        F.shiftrightunsigned(F.xxhash64(F.col(text_column)), 2).alias(KEYS[0]),
        F.shiftrightunsigned(F.xxhash64(F.col(id_column)), 2).alias(KEYS[1]),
        F.monotonically_increasing_id().alias(KEYS[2]),
        (F.coalesce(F.octet_length(text_column), F.lit(0)) + 1).cast("long").alias("size"),
    )
    rows = written(keyed, "shards")  # fixes the row keys; all rounds read three long columns of it
    total = rows.agg(F.sum("size")).first()[0] or 0
    finer = max(1, min(4096 // n_shards, math.ceil(total / n_shards / range_bytes)))
    splitters, _, _ = split_points(rows, KEYS, "size", n_shards * finer, tolerance / finer)
    starts = [0, *(s.rows_below for s in splitters)]
    starts += [starts[-1]] * (n_shards * finer - len(starts))
    before = F.array(*(F.lit(starts[i] - starts[i - i % finer]).cast("long") for i in range(n_shards * finer)))
    placed = rows.withColumn("_range", range_of(KEYS, splitters).cast("int"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*KEYS))
    return placed.select(
        *(F.col(f"`{c}`") for c in payload if c not in out),
        "size",
        F.expr(f"_range div {finer}").cast("int").alias("shard"),
        (number - 1 + before[F.col("_range")]).cast("long").alias("slot"),
    )
