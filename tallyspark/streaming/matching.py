"""Streaming reconciliation with a bounded matching window."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyspark.operators.reconcile import TOLERANCE, WINDOW_DAYS
from tallyspark.schemas import (
    MATCHED,
    MISMATCHED,
    UNRECONCILED_INTERNAL,
    UNRECONCILED_PROCESSOR,
)

LATENESS = f"{WINDOW_DAYS} days"


def deduplicated(stream: DataFrame, key: str, event_time: str, lateness: str = LATENESS) -> DataFrame:
    """Drops replays of a key that arrive within the lateness; state expires with it."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])


def match_streams(
    internal: DataFrame,
    processor: DataFrame,
    how: str = "full_outer",
    lateness: str = LATENESS,
    window_days: int = WINDOW_DAYS,
    tolerance: str = TOLERANCE,
) -> DataFrame:
    """Match two streams on transaction_id inside the window, into the four categories.

    ``internal`` has transaction_id, amount, created_at; ``processor`` has transaction_id,
    amount, settled_at, whose date is the reference date. The interval in the condition
    bounds the state; an unmatched row comes out once the watermark has passed its window,
    so a settlement that is later than that is reported as unreconciled, and the internal
    row as well.

    Rows without a transaction id can match nothing. They do not enter the state, where all
    of them would meet in one partition, but come out at once as unreconciled.
    """
    ours = internal.filter("transaction_id IS NOT NULL").select(
        F.col("transaction_id").alias("i_id"),
        F.col("amount").cast("decimal(18,2)").alias("internal_amount"),
        F.col("created_at"),
    ).withWatermark("created_at", lateness)
    theirs = processor.filter("transaction_id IS NOT NULL").select(
        F.col("transaction_id").alias("p_id"),
        F.col("amount").cast("decimal(18,2)").alias("processor_amount"),
        F.col("settled_at"),
    ).withWatermark("settled_at", lateness)
    reference, created = F.col("settled_at").cast("date"), F.col("created_at").cast("date")
    # The interval is the date window widened to full days; the dates decide.
    condition = (
        (F.col("i_id") == F.col("p_id"))
        & (F.col("created_at") >= F.col("settled_at") - F.expr(f"INTERVAL {window_days + 1} DAYS"))
        & (F.col("created_at") <= F.col("settled_at") + F.expr("INTERVAL 1 DAY"))
        & created.between(F.date_sub(reference, window_days), reference)
    )
    difference = F.abs(F.col("internal_amount") - F.col("processor_amount"))
    category = (
        F.when(F.col("i_id").isNull(), UNRECONCILED_PROCESSOR)
        .when(F.col("p_id").isNull(), UNRECONCILED_INTERNAL)
        .when(difference <= F.lit(tolerance).cast("decimal(18,2)"), MATCHED)
        .otherwise(MISMATCHED)
    )
    matched = ours.join(theirs, condition, how).select(
        F.coalesce("i_id", "p_id").alias("transaction_id"),
        F.coalesce(reference, created).alias("reference_date"),
        category.alias("category"),
        "internal_amount",
        "processor_amount",
        difference.cast("decimal(18,2)").alias("difference"),
    )
    if how in ("full_outer", "left_outer"):
        matched = matched.unionByName(_without_id(internal, "created_at", UNRECONCILED_INTERNAL, "internal_amount"))
    if how in ("full_outer", "right_outer"):
        matched = matched.unionByName(_without_id(processor, "settled_at", UNRECONCILED_PROCESSOR, "processor_amount"))
    return matched


def _without_id(stream: DataFrame, at: str, category: str, amount: str) -> DataFrame:
    none = F.lit(None).cast("decimal(18,2)")
    amounts = {c: none for c in ("internal_amount", "processor_amount")} | {amount: F.col("amount").cast("decimal(18,2)")}
    return stream.filter("transaction_id IS NULL").select(
        F.lit(None).cast("string").alias("transaction_id"),
        F.col(at).cast("date").alias("reference_date"),
        F.lit(category).alias("category"),
        *(c.alias(name) for name, c in amounts.items()),
        none.alias("difference"),
    )
