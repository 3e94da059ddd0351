"""Checks and small reports over loaded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Expected share of reversals and its tolerance, in percent.
REVERSED_PERCENT = 2.0
REVERSED_TOLERANCE = 1.0

# Accepted share of each result category.
CATEGORY_BANDS = {
    "MATCHED": (0.78, 0.92),
    "MISMATCHED": (0.01, 0.10),
    "UNRECONCILED_PROCESSOR": (0.01, 0.10),
    "UNRECONCILED_INTERNAL": (0.01, 0.10),
}


def _share_of_rows(counted: DataFrame, count: str) -> Column:
    # The window sees one row per value of a small domain.
    return F.col(count) / F.sum(count).over(Window.partitionBy())


def status_mix(settlements: DataFrame) -> DataFrame:
    """Rows, amount and settlement dates per status with the share in percent."""
    per_status = settlements.groupBy("status").agg(
        F.count("*").alias("total_rows"),
        F.sum("amount").alias("total_amount"),
        F.min(F.col("settled_at").cast("date")).alias("earliest_date"),
        F.max(F.col("settled_at").cast("date")).alias("latest_date"),
    )
    return per_status.withColumn("pct", _share_of_rows(per_status, "total_rows") * 100)


def reversed_check(
    mix: DataFrame, expected: float = REVERSED_PERCENT, tolerance: float = REVERSED_TOLERANCE
) -> DataFrame:
    """The share of reversals and whether it is near the expected one."""
    share = F.coalesce(F.sum(F.when(F.col("status") == "REVERSED", F.col("pct"))), F.lit(0.0))
    return mix.agg(share.alias("reversed_pct")).withColumn(
        "as_expected", F.abs(F.col("reversed_pct") - expected) <= tolerance
    )


def settled_per_day(settlements: DataFrame) -> DataFrame:
    return settlements.groupBy(F.col("settled_at").cast("date").alias("date")).agg(
        F.count("*").alias("transactions")
    )


def amount_stats(settlements: DataFrame) -> DataFrame:
    return settlements.agg(
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.avg(F.col("amount").cast("double")).alias("avg_amount"),
        F.count_if(F.col("amount") <= 0).alias("not_positive"),
        F.count_if(F.col("settled_at").isNull()).alias("null_dates"),
    )


def fill_rate(df: DataFrame, column: str, origin: Column) -> DataFrame:
    """How often a drifted column is filled, by origin of the row."""
    return (
        df.groupBy(origin.alias("origin"))
        .agg(F.count("*").alias("total"), F.count(column).alias("filled"))
        .withColumn("fill_rate", F.col("filled") / F.col("total"))
    )


def category_mix(
    results: DataFrame, bands: Mapping[str, tuple[float, float]] = CATEGORY_BANDS
) -> DataFrame:
    """Share of each category and whether it lies in its band (NULL without a band)."""
    counts = results.groupBy("category").agg(F.count("*").alias("n"))
    in_band = F.lit(None).cast("boolean")
    for category, (low, high) in bands.items():
        in_band = F.when(F.col("category") == category, F.col("share").between(low, high)).otherwise(in_band)
    return counts.withColumn("share", _share_of_rows(counts, "n")).withColumn("in_band", in_band)


def weekly_rollup(summary: DataFrame) -> DataFrame:
    return summary.groupBy("week_start", "week_end").agg(
        F.count("*").alias("categories"), F.sum("txn_count").alias("total_txns")
    )


def operations(log: DataFrame) -> DataFrame:
    """Rows per change operation, for the insert/update pairing of runs."""
    return log.groupBy("Op").agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def present_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other.select(key), key, "left_semi")


def absent_from(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``other``; a NULL key occurs nowhere."""
    return df.join(other.select(key), key, "left_anti")


def newest_rows(df: DataFrame, n: int, by: str = "_timestamp", ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in (by, *ties)]).limit(n)
