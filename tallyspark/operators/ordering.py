"""Row numbers over a whole sorted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.sources.store import stage

#: Bits of monotonically_increasing_id that count within a partition.
WITHIN = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Adds the gapless position, from 1, of each row in a global order.

    A window without a partition would sort the whole table in one task. Here the table is
    sorted by range and written, each row with its place in its range; the ranges, of which
    there are as many as shuffle partitions, then give the rows before each of them.
    """
    placed, _ = stage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "numbered")
    ranged = placed.withColumn("_range", F.shiftright("_place", 33))
    before = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    # One row per shuffle partition.
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_rows")).withColumn("_before", F.coalesce(before, F.lit(0)))
    position = F.col("_before") + F.col("_place").bitwiseAND(F.lit(WITHIN)) + 1
    return ranged.join(F.broadcast(offsets.drop("_rows")), "_range").withColumn(name, position).drop("_range", "_place", "_before")
