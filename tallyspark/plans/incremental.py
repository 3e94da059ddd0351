"""What a change reaches: trend rows, open weeks, new ledger rows; exports and snapshots by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyspark.functions.dates import week_end, week_start
from tallyspark.plans.marts import TREND_ROWS
from tallyspark.sources.store import Store, delete_path, in_partitions, same_keys, stage


def trend_reach(before: DataFrame, after: DataFrame, dates: DataFrame) -> DataFrame:
    """Dates whose trend rows may change when the daily rows of ``dates`` change.

    These are the dates themselves and, per category, up to seven rows after a touched
    one, looked up among old and new rows together so that a row that vanished still
    counts. One row per calendar date and category.
    """
    cells = before.select("category", "reference_date").union(
        after.select("category", "reference_date")
    ).distinct()
    marks = dates.select("reference_date").distinct().withColumn("_touched", F.lit(1))
    reach = (
        Window.partitionBy("category").orderBy("reference_date").rowsBetween(-TREND_ROWS, 0)
    )
    return (
        cells.join(F.broadcast(marks), "reference_date", "left")
        .withColumn("_reached", F.max("_touched").over(reach))
        .filter("_reached = 1")
        .select("reference_date")
        .union(dates.select("reference_date"))
        .distinct()
    )


def open_runs(runs: DataFrame, frozen: DataFrame, as_of: str) -> DataFrame:
    """Runs outside the weeks that are stored and ended before ``as_of``: only these are aggregated anew."""
    closed = frozen.filter(week_end(F.col("week_start")) < F.lit(as_of).cast("date"))
    weeks = closed.select(F.col("week_start").alias("_week")).distinct()
    # One row per calendar week.
    return runs.join(F.broadcast(weeks), week_start(F.col("reference_date")) == F.col("_week"), "left_anti")


def new_ledger_rows(ledger: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows whose result is not in the ledger; a NULL id is in it if the ledger has one."""
    known = ledger.select(F.col("result_id").alias("result_id"))
    return fresh.join(known, same_keys(fresh, known, ["result_id"]), "left_anti")


def append_ledger(store: Store, fresh: DataFrame, name: str = "gold_compliance_ledger") -> None:
    """Append results not yet in the ledger; stored rows are never rewritten.

    A result stays with its run and so with its date: only the ledger's partitions of the
    dates at hand are searched for its id.
    """
    # Evaluated once, as both the partitions at hand and the new rows are asked for.
    fresh, folder = stage(fresh, "ledger-rows")
    new = fresh
    if store.exists(name):
        new = new_ledger_rows(in_partitions(store.read(name), "reference_date", fresh), fresh)
    new.hint("rebalance", "reference_date").write.mode("append").partitionBy(
        "reference_date"
    ).parquet(store.path(name))
    delete_path(store.spark, folder)


def export_by_date(df: DataFrame, path: str) -> None:
    """Partitioned parquet export, repeatable per date."""
    (
        df.hint("rebalance", "reference_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reference_date")
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, snapshot_date: str) -> None:
    (
        df.withColumn("snapshot_date", F.lit(snapshot_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def read_as_of(snapshots: DataFrame, as_of: str) -> DataFrame:
    """The newest snapshot taken on or before a date; other partitions are not read."""
    past = snapshots.filter(F.col("snapshot_date") <= F.lit(as_of).cast("date"))
    newest = past.agg(F.max("snapshot_date")).scalar()
    return snapshots.filter(F.col("snapshot_date") == newest).drop("snapshot_date")
