"""Change-log reduction: union of drifted batches, latest state per key, typed projections."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyspark.functions.amounts import MONEY
from tallyspark.schemas import DELETE
from tallyspark.sources.store import stage

LINEAGE = "historical_backfill"


def union_batches(batches: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column that a batch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    ``row_number() = 1`` makes Spark plan a group limit below the shuffle, so that every
    task sends at most one row per key and a hot key does not fill one partition.
    """
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranking)).filter("_rn = 1").drop("_rn")


def latest_state(
    log: DataFrame,
    key: str | Sequence[str],
    order_by: str = "_timestamp",
    tie_breakers: Sequence[str] = (),
    op: str = "Op",
) -> DataFrame:
    """Current rows of a change log: latest change per key, deleted keys left out.

    Deletes are dropped after ranking, so a key whose latest change is a delete is gone.
    A NULL operation is dropped too. Changes with equal time are decided by
    ``tie_breakers``, highest value first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc_nulls_last() for c in (order_by, *tie_breakers)]
    return last_per_key(log, keys, order).filter(F.col(op) != DELETE)


def null_count(df: DataFrame, column: str) -> int:
    """Rows with a NULL in ``column``: reads that column only, and skips parquet row
    groups whose statistics show no NULL."""
    return df.filter(F.col(column).isNull()).count()


def require_timestamps(log: DataFrame, column: str = "_timestamp") -> None:
    missing = null_count(log, column)
    if missing:
        raise ValueError(f"{column} is NULL in {missing} row(s); the latest change is undecidable")


def typed_runs(log: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    current = latest_state(log, "id", tie_breakers=tie_breakers)
    return current.select(
        "id",
        F.col("reference_date").cast("date"),
        "file_name",
        "status",
        F.col("total_transactions").cast("int"),
        F.col("started_at").cast("timestamp"),
        F.col("completed_at").cast("timestamp"),
        F.col("created_at").cast("timestamp"),
        F.lit(LINEAGE).alias("source"),
    )


def typed_results(log: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    current = latest_state(log, "id", tie_breakers=tie_breakers)
    return current.select(
        "id",
        "run_id",
        "transaction_id",
        "merchant_id",
        "category",
        F.col("internal_amount").cast(MONEY),
        F.col("processor_amount").cast(MONEY),
        F.col("difference").cast(MONEY),
        F.col("created_at").cast("timestamp"),
        F.lit(LINEAGE).alias("source"),
    )


def typed_company(log: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    current = latest_state(log, "id", tie_breakers=tie_breakers)
    return current.select(
        "id",
        "merchant_id",
        "legal_name",
        "trade_name",
        "document",
        "primary_cnae",
        F.col("created_at").cast("timestamp"),
        F.col("updated_at").cast("timestamp"),
    )


#: A key's bucket with at least so many changes, and a thousandth of all, is cut into ranges of about this size.
HOT_CHANGES, HOT_PART = 1_000_000, 1000


def _in_ranges(stamped: DataFrame, key: str, order: Sequence[str], hot_changes: int) -> DataFrame:
    """The changes with ``_range``: 0, or the number of the range that a change of a hot bucket lies in.

    Hot buckets are at most ``HOT_PART``, so they are broadcast. Their changes, and no others, are
    dealt by range of key and order and written to the shared folder, so that a range is the same
    whenever it is read again. A range is bounded in size unless changes are alike in key and order.
    """
    placed = stamped.filter("_at IS NOT NULL")
    cells = placed.groupBy(F.col(key).alias("_of"), F.col("_bucket").alias("_in")).agg(F.count("*").alias("_n"))
    total = placed.count()
    hot = [r for r in cells.filter((F.col("_n") >= hot_changes) & (F.col("_n") * HOT_PART >= total)).collect()]
    if not hot:
        return stamped.withColumn("_range", F.lit(0))
    schema = T.StructType([*(cells.schema[c] for c in ("_of", "_in")), T.StructField("_n", T.LongType())])
    marks = F.broadcast(stamped.sparkSession.createDataFrame(hot, schema).drop("_n"))
    same = F.col(key).eqNullSafe(F.col("_of")) & F.col("_bucket").eqNullSafe(F.col("_in"))
    ranges = -(-sum(r["_n"] for r in hot) // hot_changes)
    dealt = stamped.join(marks, same, "left_semi").repartitionByRange(ranges + len(hot), key, "_at", *order)
    ranged, _ = stage(dealt.withColumn("_range", F.spark_partition_id() + 1), "hot-changes")
    return stamped.join(marks, same, "left_anti").withColumn("_range", F.lit(0)).unionByName(ranged)


def versioned_history(
    log: DataFrame,
    key: str,
    at: str = "_timestamp",
    tie_breakers: Sequence[str] = (),
    bucket: str = "month",
    op: str = "Op",
    hot_changes: int = HOT_CHANGES,
) -> DataFrame:
    """Every version of every key with ``valid_from``, ``valid_to`` and ``is_current``.

    ``valid_to`` is the time of the next change. A key with very many changes is split by
    time bucket: inside a bucket the next change is a window lead, and the last change of a
    bucket takes the first time of the key's next bucket from a frame of one row per key
    and bucket. A bucket that holds much of the log by itself is cut further, into ranges of
    about ``hot_changes`` changes, see ``_in_ranges``. A delete closes its predecessor and is no version itself. NULL is a key
    like any other. A change without a time has no place in the order: it comes out with
    neither ``valid_from`` nor ``valid_to`` and is never current.
    """
    stamped = log.withColumn("_at", F.col(at).cast("timestamp")).withColumn(
        "_bucket", F.date_trunc(bucket, "_at")
    )
    stamped = _in_ranges(stamped, key, tie_breakers, hot_changes)
    inside = Window.partitionBy(key, "_bucket", "_range").orderBy("_at", *[F.col(c) for c in tie_breakers])
    across = Window.partitionBy("_of").orderBy("_in", "_part")
    starts = (
        stamped.filter("_at IS NOT NULL")
        .groupBy(F.col(key).alias("_of"), F.col("_bucket").alias("_in"), F.col("_range").alias("_part"))
        .agg(F.min("_at").alias("_first"))
        .withColumn("_next_first", F.lead("_first").over(across))
        .drop("_first")
    )
    place = F.col(key).eqNullSafe(F.col("_of")) & F.col("_bucket").eqNullSafe(F.col("_in")) & (F.col("_range") == F.col("_part"))
    return (
        stamped.withColumn("_next", F.lead("_at").over(inside))
        .join(starts, place, "left")
        .withColumn("valid_from", F.col("_at"))
        .withColumn("valid_to", F.coalesce("_next", "_next_first"))
        .withColumn("is_current", F.col("valid_to").isNull() & F.col("_at").isNotNull())
        .filter(~F.col(op).eqNullSafe(DELETE))
        .drop("_at", "_bucket", "_range", "_next", "_next_first", "_of", "_in", "_part")
    )
