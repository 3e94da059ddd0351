"""Matching of processor settlements with internal transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.schemas import (
    MATCHED,
    MISMATCHED,
    UNRECONCILED_INTERNAL,
    UNRECONCILED_PROCESSOR,
)

# Fixed values of the matching rules.
WINDOW_DAYS = 7
TOLERANCE = "0.01"


def _keyed(side: DataFrame, marker: int, prefix: str) -> DataFrame:
    """Adds the join key, which keeps rows without transaction id apart.

    Such rows can match nothing, but as plain NULL keys of an outer join they would all
    hash to one partition. They get a key of their own side, spread by row content.
    """
    known = F.col("transaction_id").isNotNull()
    spread = F.xxhash64(*side.columns).cast("string")
    return side.withColumn(
        f"{prefix}_key", F.when(known, F.col("transaction_id")).otherwise(spread)
    ).withColumn(f"{prefix}_side", F.when(known, 0).otherwise(marker))


def reconcile(
    internal: DataFrame,
    processor: DataFrame,
    scope: str = "transaction",
    window_days: int = WINDOW_DAYS,
    tolerance: str = TOLERANCE,
) -> DataFrame:
    """Classify both sides into the four categories.

    ``internal`` has transaction_id, merchant_id, amount, created_at and is the current
    state (one row per transaction); ``processor`` has transaction_id, merchant_id, amount,
    reference_date and holds one row per transaction and date.

    A pair counts if the internal row was created in ``[reference_date - window_days,
    reference_date]``. Scope "transaction" gives one row per transaction side, with an
    unmatched internal row dated by its creation day. Scope "run" compares each date's
    file with every internal row of its window, so an internal row appears once for every
    run date within reach.

    Scope "transaction" is an equi-join that carries the window as a further condition. In
    scope "run" both sides move once, into one sorted group per transaction, and the days are
    laid out from there; see ``_by_run``.
    """
    ours = _keyed(internal, 1, "i").select(
        "i_key",
        "i_side",
        F.col("transaction_id").alias("i_id"),
        F.col("merchant_id").alias("i_merchant"),
        F.col("amount").cast("decimal(18,2)").alias("internal_amount"),
        F.col("created_at").cast("date").alias("i_date"),
    )
    theirs = _keyed(processor, 2, "p").select(
        "p_key",
        "p_side",
        F.col("transaction_id").alias("p_id"),
        F.col("merchant_id").alias("p_merchant"),
        F.col("amount").cast("decimal(18,2)").alias("processor_amount"),
        F.col("reference_date").alias("p_date"),
    )
    if scope == "run":
        return _classified(*_by_run(ours, theirs, window_days), tolerance)
    if scope != "transaction":
        raise ValueError(f"scope must be 'transaction' or 'run', not {scope!r}")
    in_window = F.col("i_date").between(F.date_sub("p_date", window_days), F.col("p_date"))
    same = (
        (F.col("i_key") == F.col("p_key")) & (F.col("i_side") == F.col("p_side")) & in_window
    )
    joined = ours.join(theirs, same, "full_outer")
    return _classified(joined, F.coalesce("p_date", "i_date"), tolerance)


def _by_run(ours: DataFrame, theirs: DataFrame, window_days: int) -> tuple[DataFrame, Column]:
    """Every file row with its partner in the window, and every internal row on each run date in
    reach whose file does not have it.

    The rows of both sides are one frame, exchanged once by transaction. In the sorted group of a
    transaction a file row sees the internal row, and the internal row the dates that have it;
    only then is it laid out over the other dates, so it is not multiplied before it moves. A
    group is as long as a transaction has dates.
    """
    run_dates = theirs.select(F.col("p_date").alias("i_run")).distinct().withColumn("_ran", F.lit(True))
    one = ours.withColumnsRenamed({"i_key": "_key", "i_side": "_side"}).unionByName(
        theirs.withColumnsRenamed({"p_key": "_key", "p_side": "_side"}), allowMissingColumns=True
    )
    group = Window.partitionBy("_key", "_side")
    internal = F.col("i_date").isNotNull()
    partner = F.max(F.when(internal, F.struct("i_date", "i_id", "i_merchant", "internal_amount"))).over(group)
    met = one.withColumn("_with", partner).withColumn("_days", F.collect_set("p_date").over(group))
    reach = F.sequence("i_date", F.date_add("i_date", window_days))
    laid = met.withColumn("i_run", F.explode_outer(F.when(internal, F.array_except(reach, F.col("_days")))))
    # One row per calendar date, hence broadcast whatever the volume.
    dated = laid.join(F.broadcast(run_dates), "i_run", "left").filter(~internal | F.col("_ran"))
    first = F.col("_with.i_date")
    near = F.col("p_date").between(first, F.date_add(first, window_days))
    pairs = {c: F.when(internal, F.col(c)).when(near, F.col(f"_with.{c}")) for c in ("i_id", "i_merchant", "internal_amount")}
    # The partner's date is needed last, as it tells the sides apart.
    paired = dated.withColumns({**pairs, "i_date": F.when(internal, F.col("i_date")).when(near, first)})
    return paired, F.coalesce("p_date", "i_run")


def _classified(joined: DataFrame, anchor: Column, tolerance: str) -> DataFrame:
    difference = F.abs(F.col("internal_amount") - F.col("processor_amount"))
    category = (
        F.when(F.col("i_date").isNull(), UNRECONCILED_PROCESSOR)
        .when(F.col("p_date").isNull(), UNRECONCILED_INTERNAL)
        .when(difference <= F.lit(tolerance).cast("decimal(18,2)"), MATCHED)
        .otherwise(MISMATCHED)
    )
    return joined.select(
        F.coalesce("i_id", "p_id").alias("transaction_id"),
        anchor.alias("reference_date"),
        F.coalesce("i_merchant", "p_merchant").alias("merchant_id"),
        category.alias("category"),
        "internal_amount",
        "processor_amount",
        difference.cast("decimal(18,2)").alias("difference"),
    )


def audit_categories(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Matrix (stored category, recomputed category, transactions).

    Both frames are first counted per transaction and category, so a transaction id that
    fills a large part of either side meets the join as a handful of rows. A pair of
    categories counts as often as the row-level outer join would produce it.
    """

    def per_transaction(df: DataFrame, name: str) -> DataFrame:
        return (
            df.groupBy("transaction_id", F.col("category").alias(name))
            .agg(F.count("*").alias(f"_{name}"))
        )

    pairs = per_transaction(stored, "stored").join(
        per_transaction(recomputed, "recomputed"), "transaction_id", "full_outer"
    )
    times = F.coalesce("_stored", F.lit(1)) * F.coalesce("_recomputed", F.lit(1))
    return pairs.groupBy("stored", "recomputed").agg(F.sum(times).alias("transactions"))
