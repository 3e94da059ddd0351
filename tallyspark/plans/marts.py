"""The six gold artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyspark.functions.amounts import financial_amount, share
from tallyspark.functions.dates import week_end, week_start
from tallyspark.plans.curated import runs_latest
from tallyspark.schemas import RISK_CATEGORIES

TREND_ROWS = 7


def ops_daily(runs: DataFrame, current: DataFrame) -> DataFrame:
    """One row per reference date and category.

    Run id and status are those of the latest attempt, counts those of the latest
    completed run. A date without results keeps one row with a NULL category. Results
    shrink to date x category before they meet the runs.
    """
    counts = current.groupBy("reference_date", "category").agg(
        F.count("id").alias("txn_count"),
        F.count("*").alias("_rows"),
        F.sum("internal_amount").alias("internal_amount_sum"),
        F.sum("processor_amount").alias("processor_amount_sum"),
        F.sum("difference").alias("abs_difference_sum"),
    )
    day = Window.partitionBy("reference_date")
    return (
        runs_latest(runs)
        .select("reference_date", F.col("id").alias("run_id"), F.col("status").alias("run_status"))
        .join(counts, "reference_date", "left")
        .withColumn("_total", F.sum("_rows").over(day))
        .select(
            "reference_date",
            "run_id",
            "run_status",
            "category",
            F.coalesce("txn_count", F.lit(0)).alias("txn_count"),
            share(F.col("txn_count"), F.col("_total")).alias("pct_of_total"),
            "internal_amount_sum",
            "processor_amount_sum",
            "abs_difference_sum",
        )
    )


def with_trend(daily: DataFrame) -> DataFrame:
    """Adds the mean share of up to seven previous rows of the category.

    Rows, not days: a date on which the category is absent has no row. A window partition
    holds one row per calendar date, so its size does not follow the volume.
    """
    previous = (
        Window.partitionBy("category").orderBy("reference_date").rowsBetween(-TREND_ROWS, -1)
    )
    return daily.withColumn("pct_of_total_7d_avg", F.avg("pct_of_total").over(previous))


def ops_trend(daily: DataFrame) -> DataFrame:
    return with_trend(daily).drop("run_status")


def run_history(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Every run attempt x category; a run without results keeps one row."""
    run = Window.partitionBy("run_id")
    counts = (
        results.groupBy("run_id", "category")
        .agg(F.count("*").alias("txn_count"))
        .withColumn("_total", F.sum("txn_count").over(run))
    )
    return (
        runs.withColumnRenamed("id", "run_id")
        .join(counts, "run_id", "left")
        .select(
            "run_id",
            "reference_date",
            "file_name",
            F.col("status").alias("run_status"),
            "total_transactions",
            "started_at",
            "completed_at",
            "category",
            F.coalesce("txn_count", F.lit(0)).alias("txn_count"),
            share(F.col("txn_count"), F.col("_total")).alias("pct_of_total"),
        )
    )


def cfo_weekly_summary(current: DataFrame) -> DataFrame:
    amount = financial_amount(F.col("processor_amount"), F.col("internal_amount"))
    weekly = current.groupBy(
        week_start(F.col("reference_date")).alias("week_start"), "category"
    ).agg(F.count("*").alias("txn_count"), F.sum(amount).alias("amount_brl"))
    return weekly.select(
        "week_start",
        week_end(F.col("week_start")).alias("week_end"),
        "category",
        "txn_count",
        "amount_brl",
    )


def cfo_weekly_merchant_ranking(current: DataFrame, company: DataFrame) -> DataFrame:
    """Risk volume per week, merchant and category.

    ``current`` comes without company columns: rows are summed per merchant first and
    joined to the names afterwards, so a merchant with very many results sends one row
    per task and group through the join. Merchants listed twice under the same names are
    added up, under different names kept apart, as a row-level join would have it.
    """
    amount = financial_amount(F.col("processor_amount"), F.col("internal_amount"))
    per_merchant = (
        current.filter(F.col("category").isin(*RISK_CATEGORIES))
        .groupBy(
            week_start(F.col("reference_date")).alias("week_start"), "merchant_id", "category"
        )
        .agg(F.count("*").alias("_count"), F.sum(amount).alias("_amount"))
    )
    names = company.select("merchant_id", "legal_name", "trade_name")
    return (
        per_merchant.join(names, "merchant_id", "left")
        .groupBy("week_start", "merchant_id", "category", "legal_name", "trade_name")
        .agg(F.sum("_count").alias("txn_count"), F.sum("_amount").alias("amount_brl"))
        .select(
            "week_start", "merchant_id", "category", "txn_count", "amount_brl",
            "legal_name", "trade_name",
        )
    )


def cfo_weekly_ranking_of_named(current: DataFrame) -> DataFrame:
    """The same from results that carry their merchant's names, one row per name it is listed under."""
    amount = financial_amount(F.col("processor_amount"), F.col("internal_amount"))
    return (
        current.filter(F.col("category").isin(*RISK_CATEGORIES))
        .groupBy(
            week_start(F.col("reference_date")).alias("week_start"), "merchant_id", "category", "legal_name", "trade_name"
        )
        .agg(F.count("*").alias("txn_count"), F.sum(amount).cast("decimal(38,2)").alias("amount_brl"))
        .select("week_start", "merchant_id", "category", "txn_count", "amount_brl", "legal_name", "trade_name")
    )


def compliance_ledger(runs: DataFrame, results: DataFrame, company: DataFrame) -> DataFrame:
    """All results of all runs, superseded ones included."""
    attempts = runs.select(
        F.col("id").alias("run_id"),
        "reference_date",
        "file_name",
        "started_at",
        "completed_at",
        F.col("status").alias("run_status"),
    )
    identity = company.select("merchant_id", "legal_name", "document")
    return (
        results.withColumnRenamed("id", "result_id")
        .join(attempts, "run_id")
        .join(identity, "merchant_id", "left")
        .select(
            "result_id", "run_id", "reference_date", "file_name", "started_at", "completed_at",
            "run_status", "transaction_id", "merchant_id", "legal_name", "document", "category",
            "internal_amount", "processor_amount", "difference", "created_at",
        )
    )
