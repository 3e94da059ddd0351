"""The figures behind the CFO report and the run-history report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyspark.functions.text import display_name, percent, short_label, thousands
from tallyspark.plans.alerts import requested_date
from tallyspark.schemas import CATEGORIES

TOP_MERCHANTS = 10
REPORT_DAYS = 7
NO_RESULTS = "no results"


# --- CFO ------------------------------------------------------------------------


def period_range(summary: DataFrame) -> DataFrame:
    """First and last day covered; no row without data."""
    return summary.agg(
        F.min("week_start").alias("period_start"), F.max("week_end").alias("period_end")
    ).filter(F.col("period_start").isNotNull())


def category_totals(summary: DataFrame) -> DataFrame:
    return summary.groupBy("category").agg(
        F.sum("txn_count").alias("txn_count"),
        F.coalesce(F.sum("amount_brl"), F.lit(0)).alias("amount_brl"),
    )


def headline(totals: DataFrame) -> DataFrame:
    return totals.agg(
        F.sum("amount_brl").alias("total_brl"), F.sum("txn_count").alias("total_txn")
    )


def category_shares(totals: DataFrame) -> DataFrame:
    """Share of each category in the amount; a zero total counts as 1. One row per category."""
    amount = F.col("amount_brl").cast("double")
    whole = F.sum("amount_brl").over(Window.partitionBy()).cast("double")
    return totals.select(
        "category",
        short_label(F.col("category")).alias("label"),
        "amount_brl",
        (amount / F.when(whole == 0, 1.0).otherwise(whole)).alias("share"),
    )


def daily_by_category(daily: DataFrame) -> DataFrame:
    """Amount per date and category: inside one category the processor side is present in
    all rows or in none, so the sums can be coalesced."""
    return daily.filter(F.col("category").isNotNull()).select(
        "reference_date",
        "category",
        "txn_count",
        F.coalesce("processor_amount_sum", "internal_amount_sum", F.lit(0)).alias("amount_brl"),
    )


def daily_table(daily: DataFrame) -> DataFrame:
    """One row per date, one amount column per category (0 if absent), total and count."""
    per_category = [
        F.coalesce(F.sum(F.when(F.col("category") == c, F.col("amount_brl"))), F.lit(0)).alias(c.lower())
        for c in CATEGORIES
    ]
    return daily_by_category(daily).groupBy("reference_date").agg(
        *per_category, F.sum("amount_brl").alias("total"), F.sum("txn_count").alias("txns")
    )


def top_merchants(ranking: DataFrame, n: int = TOP_MERCHANTS) -> DataFrame:
    """The n merchants with the highest risk amount over the whole period, numbered."""
    order = [F.col("amount_brl").desc_nulls_last(), F.col("merchant_id").asc_nulls_last()]
    top = (
        ranking.groupBy("merchant_id")
        .agg(
            F.max("legal_name").alias("legal_name"),
            F.max("trade_name").alias("trade_name"),
            F.sum("txn_count").alias("txn_count"),
            F.sum("amount_brl").alias("amount_brl"),
        )
        .orderBy(*order)
        .limit(n)
    )
    # The window sees the n rows of the report only.
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "merchant_id",
        display_name(F.col("trade_name"), F.col("legal_name"), F.col("merchant_id")).alias("merchant"),
        "txn_count",
        F.coalesce("amount_brl", F.lit(0)).alias("amount_brl"),
    )


# --- run history -------------------------------------------------------------------


def runs_between(history: DataFrame, start: str, end: str) -> DataFrame:
    days = F.col("reference_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return history.filter(days)


def report_order(artifact: str) -> list[Column]:
    """The order of a gold artifact. Tables are stored without one, as each reader may want only a part."""
    if artifact == "gold_ops_run_history":
        return [
            F.col("reference_date").desc(),
            F.col("started_at").desc_nulls_last(),
            F.col("run_id").asc(),
            F.col("category").asc_nulls_last(),
        ]
    if artifact == "gold_cfo_weekly_merchant_ranking":
        ties = ("merchant_id", "category", "legal_name", "trade_name")
        return [F.col("week_start").asc(), F.col("amount_brl").desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)]
    if artifact == "gold_compliance_ledger":
        return [F.col(c).asc_nulls_last() for c in ("reference_date", "run_id", "result_id", "legal_name", "document")]
    first = "week_start" if artifact == "gold_cfo_weekly_summary" else "reference_date"
    return [F.col(first).asc(), F.col("category").asc_nulls_last()]


def ordered(artifact: str, rows: DataFrame) -> DataFrame:
    """The rows of a gold artifact, or some of them, in the order it is shown in."""
    return rows.orderBy(*report_order(artifact))


def in_report_order(history: DataFrame) -> DataFrame:
    return ordered("gold_ops_run_history", history)


def nested_runs(history: DataFrame) -> DataFrame:
    """One row per run with its categories as a list, empty for a run without results."""
    entry = F.struct(
        "category", "txn_count", F.coalesce("pct_of_total", F.lit(0.0)).alias("pct_of_total")
    )
    run = [
        "run_id", "reference_date", "file_name", "run_status", "total_transactions",
        "started_at", "completed_at",
    ]
    return history.groupBy(*run).agg(
        F.sort_array(F.collect_list(F.when(F.col("category").isNotNull(), entry))).alias("categories")
    )


def breakdown_text(nested: DataFrame) -> DataFrame:
    lines = F.transform(
        "categories",
        lambda c: F.concat(
            c["category"], F.lit(": "), thousands(c["txn_count"]), F.lit(" ("), percent(c["pct_of_total"]), F.lit(")")
        ),
    )
    text = F.when(F.size("categories") > 0, F.array_join(lines, "; ")).otherwise(NO_RESULTS)
    return nested.withColumn("breakdown", text)


def report_calendar(
    history: DataFrame, reference_date: str | None = None, days: int = REPORT_DAYS
) -> DataFrame:
    """The dates of the report, days without any run included, each with its runs.

    Covers ``days`` days before the reference date and that date itself; the default date
    is the latest one. No row without history.
    """
    last = requested_date(history, reference_date)
    span = F.sequence(F.date_sub("reference_date", days), F.col("reference_date"))
    calendar = last.select(F.explode(span).alias("reference_date"))
    # As many rows as the report has days.
    window = history.join(F.broadcast(calendar), "reference_date", "left_semi")
    return calendar.join(breakdown_text(nested_runs(window)), "reference_date", "left")
