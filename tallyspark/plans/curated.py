"""Run selection and merchant enrichment on the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyspark.operators.cdc import last_per_key
from tallyspark.schemas import COMPLETED


def _newest_run_per_date(runs: DataFrame) -> DataFrame:
    newest_first = [F.col("started_at").desc_nulls_last(), F.col("id").desc_nulls_last()]
    return last_per_key(runs, ["reference_date"], newest_first)


def runs_latest(runs: DataFrame) -> DataFrame:
    """The most recent run of each reference date, whatever its status."""
    return _newest_run_per_date(runs)


def winning_runs(runs: DataFrame) -> DataFrame:
    """(reference_date, run_id) of the most recent COMPLETED run of each date.

    The status filter comes before the ranking, so a later failed attempt does not hide
    the results of an earlier completed one.
    """
    completed = runs.filter(F.col("status") == COMPLETED)
    return _newest_run_per_date(completed).select("reference_date", F.col("id").alias("run_id"))


def results_current(
    runs: DataFrame, results: DataFrame, company: DataFrame | None = None
) -> DataFrame:
    """Results of the winning runs with reference date and, given ``company``, identity.

    Two company rows with one merchant_id double that merchant's results. Callers that
    know merchant_id to be unique and need no names leave ``company`` out and save the
    join; with it, Catalyst keeps only the columns that are used.
    """
    # One row per calendar date, hence broadcast whatever the volume of the results.
    current = results.join(F.broadcast(winning_runs(runs)), "run_id")
    columns = [
        "id", "run_id", "reference_date", "transaction_id", "merchant_id", "category",
        "internal_amount", "processor_amount", "difference", "created_at", "source",
    ]
    if company is None:
        return current.select(*columns)
    identity = company.select("merchant_id", "legal_name", "trade_name", "document", "primary_cnae")
    return current.join(identity, "merchant_id", "left").select(
        *columns, "legal_name", "trade_name", "document", "primary_cnae"
    )


def merchants_unique(company: DataFrame) -> bool:
    """Whether no merchant_id occurs twice (NULL never joins, so it does not count)."""
    known = company.filter(F.col("merchant_id").isNotNull())
    return known.groupBy("merchant_id").count().filter("count > 1").isEmpty()
