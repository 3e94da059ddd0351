"""Ordered build of all artifacts in a store."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyspark.plans import marts
from tallyspark.plans.curated import merchants_unique, results_current, runs_latest
from tallyspark.plans.dated import publish_whole, publish_weeks
from tallyspark.plans.incremental import open_runs
from tallyspark.sources.store import Store, delete_path, stage

logger = logging.getLogger(__name__)

SILVER = (
    "silver_reconciliation_runs",
    "silver_reconciliation_results",
    "silver_enterprise_company",
)

#: What the artifacts read of the results of the winning runs.
SUMMED = ("id", "reference_date", "merchant_id", "category", "internal_amount", "processor_amount", "difference")


def build_silver(store: Store) -> dict[str, str]:
    """Register the silver tables and the two curated views for spark.sql."""
    store.require(*SILVER)
    store.register(*SILVER)
    runs, results, company = (store.read(n) for n in SILVER)
    views = {
        "silver_reconciliation_runs_latest": runs_latest(runs),
        "silver_reconciliation_results_current": results_current(runs, results, company),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return dict.fromkeys(views, "ok")


def build_gold(store: Store, as_of: str | None = None) -> dict[str, str]:
    """Build the gold artifacts in dependency order and register them for spark.sql.

    Aggregated artifacts become tables, so that alerts and reports do not go back to the
    results; the ledger is a view. Each table is published by one rename, so a build that dies
    leaves the last version to its readers. With ``as_of`` weeks that closed before it keep
    their stored figures and files.

    Company rows matter to the aggregates without names only where a merchant_id is
    listed twice. This is checked once on the company table; if it is unique, these
    aggregates skip the join of all results with it.
    """
    store.require(*SILVER)
    runs, results, company = (store.read(n) for n in SILVER)
    counted = None
    if not merchants_unique(company):
        logger.warning("merchant_id is not unique in the company table: its results count more than once")
        counted = company
    # Three artifacts sum up the results of the winning runs: these are looked up in the results once.
    winning, folder = stage(results_current(runs, results).select(*SUMMED), "gold-current")

    def counted_once_per_listing(rows: DataFrame) -> DataFrame:
        return rows if counted is None else rows.join(counted.select("merchant_id"), "merchant_id", "left")

    def weekly(name: str, mart: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
        if as_of is not None and store.exists(name):
            # Results of closed weeks fall out before they are summed; a week has all runs of its dates.
            rows = open_runs(rows, store.read(name), as_of)
        return publish_weeks(store, name, mart(rows), as_of)

    current = counted_once_per_listing(winning)
    summary, ranking = "gold_cfo_weekly_summary", "gold_cfo_weekly_merchant_ranking"
    daily, trend = "gold_ops_reconciliation_daily", "gold_ops_reconciliation_trend"
    steps: dict[str, Callable[[], DataFrame]] = {
        daily: lambda: publish_whole(store, daily, marts.ops_daily(runs, current)),
        trend: lambda: publish_whole(store, trend, marts.ops_trend(store.read(daily))),
        "gold_ops_run_history": lambda: publish_whole(store, "gold_ops_run_history", marts.run_history(runs, results)),
        summary: lambda: weekly(summary, marts.cfo_weekly_summary, current),
        ranking: lambda: weekly(ranking, lambda rows: marts.cfo_weekly_merchant_ranking(rows, company), winning),
        "gold_compliance_ledger": lambda: marts.compliance_ledger(runs, results, company),
    }
    built = {}
    for name, step in steps.items():
        step().createOrReplaceTempView(name)
        logger.info("built %s", name)
        built[name] = "ok"
    delete_path(store.spark, folder)
    return built
