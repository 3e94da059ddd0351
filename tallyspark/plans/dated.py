"""Results, gold artifacts and ledger stored by period and kept up date by date.

Results lie under the date of their run. When results of some dates arrive, every artifact is rebuilt for the partitions
these dates lie in and for no others: the scans are pruned by literals, one per calendar period, and each artifact is
published by one rename.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.functions.dates import in_dates, period_of, week_end
from tallyspark.operators import quality
from tallyspark.plans import marts
from tallyspark.plans.curated import results_current
from tallyspark.plans.incremental import trend_reach
from tallyspark.sources.published import PERIOD
from tallyspark.sources.store import Store, delete_path, same_keys, stage

RESULTS, CURRENT = "silver_results_by_date", "silver_results_current"
DAILY, TREND, HISTORY = "gold_ops_reconciliation_daily", "gold_ops_reconciliation_trend", "gold_ops_run_history"
SUMMARY, RANKING = "gold_cfo_weekly_summary", "gold_cfo_weekly_merchant_ranking"
CHECKS = "gold_quality_daily"
LEDGER, LEDGER_RUNS = "gold_compliance_ledger", "gold_compliance_ledger_runs"
#: Marts with a few rows per date or week lie by year, as a partition is a file at least; the ranking has a row per merchant.
GRAINS = {DAILY: "year", TREND: "year", HISTORY: "year", SUMMARY: "year", RANKING: "month", CHECKS: "year"}


def _period(grain: str, column: str = "reference_date") -> Column:
    return F.trunc(F.col(column), grain) if grain != "day" else F.col(column)


def _periods(dates: list[datetime.date], grain: str) -> list[datetime.date]:
    """The periods of some dates, in order."""
    return sorted({period_of(d, grain) for d in dates})


def add_results(store: Store, runs: DataFrame, fresh: DataFrame, grain: str = "day") -> list[datetime.date]:
    """Put results under the date of their run; returns the dates that have new or changed rows, or runs without any.

    ``fresh`` has each result id once. A result that is there already is replaced: only partitions of the dates at hand
    are read and written, as a result stays with its run. Results without a known run are left out, as by every
    artifact. ``grain`` is "day", "week", "month" or "year" and must stay the same for a store.
    """
    dates = runs.select(F.col("id").alias("run_id"), "reference_date")
    # A calendar date each; of the new results only the run ids are read for it.
    sent_runs = fresh.select("run_id").distinct()
    touched = [r[0] for r in dates.join(sent_runs, "run_id").select("reference_date").distinct().collect()]
    rows = fresh.join(dates, "run_id").withColumn(PERIOD, _period(grain)).select(*fresh.columns, "reference_date", PERIOD)
    if store.exists(RESULTS):
        stored = _stored(store, RESULTS, touched, grain)
        sent = rows.select(F.col("id").alias("id"))
        rows = rows.unionByName(stored.join(sent, same_keys(stored, sent, ["id"]), "left_anti"))
    store.publish(RESULTS, rows, PERIOD)
    return sorted(touched)


def _stored(store: Store, name: str, dates: list[datetime.date], grain: str) -> DataFrame:
    """The partitions that some dates lie in, with the partition column."""
    return store.published(name).read().filter(in_dates(PERIOD, _periods(dates, grain), grain))


def results_of(store: Store, dates: list[datetime.date], grain: str = "day") -> DataFrame:
    """Stored results of some dates: other partitions are not read."""
    stored = _stored(store, RESULTS, dates, grain)
    return stored.filter(in_dates("reference_date", dates)).drop(PERIOD, "reference_date")


def _column(name: str) -> str:
    return "week_start" if name in (SUMMARY, RANKING) else "reference_date"


def publish_whole(store: Store, name: str, whole: DataFrame) -> DataFrame:
    """A mart from a full build, laid out as the refresh by date expects it."""
    rows = whole.withColumn(PERIOD, _period(GRAINS[name], _column(name)))
    store.publish(name, rows, PERIOD, store.published(name).partitions())
    return store.read(name)


def _replace(store: Store, name: str, fresh: DataFrame, days: list[datetime.date], grain: str) -> None:
    """Publish the rows of some dates or weeks; rows of others in the same partitions are taken over."""
    column = _column(name)
    fresh = fresh.withColumn(PERIOD, _period(grain, column))
    if store.published(name).exists():
        fresh = fresh.unionByName(_stored(store, name, days, grain).filter(~in_dates(column, days, "week" if column == "week_start" else "day")))
    store.publish(name, fresh, PERIOD, _periods(days, grain))


def refresh_current(
    store: Store, runs: DataFrame, company: DataFrame, dates: list[datetime.date], grain: str = "day"
) -> None:
    """The results of the winning runs with merchant names, stored; only some dates are found anew."""
    touched = runs.filter(in_dates("reference_date", dates))
    _replace(store, CURRENT, results_current(touched, results_of(store, dates, grain), company), dates, grain)


def current_of(store: Store, dates: list[datetime.date], grain: str = "day") -> DataFrame:
    stored = _stored(store, CURRENT, dates, grain)
    return stored.filter(in_dates("reference_date", dates)).drop(PERIOD)


def refresh_daily(store: Store, runs: DataFrame, dates: list[datetime.date], grain: str = "day") -> DataFrame:
    """The daily mart, with the rows of some dates built anew from the stored results of their winning runs."""
    touched = runs.filter(in_dates("reference_date", dates))
    _replace(store, DAILY, marts.ops_daily(touched, current_of(store, dates, grain)), dates, GRAINS[DAILY])
    return store.read(DAILY)


def refresh_ops(store: Store, runs: DataFrame, dates: list[datetime.date], grain: str = "day") -> None:
    """Daily, trend and run history of some dates, and trend rows up to seven rows later."""
    before = store.read(DAILY) if store.published(DAILY).exists() else None
    daily = refresh_daily(store, runs, dates, grain)
    marked = store.spark.createDataFrame([(d,) for d in dates], "reference_date date")
    reached = [r[0] for r in trend_reach(daily if before is None else before, daily, marked).collect()]
    # The daily mart has a row per date and category; its trend is computed whole and published where it changed.
    trend = marts.ops_trend(daily).withColumn(PERIOD, _period(GRAINS[TREND]))
    periods = _periods(reached, GRAINS[TREND])
    store.publish(TREND, trend.filter(in_dates(PERIOD, periods, GRAINS[TREND])), PERIOD, periods)
    refresh_history(store, runs, dates, grain)


def refresh_history(store: Store, runs: DataFrame, dates: list[datetime.date], grain: str = "day") -> None:
    touched = runs.filter(in_dates("reference_date", dates))
    _replace(store, HISTORY, marts.run_history(touched, results_of(store, dates, grain)), dates, GRAINS[HISTORY])


def refresh_checks(store: Store, dates: list[datetime.date]) -> None:
    """The daily checks from the first of some dates on; before it, only the moments of the last date are read."""
    first, moments = min(dates), quality.NO_MOMENTS
    day = F.lit(first).cast("date")
    if store.published(CHECKS).exists():
        last = store.read(CHECKS).filter(F.col("reference_date") < day).orderBy(F.desc("reference_date")).select("n", "mean", "m2").first()
        moments = last.asDict() if last else moments
    daily = store.published(DAILY).read()
    # The mart's partitions before the first date's are not read.
    period = F.lit(period_of(first, GRAINS[DAILY])).cast("date")
    fresh = quality.daily_checks_after(daily.filter((F.col(PERIOD) >= period) & (F.col("reference_date") >= day)), moments)
    later = [datetime.date.fromisoformat(p) for p in store.published(CHECKS).partitions() if p >= period_of(first, GRAINS[CHECKS]).isoformat()]
    rows = fresh.withColumn(PERIOD, _period(GRAINS[CHECKS]))
    if later:
        rows = rows.unionByName(store.published(CHECKS).read().filter(in_dates(PERIOD, later, GRAINS[CHECKS])).filter(F.col("reference_date") < day))
    store.publish(CHECKS, rows, PERIOD, later)


def open_weeks(store: Store, name: str, dates: list[datetime.date], as_of: str | None = None) -> list[datetime.date]:
    """Weeks of some dates, without those that are stored and ended before ``as_of``: these never change again."""
    weeks = _periods(dates, "week")
    if as_of is None or not store.published(name).exists():
        return weeks
    closed = _stored(store, name, weeks, GRAINS[name]).filter(week_end(F.col("week_start")) < F.lit(as_of).cast("date"))
    # One row per calendar week.
    return sorted(set(weeks) - {r[0] for r in closed.select("week_start").distinct().collect()})


def refresh_weeks(store: Store, dates: list[datetime.date], as_of: str | None = None, grain: str = "day") -> None:
    """Weekly summary and merchant ranking of the weeks that some dates lie in; closed weeks stay as they are."""
    # Stored results carry the names: a merchant listed twice has its rows twice, once under each name.
    for name, mart in ((SUMMARY, marts.cfo_weekly_summary), (RANKING, marts.cfo_weekly_ranking_of_named)):
        weeks = open_weeks(store, name, dates, as_of)
        if weeks:
            days = [w + datetime.timedelta(i) for w in weeks for i in range(7)]
            _replace(store, name, mart(current_of(store, days, grain)), weeks, GRAINS[name])


def publish_weeks(store: Store, name: str, fresh: DataFrame, as_of: str | None = None) -> DataFrame:
    """A weekly mart from a full build; stored weeks that ended before ``as_of`` keep their rows, and closed periods their files."""
    if as_of is None or not store.exists(name):
        return publish_whole(store, name, fresh)
    stored = store.read(name)
    closed = stored.filter(week_end(F.col("week_start")) < F.lit(as_of).cast("date"))
    # One row per calendar week.
    weeks = [r[0] for r in closed.select("week_start").distinct().collect()]
    rows = fresh.filter(~in_dates("week_start", weeks, "week")).withColumn(PERIOD, _period(GRAINS[name], "week_start"))
    open_periods = {r[0] for r in rows.select(PERIOD).distinct().collect()}
    open_periods |= set(_periods([r[0] for r in stored.select("week_start").distinct().collect() if r[0] not in set(weeks)], GRAINS[name]))
    kept = closed.withColumn(PERIOD, _period(GRAINS[name], "week_start"))
    if store.published(name).exists():  # a plain table is taken over whole
        kept = kept.filter(in_dates(PERIOD, open_periods, GRAINS[name]))
    store.publish(name, rows.unionByName(kept), PERIOD, open_periods)
    return store.read(name)


def runs_not_in_ledger(store: Store, stored: DataFrame) -> DataFrame:
    """(run_id, period, rows, ids) of runs that the ledger's manifest does not have, or has with other results.

    ``stored`` are results by date. A run is known by the number of its results and an order-free hash of their ids.
    """
    ids = F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("ids")
    found = stored.groupBy("run_id", PERIOD).agg(F.count("*").alias("rows"), ids)
    if not store.published(LEDGER_RUNS).exists():
        return found
    known = store.published(LEDGER_RUNS).read()
    return found.join(known, ["run_id", PERIOD, "rows", "ids"], "left_anti")


def _without(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Results whose id is not among ``kept``; NULL is an id like any other.

    Which these are is found out on ids alone. The rows meet the outcome by run and id, so that they stay where the
    joins by run want them and are not dealt out by id in between.
    """
    ids = rows.select(F.col("id").alias("_id"), F.col("run_id").alias("_run"))
    gone = ids.join(kept, ids["_id"].eqNullSafe(kept["result_id"]), "left_semi")
    return rows.join(gone, (F.col("run_id") == F.col("_run")) & F.col("id").eqNullSafe(F.col("_id")), "left_anti")


@contextmanager
def _dealt_by_run(spark: SparkSession) -> Iterator[None]:
    """Joins by run and id take rows as they lie by run, instead of dealing them out once more by both."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_ledger_by_run(
    store: Store, runs: DataFrame, company: DataFrame, dates: list[datetime.date] | None = None, grain: str = "day"
) -> int:
    """Append the results of new and grown runs to the ledger, and note the runs; returns the number of runs.

    Only ids are read to tell which runs are new. Their results are joined once and written once. What a run has in the
    ledger already is found by id in the partitions of its date, so that a job that died between ledger and manifest
    adds nothing twice when it is run again. Rows in the ledger are never rewritten, its files keep their names.
    """
    stored = store.published(RESULTS).read() if dates is None else _stored(store, RESULTS, dates, grain)
    if dates is not None:
        stored = stored.filter(in_dates("reference_date", dates))
    changed, folder = stage(runs_not_in_ledger(store, stored), "ledger-runs")
    # A calendar period each.
    touched = [r[0] for r in changed.select(PERIOD).distinct().collect()]
    if touched:
        rows = stored.filter(in_dates(PERIOD, touched, grain)).join(changed.select("run_id"), "run_id", "left_semi")
        if store.published(LEDGER).exists():
            kept = store.published(LEDGER).read().filter(in_dates(PERIOD, touched, grain)).select("result_id")
            rows = _without(rows, kept)
        fresh = marts.compliance_ledger(runs, rows.drop(PERIOD, "reference_date"), company).withColumn(PERIOD, _period(grain))
        with _dealt_by_run(store.spark):
            store.publish(LEDGER, fresh, PERIOD, append=True)
        store.publish(LEDGER_RUNS, changed, PERIOD, append=True)
    count = changed.count()
    delete_path(store.spark, folder)
    return count


def refresh(
    store: Store,
    runs: DataFrame,
    company: DataFrame,
    dates: list[datetime.date],
    as_of: str | None = None,
    grain: str = "day",
) -> None:
    """Bring every artifact up to date for some dates."""
    if not dates:
        return
    refresh_current(store, runs, company, dates, grain)
    refresh_ops(store, runs, dates, grain)
    refresh_weeks(store, dates, as_of, grain)
    append_ledger_by_run(store, runs, company, dates, grain)
