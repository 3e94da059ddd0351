import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from golden import as_log, company, results, runs
from tallyspark.plans import build, curated, marts
from tallyspark.sources import changelog

DAY = datetime.date(2024, 1, 8)


def current(spark, extra_runs=(), extra_results=(), extra_company=()):
    return curated.results_current(
        runs(spark, *extra_runs), results(spark, *extra_results), company(spark, *extra_company)
    )


def daily_of(spark, day, extra_runs=()):
    daily = marts.ops_daily(runs(spark, *extra_runs), current(spark, extra_runs))
    return {r.category: r for r in daily.filter(F.col("reference_date") == F.lit(day).cast("date")).collect()}


def test_latest_completed_run_wins(spark):
    rows = daily_of(spark, "2024-01-08")
    assert {r.run_id for r in rows.values()} == {2}
    assert {c: r.txn_count for c, r in rows.items()} == {"MATCHED": 2, "UNRECONCILED_INTERNAL": 1}
    assert rows["MATCHED"].pct_of_total == 0.666667
    assert rows["UNRECONCILED_INTERNAL"].processor_amount_sum is None


def test_equal_start_is_decided_by_id(spark):
    tie = (9, "2024-01-15", "f.csv", "COMPLETED", 1, "2024-01-15 08:00:00")
    assert {r.run_id for r in curated.winning_runs(runs(spark, tie)).collect()} == {2, 3, 9}


def test_failed_after_completed_keeps_counts(spark):
    failed = (5, "2024-01-08", "f1.csv", "FAILED", 3, "2024-01-08 10:00:00")
    rows = daily_of(spark, "2024-01-08", [failed])
    assert {(r.run_id, r.run_status) for r in rows.values()} == {(5, "FAILED")}
    assert rows["MATCHED"].txn_count == 2


def test_date_with_failed_run_only(spark):
    failed = (6, "2024-01-20", "f.csv", "FAILED", 0, "2024-01-20 08:00:00")
    rows = daily_of(spark, "2024-01-20", [failed])
    assert list(rows) == [None]
    assert rows[None].txn_count == 0 and rows[None].pct_of_total is None
    history = marts.run_history(runs(spark, failed), results(spark)).filter("run_id = 6").collect()
    assert [(r.category, r.txn_count, r.pct_of_total) for r in history] == [(None, 0, None)]


def test_history_has_every_run(spark):
    rows = marts.run_history(runs(spark), results(spark)).filter("run_id = 1").collect()
    assert {r.category: (r.txn_count, r.pct_of_total) for r in rows} == {
        "MATCHED": (1, 0.333333),
        "MISMATCHED": (1, 0.333333),
        "UNRECONCILED_INTERNAL": (1, 0.333333),
    }


def test_trend_counts_rows_not_days(spark):
    rows = [("A", f"2024-01-{d:02d}", p) for d, p in zip((1, 2, 5, 6, 7, 8, 9, 20, 21), (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9))]
    rows.append(("B", "2024-01-21", 0.5))
    daily = spark.createDataFrame(rows, "category string, reference_date string, pct_of_total double")
    trend = {(r.category, r.reference_date): r.pct_of_total_7d_avg for r in marts.with_trend(daily).collect()}
    assert trend[("A", "2024-01-01")] is None and trend[("B", "2024-01-21")] is None
    assert trend[("A", "2024-01-05")] == pytest.approx(0.15)
    assert trend[("A", "2024-01-21")] == pytest.approx(0.5)


def test_weeks_and_amounts(spark):
    weekly = {(str(r.week_start), r.category): r for r in marts.cfo_weekly_summary(current(spark)).collect()}
    assert {w for w, _ in weekly} == {"2024-01-08", "2024-01-15"}
    assert weekly[("2024-01-08", "MATCHED")].txn_count == 3
    assert weekly[("2024-01-08", "UNRECONCILED_INTERNAL")].amount_brl == Decimal("300.00")
    assert str(weekly[("2024-01-08", "MATCHED")].week_end) == "2024-01-14"


def test_ranking_has_risk_only(spark):
    bare = curated.results_current(runs(spark), results(spark))
    rows = marts.cfo_weekly_merchant_ranking(bare, company(spark)).collect()
    assert {(r.merchant_id, r.category, r.amount_brl, r.trade_name) for r in rows} == {
        ("M003", "UNRECONCILED_INTERNAL", Decimal("300.00"), "Gama"),
        ("M002", "MISMATCHED", Decimal("240.00"), "Beta"),
    }


def test_merchant_listed_twice_counts_twice(spark):
    other = (4, "M003", "Gama II", "Gama II", "x", "y")
    same = (5, "M002", "Beta Comercio SA", "Beta", "z", "y")
    listed = company(spark, other, same)
    assert not curated.merchants_unique(listed) and curated.merchants_unique(company(spark))
    joined = current(spark, extra_company=(other, same))
    daily = marts.ops_daily(runs(spark), joined).filter("category = 'UNRECONCILED_INTERNAL'").collect()
    assert [r.txn_count for r in daily] == [2]
    bare = curated.results_current(runs(spark), results(spark))
    rows = {(r.merchant_id, r.legal_name): (r.txn_count, r.amount_brl) for r in marts.cfo_weekly_merchant_ranking(bare, listed).collect()}
    assert rows == {
        ("M003", "Gama Servicos ME"): (1, Decimal("300.00")),
        ("M003", "Gama II"): (1, Decimal("300.00")),
        ("M002", "Beta Comercio SA"): (2, Decimal("480.00")),
    }


def test_ledger_has_all_results(spark):
    ledger = marts.compliance_ledger(runs(spark), results(spark), company(spark))
    assert ledger.count() == 9
    assert ledger.filter("run_id = 1").count() == 3
    assert {r.run_id for r in ledger.filter(F.col("reference_date") == DAY).collect()} == {1, 2}


def build_all(spark, store, tmp_path, **kwargs):
    logs = {
        "raw_reconciliation_runs": as_log(runs(spark)),
        "raw_reconciliation_results": as_log(results(spark)),
        "raw_enterprise_company": as_log(company(spark)),
    }
    for name, log in logs.items():
        store.replace(name, log)
    changelog.seed_reconciliation(store)
    changelog.seed_company(store)
    return build.build_silver(store), build.build_gold(store, **kwargs)


def test_build_in_order_and_twice(spark, store, tmp_path):
    silver, gold = build_all(spark, store, tmp_path)
    assert list(silver) == ["silver_reconciliation_runs_latest", "silver_reconciliation_results_current"]
    assert list(gold) == [
        "gold_ops_reconciliation_daily", "gold_ops_reconciliation_trend", "gold_ops_run_history",
        "gold_cfo_weekly_summary", "gold_cfo_weekly_merchant_ranking", "gold_compliance_ledger",
    ]
    before = {n: sorted(map(repr, spark.table(n).collect())) for n in gold}
    build.build_gold(store)
    assert before == {n: sorted(map(repr, spark.table(n).collect())) for n in gold}
    assert spark.sql("SELECT count(*) FROM gold_compliance_ledger").first()[0] == 9
    assert spark.sql("SELECT count(*) FROM silver_reconciliation_results_current").first()[0] == 6


def test_closed_weeks_keep_their_figures(spark, store, tmp_path):
    build_all(spark, store, tmp_path)
    more = as_log(results(spark, (50, 2, "txn-X", "M001", "MATCHED", "1", "1"), (51, 4, "txn-Y", "M001", "MATCHED", "1", "1")))
    store.replace("raw_reconciliation_results", more)
    changelog.seed_reconciliation(store)
    build.build_gold(store, as_of="2024-01-15")
    counts = {str(r.week_start): r.txn_count for r in store.read("gold_cfo_weekly_summary").filter("category = 'MATCHED'").collect()}
    assert counts == {"2024-01-08": 3, "2024-01-15": 2}
