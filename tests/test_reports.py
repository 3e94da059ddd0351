from decimal import Decimal

from golden import company, results, runs
from tallyspark.plans import checks, curated, marts, reports


def weekly(spark):
    return marts.cfo_weekly_summary(curated.results_current(runs(spark), results(spark)))


def daily(spark):
    return marts.ops_daily(runs(spark), curated.results_current(runs(spark), results(spark)))


def test_cfo_figures(spark):
    summary = weekly(spark)
    assert [str(v) for v in reports.period_range(summary).first()] == ["2024-01-08", "2024-01-21"]
    assert reports.period_range(summary.filter("false")).count() == 0
    totals = reports.category_totals(summary)
    head = reports.headline(totals).first()
    assert (head.total_brl, head.total_txn) == (Decimal("960.00"), 6)
    shares = {r.label: r.share for r in reports.category_shares(totals).collect()}
    assert shares["UNR_INTERNAL"] == 300 / 960 and sum(shares.values()) == 1.0
    rollup = {str(r.week_start): (r.categories, r.total_txns) for r in checks.weekly_rollup(summary).collect()}
    assert rollup == {"2024-01-08": (3, 5), "2024-01-15": (1, 1)}


def test_daily_table_fills_absent_categories(spark):
    rows = {str(r.reference_date): r for r in reports.daily_table(daily(spark)).collect()}
    first = rows["2024-01-08"]
    assert (first.matched, first.mismatched, first.unreconciled_internal) == (Decimal("150.00"), 0, Decimal("300.00"))
    assert (first.total, first.txns) == (Decimal("450.00"), 3)


def test_top_merchants(spark):
    bare = curated.results_current(runs(spark), results(spark))
    ranking = marts.cfo_weekly_merchant_ranking(bare, company(spark))
    top = [(r.rank, r.merchant, r.amount_brl) for r in reports.top_merchants(ranking).orderBy("rank").collect()]
    assert top == [(1, "Gama", Decimal("300.00")), (2, "Beta", Decimal("240.00"))]
    assert [r.merchant for r in reports.top_merchants(ranking, 1).collect()] == ["Gama"]


def history(spark):
    failed = (7, "2024-01-14", "f.csv", "FAILED", 0, "2024-01-14 10:00:00")
    return marts.run_history(runs(spark, failed), results(spark))


def test_nested_runs(spark):
    nested = {r.run_id: r for r in reports.breakdown_text(reports.nested_runs(history(spark))).collect()}
    assert nested[7].categories == [] and nested[7].breakdown == "no results"
    assert nested[2].breakdown == "MATCHED: 2 (66.7%); UNRECONCILED_INTERNAL: 1 (33.3%)"


def test_calendar_keeps_empty_days(spark):
    rows = reports.report_calendar(history(spark)).collect()
    assert {str(r.reference_date) for r in rows} == {f"2024-01-{d:02d}" for d in range(8, 16)}
    assert {r.run_id for r in rows} == {1, 2, 3, 4, 7, None}
    shifted = reports.report_calendar(history(spark), "2024-01-10").collect()
    assert {r.run_id for r in shifted} == {1, 2, None} and len({r.reference_date for r in shifted}) == 8
    assert reports.report_calendar(history(spark).filter("false")).count() == 0


def test_report_order(spark):
    window = reports.runs_between(history(spark), "2024-01-14", "2024-01-15")
    got = [(r.run_id, r.category) for r in reports.in_report_order(window).collect()]
    assert got == [(4, "MATCHED"), (7, None), (3, "MATCHED"), (3, "MISMATCHED")]
