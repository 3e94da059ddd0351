"""Silver tables are written once, results of winning runs are looked up once."""

import datetime
from pathlib import Path

from tallyspark.plans import build
from tallyspark.schemas import COMPANY, RESULTS, RESULTS_RAW, RUNS, RUNS_RAW
from tallyspark.sources import changelog


def _log(spark, store, merchant):
    at = "2024-01-01T00:00:00+00:00"
    runs = [(1, "2024-01-01", "f", "COMPLETED", 1, at, at, at, "I", at)]
    results = [(i, 1, f"t{i}", merchant, "MATCHED", 1.0, 1.0, 0.0, at, "I", at) for i in range(3)]
    store.replace("raw_reconciliation_runs", spark.createDataFrame(runs, RUNS_RAW))
    store.replace("raw_reconciliation_results", spark.createDataFrame(results, RESULTS_RAW))


def test_staged_silver_becomes_the_table_without_a_second_write(spark, store, monkeypatch):
    written = []
    replace = type(store).replace
    monkeypatch.setattr(type(store), "replace", lambda self, name, *a, **b: written.append(name) or replace(self, name, *a, **b))
    for merchant in ("a", "b"):  # the second time over an existing table
        _log(spark, store, merchant)
        assert changelog.seed_reconciliation(store) == {"runs_loaded": 1, "results_loaded": 3}
        assert {r.merchant_id for r in store.read("silver_reconciliation_results").collect()} == {merchant}
    assert not [name for name in written if name.startswith("silver")]
    assert sorted(p.name for p in Path(store.root).iterdir() if p.name.startswith("silver")) == ["silver_reconciliation_results", "silver_reconciliation_runs"]


def test_gold_looks_winning_results_up_once_and_counts_each_listing(spark, store, monkeypatch):
    day, at = datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1)
    runs = [(1, day, "f", "COMPLETED", 1, at, at, at, "s"), (2, day, "f", "COMPLETED", 1, at + datetime.timedelta(1), at, at, "s")]
    results = [(i, 1 + i % 2, f"t{i}", "m" if i < 6 else None, "MISMATCHED", 1, 1, 0, at, "s") for i in range(8)]
    results = [(*r[:5], *(None if v is None else __import__("decimal").Decimal(v) for v in r[5:8]), *r[8:]) for r in results]
    company = [(k, "m", f"name {k}", "t", "d", "c", at, at) for k in (1, 2)]
    for name, rows, schema in zip(build.SILVER, (runs, results, company), (RUNS, RESULTS, COMPANY)):
        store.replace(name, spark.createDataFrame(rows, schema))
    looked_up, found = [], build.results_current
    monkeypatch.setattr(build, "results_current", lambda *a: looked_up.append(1) or found(*a))
    build.build_gold(store)
    assert len(looked_up) == 1
    # Of run 2: ids 1, 3, 5 of the merchant listed twice, id 7 of none.
    assert [r.txn_count for r in store.read("gold_ops_reconciliation_daily").collect()] == [7]
    assert [r.txn_count for r in store.read("gold_cfo_weekly_summary").collect()] == [7]
    ranking = store.read("gold_cfo_weekly_merchant_ranking").collect()
    assert sorted((r.legal_name or "", r.txn_count) for r in ranking) == [("", 1), ("name 1", 3), ("name 2", 3)]
