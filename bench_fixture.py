"""Times the whole way on generated extracts: bench_fixture.py ROWS FOLDER [CPUS]"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from tallyspark.datagen.generate import Fixture, write_all
from tallyspark.operators.reconcile import audit_categories, reconcile
from tallyspark.plans import alerts, build
from tallyspark.plans.marts import with_trend
from tallyspark.session import create_session
from tallyspark.sources import changelog, settlements
from tallyspark.sources.store import Store


def main() -> None:
    rows, folder = int(sys.argv[1]), sys.argv[2].rstrip("/")
    cpus = sys.argv[3] if len(sys.argv) > 3 else "8"
    conf = {"spark.sql.shuffle.partitions": "32", "spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    spark = create_session("bench-fixture", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    store, seconds = Store(spark, f"{folder}/lake"), {}

    def timed(name, step):
        start = time.perf_counter()
        result = step()
        seconds[name] = round(time.perf_counter() - start, 1)
        print(name, seconds[name], result, file=sys.stderr, flush=True)

    extracts = f"{folder}/extracts"
    timed("generate", lambda: write_all(spark, Fixture(rows=rows), extracts))
    batches = [f"{extracts}/transactions_batch_{i}.parquet" for i in (1, 2)]
    timed("transactions", lambda: changelog.load_transactions(store, batches))
    for raw, name in {
        "raw_reconciliation_runs": "reconciliation_runs",
        "raw_reconciliation_results": "reconciliation_results",
        "raw_enterprise_company": "enterprise_company",
    }.items():
        timed(f"land_{name}", lambda: changelog.land(store, raw, f"{extracts}/{name}.parquet"))
    timed("seed_reconciliation", lambda: changelog.seed_reconciliation(store))
    timed("seed_company", lambda: changelog.seed_company(store))
    pattern = r"file_date=(\d{4}-\d{2}-\d{2})"
    timed(
        "settlements",
        lambda: settlements.judge_and_load(store, f"{extracts}/paysettler", pattern, recursive=True)
        .agg(F.sum("loaded"), F.count_if(F.size("reasons") > 0)).first(),
    )
    timed("silver_views", lambda: build.build_silver(store))
    timed("gold", lambda: build.build_gold(store))
    daily = store.read("gold_ops_reconciliation_daily")
    timed("alerts", lambda: alerts.payload(alerts.evaluate(with_trend(daily))).count())
    matched = reconcile(store.read("raw_transactions"), store.read(settlements.TABLE))
    stored = store.read("silver_reconciliation_results")
    timed("reconcile_and_audit", lambda: audit_categories(stored, matched).collect())
    print(json.dumps({"rows": rows, "cpus": int(cpus), "seconds": seconds}))


if __name__ == "__main__":
    main()
