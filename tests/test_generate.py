import pytest
from pyspark.sql import functions as F

from tallyspark.datagen import generate
from tallyspark.datagen.generate import Fixture
from tallyspark.operators import reconcile
from tallyspark.operators.profile import fingerprint
from tallyspark.plans import build, checks
from tallyspark.sources import changelog, settlements as csv

SMALL = Fixture(rows=5000, days=10, merchants=20)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("generated"))
    generate.write_all(spark, SMALL, path)
    return path


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(spark, folder):
    return changelog.read_batches(spark, [f"{folder}/transactions_batch_{i}.parquet" for i in (1, 2)])


def test_drift_and_row_counts(spark, folder):
    assert "payment_method" not in read(spark, folder, "transactions_batch_1").columns
    assert "payment_method" in read(spark, folder, "transactions_batch_2").columns
    assert read(spark, folder, "reconciliation_results").count() == SMALL.rows


def test_category_bands(spark, folder):
    mix = checks.category_mix(read(spark, folder, "reconciliation_results")).collect()
    assert len(mix) == 4 and all(r.in_band for r in mix)


def test_runs_come_in_pairs(spark, folder):
    ops = {r.Op: r.n for r in checks.operations(read(spark, folder, "reconciliation_runs")).collect()}
    assert ops["I"] == ops["U"] > 0


def test_unreconciled_processor_is_absent_from_internal(spark, folder):
    theirs = read(spark, folder, "reconciliation_results").filter("category = 'UNRECONCILED_PROCESSOR'")
    assert checks.present_in(theirs, transactions(spark, folder), "transaction_id").count() == 0


def dirt(spark, fixture):
    lines = generate.settlement_lines(spark, fixture)
    log = generate.transaction_logs(spark, fixture)
    counts = lines.agg(
        F.count_if(~F.col("settled_at").endswith("Z")).alias("no_zone"),
        F.count_if(F.col("amount").contains(",")).alias("comma"),
        F.count_if(F.col("merchant_id").startswith("merch")).alias("lower_case"),
        F.count_if(F.col("processor_reference").startswith("PS-ORPHAN")).alias("orphans"),
    ).first().asDict()
    replays = log[0].unionByName(log[1], allowMissingColumns=True)
    counts["replays"] = replays.count() - replays.select("transaction_id").distinct().count()
    counts["null_merchants"] = replays.filter("merchant_id IS NULL").count()
    return counts


def test_dirty_and_clean_modes(spark):
    big = Fixture(rows=60000, days=10, merchants=20)
    assert all(n > 0 for n in dirt(spark, big).values())
    clean = Fixture(rows=60000, days=10, merchants=20, dirty=False)
    assert set(dirt(spark, clean).values()) == {0}


def test_same_data_under_any_partitioning(spark):
    prints = {
        fingerprint(generate.results_log(spark, Fixture(rows=2000, partitions=n)).select(F.to_json(F.struct("*")).alias("x")), "x").first()
        for n in (1, 8)
    }
    assert len(prints) == 1
    other = generate.results_log(spark, Fixture(rows=2000, seed=7)).select(F.to_json(F.struct("*")).alias("x"))
    assert fingerprint(other, "x").first() not in prints


def test_whole_way_from_extracts_to_gold(spark, store, folder):
    counts = changelog.load_transactions(store, [f"{folder}/transactions_batch_{i}.parquet" for i in (1, 2)])
    assert counts["raw"] - counts["removed"] == counts["final"]
    for raw, name in {
        "raw_reconciliation_runs": "reconciliation_runs",
        "raw_reconciliation_results": "reconciliation_results",
        "raw_enterprise_company": "enterprise_company",
    }.items():
        changelog.land(store, raw, f"{folder}/{name}.parquet")
    changelog.seed_reconciliation(store)
    changelog.seed_company(store)
    verdicts = csv.judge_and_load(store, f"{folder}/paysettler", r"file_date=(\d{4}-\d{2}-\d{2})", recursive=True)
    assert verdicts.filter(F.size("reasons") > 0).count() == 0
    settled = store.read(csv.TABLE)
    assert settled.count() == generate.settlement_lines(spark, SMALL).count()
    build.build_silver(store)
    assert set(build.build_gold(store).values()) == {"ok"}
    assert spark.table("gold_compliance_ledger").count() == SMALL.rows

    # Recomputing the categories agrees with the stored ones, late settlements aside.
    current = reconcile.reconcile(store.read("raw_transactions"), settled)
    late = store.read("silver_reconciliation_results").join(
        current.groupBy("transaction_id").count().filter("count > 1"), "transaction_id", "left_anti"
    )
    known = checks.present_in(current, late, "transaction_id")
    matrix = reconcile.audit_categories(late, known).collect()
    assert matrix and all(r.stored == r.recomputed for r in matrix)
