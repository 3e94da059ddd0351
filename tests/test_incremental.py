from pyspark.sql import functions as F

from golden import company, results, runs
from tallyspark.plans import incremental, marts
from tallyspark.session import configure, fresh_dir, shared_dir


def test_trend_reach_is_bounded(spark):
    cells = spark.createDataFrame([("A", f"2024-01-{d:02d}") for d in range(1, 21)], "category string, reference_date string")
    touched = spark.createDataFrame([("2024-01-05",)], "reference_date string")
    reached = sorted(r[0] for r in incremental.trend_reach(cells, cells, touched).collect())
    assert reached == [f"2024-01-{d:02d}" for d in range(5, 13)]


def test_ledger_only_grows(spark, store):
    def ledger(*extra):
        return marts.compliance_ledger(runs(spark), results(spark, *extra), company(spark))

    incremental.append_ledger(store, ledger())
    changed = ledger((60, 4, "new", "M001", "MATCHED", "1", "1")).withColumn("category", F.lit("CHANGED"))
    incremental.append_ledger(store, changed)
    stored = store.read("gold_compliance_ledger")
    assert stored.count() == 10
    assert [r.result_id for r in stored.filter("category = 'CHANGED'").collect()] == [60]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    for day, n in (("2024-01-05", 1), ("2024-01-12", 2), ("2024-01-12", 3)):
        incremental.write_snapshot(spark.range(n), path, day)
    snapshots = spark.read.parquet(path)
    assert incremental.read_as_of(snapshots, "2024-01-11").count() == 1
    assert incremental.read_as_of(snapshots, "2024-02-01").count() == 3
    assert incremental.read_as_of(snapshots, "2023-01-01").count() == 0


def test_export_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "export")
    ledger = marts.compliance_ledger(runs(spark), results(spark), company(spark))
    incremental.export_by_date(ledger, path)
    incremental.export_by_date(ledger.filter("reference_date = '2024-01-15'"), path)
    assert spark.read.parquet(path).count() == 9


def test_upsert_touches_only_its_partitions(spark, store, tmp_path):
    def rows(*values):
        return spark.createDataFrame(values, "k string, d string, v int").select("k", "v", F.col("d").cast("date").alias("reference_date"))

    store.upsert("t", rows(("a", "2024-01-01", 1), ("b", "2024-01-01", 1), ("a", "2024-01-02", 1)), ["k", "reference_date"])
    files = {p.name for p in (tmp_path / "lake" / "t" / "reference_date=2024-01-02").glob("*.parquet")}
    store.upsert("t", rows(("a", "2024-01-01", 2), ("c", "2024-01-01", 2)), ["k", "reference_date"])
    got = {(r.k, str(r.reference_date)): r.v for r in store.read("t").collect()}
    assert got == {("a", "2024-01-01"): 2, ("b", "2024-01-01"): 1, ("c", "2024-01-01"): 2, ("a", "2024-01-02"): 1}
    assert files == {p.name for p in (tmp_path / "lake" / "t" / "reference_date=2024-01-02").glob("*.parquet")}


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
