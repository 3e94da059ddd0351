import pytest
from pyspark.sql import functions as F

from golden import as_log, company, results, runs
from tallyspark.operators import cdc
from tallyspark.sources import changelog

LOG = "k string, v int, Op string, _timestamp string"


def latest(spark, *rows):
    state = cdc.latest_state(spark.createDataFrame(rows, LOG), "k", tie_breakers=("v",))
    return {r.k: r.v for r in state.collect()}


def test_latest_change_wins_and_deletes_are_dropped_after_ranking(spark):
    state = latest(
        spark,
        ("a", 1, "I", "2025-01-01"), ("a", 2, "U", "2025-01-02"),
        ("b", 1, "I", "2025-01-01"), ("b", 2, "D", "2025-01-02"),
        ("c", 1, "D", "2025-01-01"), ("c", 2, "I", "2025-01-02"),
        ("d", 1, "I", "2025-01-01"), ("d", 2, None, "2025-01-02"),
        ("e", 5, "U", "2025-01-01"), ("e", 9, "U", "2025-01-01"),
    )
    assert state == {"a": 2, "c": 2, "e": 9}


def test_plan_limits_groups_before_the_shuffle(spark):
    log = spark.createDataFrame([("a", 1, "I", "x")], LOG)
    plan = cdc.latest_state(log, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_union_of_drifted_batches(spark):
    one = spark.createDataFrame([(1, "a")], "id int, k string")
    two = spark.createDataFrame([("b", 2, "pix")], "k string, id long, payment_method string")
    rows = sorted(tuple(r) for r in cdc.union_batches([one, two]).collect())
    assert rows == [(1, "a", None), (2, "b", "pix")]


def test_load_transactions(spark, store, tmp_path):
    first = spark.createDataFrame(
        [(1, "t1", 1.0, "I", "2025-01-01T00:00:00+00:00"), (2, "t2", 2.0, "I", "2025-01-01T00:00:00+00:00"), (3, "t3", 1.0, "I", "2025-01-01T00:00:00+00:00")],
        "id long, transaction_id string, amount double, Op string, _timestamp string",
    )
    second = spark.createDataFrame(
        [(4, "t1", 9.0, "U", "2025-01-02T00:00:00+00:00", "pix"), (5, "t2", 2.0, "D", "2025-01-02T00:00:00+00:00", None)],
        "id long, transaction_id string, amount double, Op string, _timestamp string, payment_method string",
    )
    paths = [str(tmp_path / "b1.parquet"), str(tmp_path / "b2.parquet")]
    first.write.parquet(paths[0])
    second.write.parquet(paths[1])
    for _ in range(2):
        assert changelog.load_transactions(store, paths) == {"raw": 5, "final": 2, "removed": 3}
    rows = {r.transaction_id: (r.id, r.payment_method) for r in store.read("raw_transactions").collect()}
    assert rows == {"t1": (4, "pix"), "t3": (3, None)}


def test_null_timestamp_stops_the_load(spark, store, tmp_path):
    path = str(tmp_path / "b.parquet")
    spark.createDataFrame([(1, "t", "I", None)], "id long, transaction_id string, Op string, _timestamp string").write.parquet(path)
    with pytest.raises(ValueError, match="NULL in 1 row"):
        changelog.load_transactions(store, [path])
    assert not store.exists("raw_transactions")


def test_missing_batch(store, tmp_path):
    with pytest.raises(FileNotFoundError):
        changelog.load_transactions(store, [str(tmp_path / "none.parquet")])


def test_land_and_seed(spark, store, tmp_path):
    with pytest.raises(RuntimeError, match="raw_reconciliation_runs"):
        changelog.seed_reconciliation(store)
    sources = {
        "raw_reconciliation_runs": as_log(runs(spark)),
        "raw_reconciliation_results": as_log(results(spark)),
        "raw_enterprise_company": as_log(company(spark)),
    }
    for name, log in sources.items():
        log.write.parquet(str(tmp_path / name))
        assert changelog.land(store, name, str(tmp_path / name)) == log.count()
    assert changelog.seed_reconciliation(store) == {"runs_loaded": 4, "results_loaded": 9}
    assert changelog.seed_company(store) == 3
    seeded = store.read("silver_reconciliation_results")
    assert dict(seeded.dtypes)["internal_amount"] == "decimal(18,2)"
    assert {r.source for r in seeded.select("source").collect()} == {"historical_backfill"}
    assert seeded.drop("source").exceptAll(results(spark).drop("source")).count() == 0


def test_null_key_is_refused(spark, store):
    log = as_log(company(spark)).withColumn("id", F.lit(None).cast("long"))
    store.replace("raw_enterprise_company", log)
    with pytest.raises(ValueError, match="id is NULL"):
        changelog.seed_company(store)


def test_history_splits_by_bucket(spark):
    rows = [
        ("a", 1, "I", "2025-01-05 00:00:00"), ("a", 2, "U", "2025-01-20 00:00:00"),
        ("a", 3, "U", "2025-03-01 00:00:00"), ("a", 4, "D", "2025-03-02 00:00:00"),
        ("b", 1, "I", "2025-02-01 00:00:00"),
    ]
    versions = cdc.versioned_history(spark.createDataFrame(rows, LOG), "k", tie_breakers=("v",))
    got = sorted(
        (r.k, r.v, str(r.valid_from)[:10], r.valid_to and str(r.valid_to)[:10], r.is_current) for r in versions.collect()
    )
    assert got == [
        ("a", 1, "2025-01-05", "2025-01-20", False),
        ("a", 2, "2025-01-20", "2025-03-01", False),
        ("a", 3, "2025-03-01", "2025-03-02", False),
        ("b", 1, "2025-02-01", None, True),
    ]


def test_history_of_a_hot_key_is_cut_into_ranges(spark):
    """One key has most changes of one month, many at the same time; ranges are bounded and give what one window gives."""
    from pyspark.sql import Window, functions as F

    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.col("id").cast("int").alias("v"),
        F.when(F.col("id") % 11 == 0, "D").otherwise("U").alias("Op"),
        F.timestamp_seconds(1700000000 + (F.col("id") * 7919) % 900 * 2000).alias("_timestamp"),
    )
    stamped = rows.withColumn("_at", F.col("_timestamp")).withColumn("_bucket", F.date_trunc("month", "_at"))
    ranged = cdc._in_ranges(stamped, "k", ("v",), 300)
    sizes = [r["count"] for r in ranged.filter("_range > 0").groupBy("_range").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 900 and ranged.count() == 6000
    lead = F.lead("_timestamp").over(Window.partitionBy("k").orderBy("_timestamp", "v"))
    want = rows.withColumn("valid_to", lead).filter("Op <> 'D'").select("k", "v", F.col("_timestamp").alias("valid_from"), "valid_to")
    got = cdc.versioned_history(rows, "k", tie_breakers=("v",), hot_changes=300).select("k", "v", "valid_from", "valid_to")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
