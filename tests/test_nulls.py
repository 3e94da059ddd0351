"""Writers and histories where keys, partitions or times are NULL."""

from pyspark.sql import functions as F

from tallyspark.operators import cdc
from tallyspark.plans import incremental
from tallyspark.sources import store as stores
from tallyspark.streaming import changes

ROWS = "k string, reference_date date, v int"


def content(frame):
    return sorted((repr(r.k), r.v) for r in frame.collect())


def dated(spark, *rows):
    frame = spark.createDataFrame([(k, d, v) for k, d, v in rows], "k string, d string, v int")
    return frame.select("k", F.col("d").cast("date").alias("reference_date"), "v")


def test_upsert_keeps_the_null_partition_and_replaces_null_keys(spark, store):
    store.upsert("t", dated(spark, ("a", None, 1), ("b", None, 1), (None, None, 1), ("c", "2025-01-01", 1)), ["k", "reference_date"])
    store.upsert("t", dated(spark, ("z", None, 2), ("b", None, 2), (None, None, 2)), ["k", "reference_date"])
    assert content(store.read("t")) == [("'a'", 1), ("'b'", 2), ("'c'", 1), ("'z'", 2), ("None", 2)]
    store.upsert("t", dated(spark, ("c", "2025-01-01", 3)), ["k", "reference_date"])
    assert content(store.read("t")) == [("'a'", 1), ("'b'", 2), ("'c'", 3), ("'z'", 2), ("None", 2)]


def test_many_partitions_are_joined_instead_of_listed(spark, store, monkeypatch):
    monkeypatch.setattr(stores, "LITERAL_PARTITIONS", 1)
    store.upsert("t", dated(spark, ("a", None, 1), ("b", "2025-01-01", 1), ("c", "2025-01-02", 1)), ["k"])
    store.upsert("t", dated(spark, ("x", None, 2), ("y", "2025-01-01", 2)), ["k"])
    assert content(store.read("t")) == [("'a'", 1), ("'b'", 1), ("'c'", 1), ("'x'", 2), ("'y'", 2)]


def test_state_merge_keeps_null_keys_and_partitions(spark, store):
    handle = changes.merge_changes_handler(store, "state", "k", ["v"], partition=F.col("reference_date"))
    handle(dated(spark, ("a", None, 1), (None, None, 5), ("b", "2025-01-01", 2)), 0)
    handle(dated(spark, ("c", None, 3), (None, None, 4), ("b", "2025-01-01", 1)), 1)
    assert content(store.read("state")) == [("'a'", 1), ("'b'", 2), ("'c'", 3), ("None", 5)]


def test_ledger_appends_null_dates_once(spark, store):
    rows = dated(spark, ("a", None, 1), ("b", "2025-01-01", 2), (None, None, 3)).withColumnRenamed("k", "result_id")
    incremental.append_ledger(store, rows, "ledger")
    incremental.append_ledger(store, rows, "ledger")
    assert store.read("ledger").count() == 3


def test_history_keeps_changes_without_key_or_time(spark):
    log = spark.createDataFrame(
        [("a", 1, "I", "2025-01-01 00:00:00"), ("a", 2, "U", None), ("a", 3, "U", "2025-02-01 00:00:00"),
         (None, 4, "I", "2025-01-01 00:00:00"), (None, 5, "U", "2025-03-01 00:00:00"), (None, 6, "U", None)],
        "k string, v int, Op string, _timestamp string",
    )
    got = {r.v: (str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current) for r in cdc.versioned_history(log, "k").collect()}
    assert got == {
        1: ("2025-01-01", "2025-02-01", False), 2: ("None", "None", False), 3: ("2025-02-01", "None", True),
        4: ("2025-01-01", "2025-03-01", False), 5: ("2025-03-01", "None", True), 6: ("None", "None", False),
    }
