import datetime

from pyspark.sql import functions as F

from tallyspark.session import fresh_dir
from tallyspark.streaming import changes, matching

CHANGES = "k string, v int, Op string, ts timestamp"


def write(spark, folder, schema, *rows):
    types = [part.split()[1] for part in schema.split(", ")]
    names = [part.split()[0] for part in schema.split(", ")]
    text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"{n} string" for n in names))
    text.select(*[F.col(n).cast(t) for n, t in zip(names, types)]).coalesce(1).write.mode("append").parquet(folder)


def test_state_survives_late_changes_deletes_and_restarts(spark, store):
    folder, checkpoint = fresh_dir(spark, "in"), fresh_dir(spark, "checkpoint")
    handle = changes.merge_changes_handler(store, "state", "k", ["ts", "v"], buckets=4)

    def run():
        stream = changes.file_stream(spark, folder, CHANGES, files_per_batch=1)
        changes.batch_stream(stream, handle, checkpoint).awaitTermination()
        return {r.k: (r.v, r.Op) for r in store.read("state").collect()}

    write(spark, folder, CHANGES, ("a", 2, "U", "2025-01-02"), ("b", 1, "I", "2025-01-01"))
    assert run() == {"a": (2, "U"), "b": (1, "I")}
    write(spark, folder, CHANGES, ("a", 1, "I", "2025-01-01"), ("b", 2, "D", "2025-01-03"), ("c", 1, "I", "2025-01-01"))
    assert run() == {"a": (2, "U"), "b": (2, "D"), "c": (1, "I")}
    assert run() == {"a": (2, "U"), "b": (2, "D"), "c": (1, "I")}


def test_upsert_of_a_repeated_batch_changes_nothing(spark, store):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int").withColumn(
        "reference_date", F.lit("2025-01-01").cast("date")
    )
    handle = changes.upsert_handler(store, "t", ["k", "reference_date"], ["v"])
    for batch in (0, 0):
        handle(rows, batch)
    assert sorted((r.k, r.v) for r in store.read("t").collect()) == [("a", 2), ("b", 1)]


def test_append_stream_reads_each_file_once(spark):
    folder, table, checkpoint = (fresh_dir(spark, x) for x in ("in", "table", "checkpoint"))
    for i in range(2):
        write(spark, folder, CHANGES, (f"k{i}", i, "I", "2025-01-01"))
        changes.append_stream(changes.file_stream(spark, folder, CHANGES), table, checkpoint).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(table).collect()) == ["k0", "k1"]


def test_replays_are_dropped_inside_the_watermark(spark):
    folder, table, checkpoint = (fresh_dir(spark, x) for x in ("in", "table", "checkpoint"))
    for day in ("2025-01-01", "2025-01-03"):
        write(spark, folder, CHANGES, ("a", 1, "I", day))
        stream = matching.deduplicated(changes.file_stream(spark, folder, CHANGES), "k", "ts")
        changes.append_stream(stream, table, checkpoint).awaitTermination()
    assert spark.read.parquet(table).count() == 1


def test_streams_match_and_release_open_rows(spark):
    ours, theirs, table, checkpoint = (fresh_dir(spark, x) for x in ("ours", "theirs", "table", "checkpoint"))
    internal = "transaction_id string, amount double, created_at timestamp"
    processor = "transaction_id string, amount double, settled_at timestamp"

    def run():
        pairs = matching.match_streams(
            changes.file_stream(spark, ours, internal), changes.file_stream(spark, theirs, processor), lateness="1 day"
        )
        changes.append_stream(pairs, table, checkpoint).awaitTermination()
        rows = spark.read.parquet(table).collect()
        return sorted((r.transaction_id, r.category, r.reference_date) for r in rows)

    write(
        spark, ours, internal, ("ok", 10.0, "2025-03-10 10:00:00"), ("off", 10.0, "2025-03-10 10:00:00"),
        ("edge", 1.0, "2025-03-08 23:00:00"), ("late", 1.0, "2025-03-07 23:00:00"), ("ours", 1.0, "2025-03-10 10:00:00"),
    )
    write(
        spark, theirs, processor, ("ok", 10.01, "2025-03-12 01:00:00"), ("off", 12.0, "2025-03-12 01:00:00"),
        ("edge", 1.0, "2025-03-15 01:00:00"), ("late", 1.0, "2025-03-15 01:00:00"), ("theirs", 1.0, "2025-03-12 01:00:00"),
    )
    assert {(t, c) for t, c, _ in run() if c in ("MATCHED", "MISMATCHED")} == {("ok", "MATCHED"), ("off", "MISMATCHED"), ("edge", "MATCHED")}
    # Much later rows on both sides move the watermark and release what stayed open.
    write(spark, ours, internal, ("zz", 1.0, "2025-05-01"))
    write(spark, theirs, processor, ("zz", 1.0, "2025-05-01"))
    day = datetime.date
    assert run() == [
        ("edge", "MATCHED", day(2025, 3, 15)),
        ("late", "UNRECONCILED_INTERNAL", day(2025, 3, 7)),
        ("late", "UNRECONCILED_PROCESSOR", day(2025, 3, 15)),
        ("off", "MISMATCHED", day(2025, 3, 12)),
        ("ok", "MATCHED", day(2025, 3, 12)),
        ("ours", "UNRECONCILED_INTERNAL", day(2025, 3, 10)),
        ("theirs", "UNRECONCILED_PROCESSOR", day(2025, 3, 12)),
        ("zz", "MATCHED", day(2025, 5, 1)),
    ]


def test_micro_batches_at_an_interval(spark):
    folder, table, checkpoint = (fresh_dir(spark, x) for x in ("in", "table", "checkpoint"))
    write(spark, folder, CHANGES, ("a", 1, "I", "2025-01-01"))
    query = changes.append_stream(changes.file_stream(spark, folder, CHANGES), table, checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        write(spark, folder, CHANGES, ("b", 1, "I", "2025-01-01"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.k for r in spark.read.parquet(table).collect()) == ["a", "b"]


def test_stable_partitions_limit_what_a_batch_rewrites(spark, store, tmp_path):
    def batch(*rows):
        text = spark.createDataFrame(rows, "k string, v int, created string, ts string")
        return text.select("k", "v", F.col("created").cast("date").alias("created"), "ts")

    handle = changes.merge_changes_handler(store, "state", "k", ["ts", "v"], partition=F.col("created"))
    handle(batch(("a", 1, "2025-01-01", "1"), ("b", 1, "2025-01-02", "1")), 0)
    folder = tmp_path / "lake" / "state" / "bucket=2025-01-01"
    before = sorted(p.name for p in folder.glob("*.parquet"))
    handle(batch(("b", 2, "2025-01-02", "2"), ("b", 0, "2025-01-02", "0")), 1)
    assert {r.k: r.v for r in store.read("state").collect()} == {"a": 1, "b": 2}
    assert sorted(p.name for p in folder.glob("*.parquet")) == before


def test_rows_without_an_id_come_out_at_once(spark):
    ours, theirs, table, checkpoint = (fresh_dir(spark, x) for x in ("ours", "theirs", "table", "checkpoint"))
    internal, processor = ("transaction_id string, amount double, " + c for c in ("created_at timestamp", "settled_at timestamp"))
    write(spark, ours, internal, (None, 1.0, "2025-03-10 10:00:00"), (None, 2.0, "2025-03-10 10:00:00"), ("a", 3.0, "2025-03-10"))
    write(spark, theirs, processor, (None, 1.0, "2025-03-12 10:00:00"), ("a", 3.0, "2025-03-12"))
    pairs = matching.match_streams(changes.file_stream(spark, ours, internal), changes.file_stream(spark, theirs, processor))
    changes.append_stream(pairs, table, checkpoint).awaitTermination()
    got = sorted((r.transaction_id or "", r.category, str(r.reference_date)) for r in spark.read.parquet(table).collect())
    assert got == [
        ("", "UNRECONCILED_INTERNAL", "2025-03-10"), ("", "UNRECONCILED_INTERNAL", "2025-03-10"),
        ("", "UNRECONCILED_PROCESSOR", "2025-03-12"), ("a", "MATCHED", "2025-03-12"),
    ]
