from pyspark.sql import functions as F

from tallyspark.operators.reconcile import audit_categories, reconcile

DAY = "2025-03-15"


def internal(spark, *rows):
    return spark.createDataFrame(rows, "transaction_id string, merchant_id string, amount string, created_at string").withColumns(
        {"amount": F.col("amount").cast("decimal(18,2)"), "created_at": F.col("created_at").cast("timestamp")}
    )


def processor(spark, *rows):
    return spark.createDataFrame(rows, "transaction_id string, merchant_id string, amount string, reference_date string").withColumns(
        {"amount": F.col("amount").cast("decimal(18,2)"), "reference_date": F.col("reference_date").cast("date")}
    )


def classify(ours, theirs, **kwargs):
    rows = reconcile(ours, theirs, **kwargs).collect()
    return sorted((r.transaction_id or "-", str(r.reference_date), r.category) for r in rows)


def test_tolerance_and_window_bounds(spark):
    ours = internal(
        spark, ("cent", "M", "10.00", DAY), ("two", "M", "10.00", DAY), ("day7", "M", "1.00", "2025-03-08 23:59:59"),
        ("day8", "M", "1.00", "2025-03-07 23:59:59"), ("future", "M", "1.00", "2025-03-16"), ("ours", "M", "1.00", DAY),
    )
    theirs = processor(
        spark, ("cent", "M", "10.01", DAY), ("two", "M", "9.98", DAY), ("day7", "M", "1.00", DAY), ("day8", "M", "1.00", DAY),
        ("future", "M", "1.00", DAY), ("theirs", "M", "1.00", DAY),
    )
    assert classify(ours, theirs) == [
        ("cent", DAY, "MATCHED"),
        ("day7", DAY, "MATCHED"),
        ("day8", "2025-03-07", "UNRECONCILED_INTERNAL"),
        ("day8", DAY, "UNRECONCILED_PROCESSOR"),
        ("future", DAY, "UNRECONCILED_PROCESSOR"),
        ("future", "2025-03-16", "UNRECONCILED_INTERNAL"),
        ("ours", DAY, "UNRECONCILED_INTERNAL"),
        ("theirs", DAY, "UNRECONCILED_PROCESSOR"),
        ("two", DAY, "MISMATCHED"),
    ]


def test_difference_is_null_on_one_side(spark):
    rows = reconcile(internal(spark, ("a", "M", "5", DAY), ("b", "M", "5", DAY)), processor(spark, ("a", "M", "7.5", DAY))).collect()
    assert {r.transaction_id: r.difference and str(r.difference) for r in rows} == {"a": "2.50", "b": None}


def test_rows_without_id_stay_apart(spark):
    ours = internal(spark, *[(None, "M", "1.00", DAY)] * 50)
    theirs = processor(spark, *[(None, "M", "1.00", DAY)] * 30)
    rows = classify(ours, theirs)
    assert rows.count(("-", DAY, "UNRECONCILED_INTERNAL")) == 50
    assert rows.count(("-", DAY, "UNRECONCILED_PROCESSOR")) == 30


def test_run_scope_repeats_open_rows(spark):
    ours = internal(spark, ("a", "M", "1", "2025-03-14"), ("late", "M", "1", "2025-03-01"))
    theirs = processor(spark, ("a", "M", "1", "2025-03-15"), ("x", "M", "1", "2025-03-14"), ("y", "M", "1", "2025-03-30"))
    assert classify(ours, theirs, scope="run") == [
        ("a", "2025-03-14", "UNRECONCILED_INTERNAL"),
        ("a", "2025-03-15", "MATCHED"),
        ("x", "2025-03-14", "UNRECONCILED_PROCESSOR"),
        ("y", "2025-03-30", "UNRECONCILED_PROCESSOR"),
    ]


def test_plan_is_one_equi_join(spark):
    ours = internal(spark, ("a", "M", "1", DAY))
    plan = reconcile(ours, processor(spark, ("a", "M", "1", DAY)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_audit_counts_like_a_row_level_join(spark):
    stored = spark.createDataFrame([("a", "MATCHED"), ("b", "MISMATCHED"), ("c", "MATCHED"), ("c", "MATCHED")], "transaction_id string, category string")
    again = spark.createDataFrame([("a", "MATCHED"), ("c", "X"), ("c", "Y"), ("d", "X")], "transaction_id string, category string")
    rows = {(r.stored, r.recomputed): r.transactions for r in audit_categories(stored, again).collect()}
    assert rows == {("MATCHED", "MATCHED"): 1, ("MISMATCHED", None): 1, ("MATCHED", "X"): 2, ("MATCHED", "Y"): 2, (None, "X"): 1}


def test_scope_run_moves_each_side_once(spark):
    internal = spark.createDataFrame([("a", "M", 1.0, "2025-01-01")], "transaction_id string, merchant_id string, amount double, created_at string")
    processor = spark.createDataFrame([("a", "M", 1.0, "2025-01-02")], "transaction_id string, merchant_id string, amount double, reference_date string")
    frames = internal.selectExpr("*"), processor.withColumn("reference_date", F.col("reference_date").cast("date"))
    plan = reconcile(*frames, scope="run")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_key") == 1 and "SortMergeJoin" not in plan
