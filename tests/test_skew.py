"""One key holds a third of all rows: the joins must split it, the rest must not see it."""

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import cdc
from tallyspark.plans import curated, marts

ROWS = 200_000
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tables(spark):
    hot = F.col("id") % 3 == 0
    results = spark.range(ROWS).select(
        "id",
        F.when(hot, 1).otherwise(F.col("id") % 997).cast("long").alias("run_id"),
        F.concat(F.lit("t"), "id").alias("transaction_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 5000)).alias("merchant_id"),
        F.when(F.col("id") % 2 == 0, "MATCHED").otherwise("MISMATCHED").alias("category"),
        *[F.lit(1).cast("decimal(18,2)").alias(c) for c in ("internal_amount", "processor_amount", "difference")],
        F.lit("2025-01-01").cast("timestamp").alias("created_at"),
        F.lit("x").alias("source"),
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    runs = spark.range(997).select(
        "id", day.alias("reference_date"), F.lit("f").alias("file_name"), F.lit("COMPLETED").alias("status"),
        F.lit(1).alias("total_transactions"), *[F.lit("2025-01-01").cast("timestamp").alias(c) for c in ("started_at", "completed_at", "created_at")],
    )
    names = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("merchant_id")).union(
        spark.range(1).select(F.lit("hot"))
    )
    company = names.withColumns({c: F.lit("n") for c in ("legal_name", "trade_name", "document", "primary_cnae")})
    return runs, results, company


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0], rows


def test_row_level_joins_split_the_hot_keys(spark, no_broadcast):
    runs, results, company = tables(spark)
    plan, rows = final_plan(marts.compliance_ledger(runs, results, company))
    assert plan.count("SortMergeJoin(skew=true)") == 2
    assert len(rows) == ROWS and all(r.legal_name == "n" for r in rows)


def test_aggregates_meet_the_names_after_summing(spark, no_broadcast):
    runs, results, company = tables(spark)
    ranking = marts.cfo_weekly_merchant_ranking(curated.results_current(runs, results), company)
    plan, rows = final_plan(ranking)
    join = plan.index("SortMergeJoin")
    assert "HashAggregate" in plan[:join] and "partial_sum" in plan[join:]
    assert sum(r.txn_count for r in rows) == ROWS // 2


def test_latest_state_of_a_hot_key(spark):
    log = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("_timestamp"), F.lit("U").alias("Op")
    )
    state = cdc.latest_state(log, "k")
    assert {r.k: r._timestamp for r in state.collect()}[-1] == (ROWS - 1) // 3 * 3
