"""How the queries write and cut their drops."""

from pyspark.sql import functions as F

from workload import queries


def _drop(spark, folder, rows):
    spark.range(rows).select(F.lpad("id", 99, "0").alias("v")).coalesce(1).write.text(folder)
    return folder


def test_splits_of_a_drop_do_not_follow_its_size(spark, tmp_path):
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    counts = {}
    try:
        for rows in (100, 1_000, 10_000):
            folder = _drop(spark, str(tmp_path / f"{rows}"), rows)
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(queries._split_bytes(spark, folder, 1000, 50)))
            counts[rows] = spark.read.text(folder).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)
    assert counts == {100: 10, 1_000: 50, 10_000: 50}


def test_splits_are_not_smaller_than_the_least(spark, tmp_path):
    assert queries._split_bytes(spark, _drop(spark, str(tmp_path / "few"), 10)) == 16 << 10


def test_single_file_is_whole_and_in_order_however_many_tasks_sort_it(spark, tmp_path):
    folder = str(tmp_path / "single")
    texts = {0: "a,b", 1: 'say "x"', 2: "", 3: None}
    text = F.coalesce(*[F.when(F.col("id") % 5 == k, F.lit(v).cast("string")) for k, v in texts.items()])
    rows = spark.range(5000, numPartitions=7).select(((F.col("id") * 7919) % 5000).alias("k"), text.alias("t"))
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = rows.orderBy("k")
        assert ordered.rdd.getNumPartitions() > 1
        queries._write_single(ordered, folder, "all[1].csv")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    rows.repartition(1).sortWithinPartitions("k").write.option("header", True).csv(str(tmp_path / "one"))
    (one,) = (tmp_path / "one").glob("part-*.csv")
    (single,) = (tmp_path / "single").glob("[!.]*")
    assert single.name == "all[1].csv" and single.read_bytes() == one.read_bytes()
