import pytest
from pyspark.sql import functions as F

from tallyspark.llm.common import written
from tallyspark.llm.histogram import range_of, split_points
from tallyspark.llm.sharding import histogram_shards


def check(rows, source, n):
    sizes = [len((r["text"] or "").encode()) + 1 for r in source]
    assert sorted(r["size"] for r in rows) == sorted(sizes)
    for s in range(n):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r["shard"] < n for r in rows)
    return [sum(r["size"] for r in rows if r["shard"] == s) for s in range(n)]


def test_awkward_rows_are_kept_whole(docs):
    source = docs.collect()
    rows = histogram_shards(docs, 4).collect()
    check(rows, source, 4)
    assert sorted(map(repr, [(r["doc_id"], r["text"]) for r in rows])) == sorted(map(repr, [(r["doc_id"], r["text"]) for r in source]))


def test_clashing_columns_and_empty_table(clashing, no_docs):
    assert histogram_shards(clashing, 3, range_bytes=1 << 14).count() == clashing.count()
    assert histogram_shards(no_docs, 3).collect() == []


@pytest.mark.parametrize("finer", [1 << 30, 2000])
def test_hot_groups_are_split_and_shards_are_even(spark, finer):
    # A third of the rows are one text, another third one id with one text: rows that only their place tells apart.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the very same row"))
        .when(F.col("id") % 3 == 1, F.lit("the very same text"))
        .otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
        .alias("text"),
    )
    got = histogram_shards(rows, 8, range_bytes=finer).collect()
    sizes = check(got, rows.collect(), 8)
    assert max(sizes) - min(sizes) <= 40
    # A group that fits into a shard is not torn more often than a boundary demands.
    assert len({r["shard"] for r in got if r["text"] == "the very same text"}) <= 4


def test_one_huge_row(spark):
    rows = spark.createDataFrame([(i, "x" * (100000 if i == 3 else 5)) for i in range(20)], "doc_id long, text string")
    assert sum(check(histogram_shards(rows, 4).collect(), rows.collect(), 4)) == 100000 + 19 * 5 + 20


def test_boundaries_are_exact(spark):
    rows = written(spark.range(5000).select((F.col("id") * 7919 % 100003).alias("k"), (F.col("id") % 13 + 1).alias("w")), "keys")
    splitters, weight, n = split_points(rows, ["k"], "w", 7, tolerance=0.0, probes=16)
    assert len(splitters) == 6 and n == 5000
    for i, s in enumerate(splitters, 1):
        below = rows.where(F.col("k") < s.key[0]).agg(F.sum("w").alias("w"), F.count("*").alias("n")).first()
        assert (below["w"], below["n"]) == (s.weight_below, s.rows_below)
        assert abs(s.weight_below - weight * i / 7) <= 13
    counts = rows.groupBy(range_of(["k"], splitters).alias("r")).agg(F.sum("w").alias("w")).collect()
    assert len(counts) == 7
