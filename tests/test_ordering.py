from pyspark.sql import functions as F

from tallyspark.functions.text import joined
from tallyspark.operators.ordering import numbered
from tallyspark.operators.profile import ordered_fingerprint


def test_positions_over_several_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("w")).repartition(7)
    with_null = [F.col("w").desc_nulls_last(), F.col("v").asc()]
    got = [(r.w, r.v) for r in numbered(rows, with_null).orderBy("position").collect()]
    assert got == sorted(((r.w, r.v) for r in rows.collect()), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert [r.position for r in numbered(rows, with_null).orderBy("position").collect()] == list(range(1, 5001))


def test_ties_and_nothing(spark):
    assert sorted(r.position for r in numbered(spark.range(10).select(F.lit(1).alias("v")), [F.col("v")]).collect()) == list(range(1, 11))
    assert numbered(spark.range(0), [F.col("id")]).collect() == []


def test_fingerprint_tells_the_order(spark):
    def print_of(values, parts=3):
        rows = spark.createDataFrame(list(enumerate(values)), "at long, v string").repartition(parts)
        return ordered_fingerprint(rows, "v", ["at"]).first()

    values = ["a", "b", None, "", "a"] * 50
    assert print_of(values) == print_of(values, 7)
    for changed in (values[::-1], ["b", "a", *values[2:]], ["a", "b", "", None, *values[4:]], values[:-1], [*values, "a"]):
        assert print_of(changed) != print_of(values)
    assert print_of([]).rows == 0


def test_texts_joined_in_order(spark):
    rows = spark.createDataFrame(
        [("x", 2, "two"), ("x", 10, "ten"), ("x", 1, "it's"), ("x", 3, None), ("y", 1, None), ("z", None, "first"), ("z", 1, "b")],
        "g string, k int, v string",
    )
    for separator in (", ", "'", "\\"):
        got = {r["g"]: r["t"] for r in rows.repartition(3).groupBy("g").agg(joined("v", ["k"], separator).alias("t")).collect()}
        assert got == {"x": separator.join(["it's", "two", "ten"]), "y": None, "z": separator.join(["first", "b"])}
