import pytest
from pyspark.sql import Observation, functions as F

from tallyspark.operators import profile, quality
from tallyspark.plans import checks


def rows(spark):
    return spark.createDataFrame([("a", 1), ("b", -1), ("c", None), (None, 5)], "k string, v int")


def test_null_does_not_violate(spark):
    rules = [quality.Rule("positive", F.col("v") > 0, "low"), quality.Rule("key", F.col("k").isNotNull(), "no key", quality.WARN)]
    found = {r.rule: (r.violations, r.rows) for r in quality.violations(rows(spark), rules).collect()}
    assert found == {"positive": (1, 4), "key": (1, 4)}


def test_drop_warn_and_fail(spark):
    drop = quality.Rule("positive", F.col("v") > 0, "low", quality.DROP)
    warn = quality.Rule("key", F.col("k").isNotNull(), "no key", quality.WARN)
    seen = Observation("seen")
    kept = quality.enforce(rows(spark), [drop, warn], seen)
    assert kept.count() == 3
    assert seen.get == {"rows": 4, "positive": 1, "key": 1}
    fail = quality.Rule("key", F.col("k").isNotNull(), "key is missing")
    with pytest.raises(Exception, match="key is missing"):
        quality.enforce(rows(spark), [fail]).count()
    assert quality.enforce(rows(spark).filter("k is not null"), [fail]).count() == 3


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["a", "b"]).collect()] == [(1, None, 2)]
    with pytest.raises(ValueError, match="1 duplicate"):
        quality.require_unique(df, ["a"], "table")
    quality.require_unique(df.filter("a = 2"), ["a"], "table")


def test_daily_checks(spark):
    volumes = [100, 102, 98, 101, 99, 300]
    daily = spark.createDataFrame(
        [(f"2025-01-{d:02d}", "MATCHED", v, 0.9 if d < 6 else 0.8) for d, v in enumerate(volumes, 1)],
        "reference_date string, category string, txn_count long, pct_of_total double",
    )
    flags = {r.reference_date: (r.low_match_rate, r.unusual_volume) for r in quality.daily_checks(daily).collect()}
    assert flags["2025-01-06"] == (True, True)
    assert flags["2025-01-01"] == flags["2025-01-05"] == (False, False)


def test_audit_appends(spark, tmp_path):
    path = str(tmp_path / "audit")
    found = quality.violations(rows(spark), [quality.Rule("positive", F.col("v") > 0, "low")])
    quality.append_audit(found, path, "r1", "t")
    quality.append_audit(found, path, "r2", "t")
    assert {(r.run_label, r.rule, r.violations) for r in spark.read.parquet(path).collect()} == {("r1", "positive", 1), ("r2", "positive", 1)}


def as_dict(report):
    return {(r.metric, r.column): r.value for r in report.collect()}


def test_profile(spark):
    df = rows(spark).withColumn("created_at", F.lit("2025-01-02T00:00:00+00:00"))
    report = as_dict(profile.profile(df, "t", ["created_at"]))
    assert report == {
        ("row_count", None): "4", ("column_count", None): "3", ("null_count", "k"): "1", ("null_count", "v"): "1",
        ("date_min", "created_at"): "2025-01-02 00:00:00", ("date_max", "created_at"): "2025-01-02 00:00:00",
        ("duplicate_pk_count", "created_at"): "1",
    }
    empty = as_dict(profile.profile(df.filter("false"), "t"))
    assert empty[("row_count", None)] == "0" and empty[("date_min", "created_at")] is None


def test_typed_date_column_comes_first(spark):
    df = spark.range(1).select(F.lit("x").alias("created_at"), F.current_date().alias("d"), F.lit("y").alias("z"))
    assert profile.date_column(df) == "d"
    assert profile.date_column(df.drop("d")) == "created_at"
    assert profile.date_column(df.select("z")) is None


def test_report_order(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 1, 1)], "a int, b int, c int")
    lines = [(r.metric, r.column, r.pct) for r in profile.ordered(profile.profile(df, "t")).collect()]
    assert lines[-2:] == [("null_count", "a", 100.0), ("null_count", "b", 50.0)]


def test_fingerprint_ignores_order_and_partitions(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("x"))
    same = profile.fingerprint(df.repartition(7).orderBy(F.desc("x")), "x").first()
    assert profile.fingerprint(df, "x").first() == same
    assert profile.fingerprint(df.filter("x <> '5'"), "x").first() != same


def test_small_reports(spark):
    settlements = spark.createDataFrame(
        [("SETTLED", "10.00", "2025-01-01")] * 98 + [("REVERSED", "5.00", "2025-01-02")] * 2, "status string, amount string, settled_at string"
    ).withColumns({"amount": F.col("amount").cast("decimal(18,2)"), "settled_at": F.col("settled_at").cast("timestamp")})
    check = checks.reversed_check(checks.status_mix(settlements)).first()
    assert (check.reversed_pct, check.as_expected) == (2.0, True)
    assert {str(r.date): r.transactions for r in checks.settled_per_day(settlements).collect()} == {"2025-01-01": 98, "2025-01-02": 2}
    assert checks.amount_stats(settlements).first().not_positive == 0
    ids = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    known = spark.createDataFrame([("a",), (None,)], "id string")
    assert {r.id for r in checks.absent_from(ids, known, "id").collect()} == {"b", None}
    assert {r.id for r in checks.present_in(ids, known, "id").collect()} == {"a"}


def test_moments_merge(spark):
    """Checks from the moments of a last date equal those over the whole history, wherever it is cut."""
    days = [(f"2024-01-{d:02d}", "MATCHED", v, 0.9) for d, v in zip(range(1, 29), [100, 120, 90, 1000, 110, 95, 105] * 4)]
    daily = spark.createDataFrame(days, "reference_date string, category string, txn_count long, pct_of_total double")
    whole = {r.reference_date: r for r in quality.daily_checks(daily).collect()}
    for cut in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-15"):
        early = quality.daily_checks_after(daily.filter(f"reference_date < '{cut}'"), quality.NO_MOMENTS).orderBy("reference_date").collect()
        moments = {k: early[-1][k] for k in quality.NO_MOMENTS} if early else quality.NO_MOMENTS
        rows = [*early, *quality.daily_checks_after(daily.filter(f"reference_date >= '{cut}'"), moments).collect()]
        assert len(rows) == len(whole)
        for r in rows:
            w = whole[r.reference_date]
            assert (r.volume, r.low_match_rate, r.unusual_volume) == (w.volume, w.low_match_rate, w.unusual_volume)
            for a, b in ((r.volume_mean, w.volume_mean), (r.volume_stddev, w.volume_stddev)):
                assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
