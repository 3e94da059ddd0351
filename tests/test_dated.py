import datetime

import pytest
from pyspark.sql import functions as F

from golden import company, results, runs
from tallyspark.functions.dates import in_dates, next_period, period_of
from tallyspark.plans import curated, dated, marts
from tallyspark.schemas import RESULTS
from tallyspark.sources.published import Published

DAYS = [f"2024-02-{d:02d}" for d in range(1, 21)]
OLD_RUNS = [(100 + i, d, "f", "COMPLETED", 1, f"{d} 08:00:00") for i, d in enumerate(DAYS)]
OLD_RESULTS = [(1000 + i, 100 + i, f"t{i}", "M001", "MATCHED" if i % 2 else "MISMATCHED", "1", "3") for i in range(20)]
OLD_RESULTS += [(2000 + i, 100 + i, f"u{i}", "M002", "MATCHED", "1", "1") for i in range(20)]
# A rerun of two dates: one loses a category, one fails after having completed; and a date that has no results.
RERUNS = [
    (300, DAYS[3], "f", "COMPLETED", 1, f"{DAYS[3]} 09:00:00"), (301, DAYS[9], "f", "FAILED", 1, f"{DAYS[9]} 09:00:00"),
    (302, "2024-03-05", "f", "FAILED", 1, "2024-03-05 09:00:00"),
]
NEW = (5000, 300, "t", "M001", "UNRECONCILED_INTERNAL", "1", None)
CHANGED = [datetime.date.fromisoformat(d) for d in (DAYS[3], DAYS[9], "2024-03-05")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(got, expected):
    return sorted(map(repr, got.select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))


def files(store, name, period):
    return {f for f in store.published(name).read().inputFiles() if f"period={period}" in f}


@pytest.fixture()
def kept_up(spark, store):
    """All artifacts from the old runs."""
    days = dated.add_results(store, runs(spark, *OLD_RUNS), results(spark, *OLD_RESULTS))
    dated.refresh(store, runs(spark, *OLD_RUNS), company(spark), days)
    return store


def test_refresh_equals_rebuild(spark, kept_up):
    r1, s1, c = runs(spark, *OLD_RUNS, *RERUNS), results(spark, *OLD_RESULTS, NEW), company(spark)
    for _ in range(2):  # a refresh that is run again changes nothing
        assert dated.add_results(kept_up, r1.filter("id >= 300"), s1) == CHANGED[:1]
        dated.refresh(kept_up, r1, c, CHANGED)
    current = curated.results_current(r1, s1, c)
    daily = marts.ops_daily(r1, current)
    want = {
        dated.CURRENT: current, dated.DAILY: daily, dated.TREND: marts.ops_trend(daily), dated.HISTORY: marts.run_history(r1, s1),
        dated.SUMMARY: marts.cfo_weekly_summary(current), dated.LEDGER: marts.compliance_ledger(r1, s1, c),
        dated.RANKING: marts.cfo_weekly_merchant_ranking(curated.results_current(r1, s1), c),
    }
    for name, expected in want.items():
        assert same(kept_up.read(name), expected), name


def test_a_date_reads_its_partition_only(spark, kept_up):
    day = [datetime.date(2024, 2, 4)]
    for stored in (dated.results_of(kept_up, day), dated.current_of(kept_up, day)):
        text = plan(stored)
        assert "PartitionFilters: [isnotnull(period" in text and "2024-02-04" in text
        assert stored.count() == 2
    assert {f.split("period=")[1][:10] for f in dated.results_of(kept_up, day).inputFiles()} >= {"2024-02-04"}


def test_other_partitions_keep_their_files(spark, kept_up):
    before = {p: files(kept_up, dated.RESULTS, p) for p in ("2024-01-08", "2024-02-04", "2024-02-05")}
    dated.add_results(kept_up, runs(spark, *OLD_RUNS, *RERUNS).filter("id >= 300"), results(spark, NEW))
    after = {p: files(kept_up, dated.RESULTS, p) for p in before}
    assert before["2024-01-08"] == after["2024-01-08"] and before["2024-02-05"] == after["2024-02-05"]
    assert before["2024-02-04"] != after["2024-02-04"]


def weeks(spark, *rows):
    schema = "week_start string, category string, txn_count int"
    return spark.createDataFrame(rows, schema).withColumn("week_start", F.col("week_start").cast("date"))


@pytest.mark.parametrize("plain", [False, True])
def test_closed_weeks(spark, store, plain):
    frozen = weeks(spark, ("2023-12-18", "A", 1), ("2024-01-01", "A", 1), ("2024-01-08", "A", 1))
    if plain:
        store.replace(dated.SUMMARY, frozen)
    else:
        dated.publish_weeks(store, dated.SUMMARY, frozen)
    old = None if plain else files(store, dated.SUMMARY, "2023-01-01")
    fresh = weeks(spark, ("2023-12-18", "A", 9), ("2024-01-01", "A", 9), ("2024-01-01", "B", 9), ("2024-01-08", "A", 2), ("2024-01-15", "A", 3))
    got = dated.publish_weeks(store, dated.SUMMARY, fresh, "2024-01-14")
    kept = {(str(r.week_start), r.category): r.txn_count for r in got.collect()}
    assert kept == {("2023-12-18", "A"): 1, ("2024-01-01", "A"): 1, ("2024-01-08", "A"): 2, ("2024-01-15", "A"): 3}
    assert plain or files(store, dated.SUMMARY, "2023-01-01") == old


def test_a_build_that_dies_leaves_the_last_version(spark, store, monkeypatch):
    first = weeks(spark, ("2024-01-01", "A", 1), ("2024-01-08", "A", 1))
    dated.publish_weeks(store, dated.SUMMARY, first)
    broken = first.withColumn("txn_count", F.when(F.col("week_start") > "2024-01-05", F.raise_error(F.lit("executor lost")).cast("int")).otherwise(7))
    with pytest.raises(Exception, match="executor lost"):  # while the files are written
        dated.publish_weeks(store, dated.SUMMARY, broken)
    assert same(store.read(dated.SUMMARY), first)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # after the files, before the rename
        patch.setattr(Published, "_commit", killed)
        with pytest.raises(KeyboardInterrupt):
            dated.publish_weeks(store, dated.SUMMARY, first.withColumn("txn_count", F.lit(9)))
    assert same(store.read(dated.SUMMARY), first)
    dated.publish_weeks(store, dated.SUMMARY, first.withColumn("txn_count", F.lit(8)))
    assert {r.txn_count for r in store.read(dated.SUMMARY).collect()} == {8}


def test_versions_vacuum_and_emptied_partitions(spark, store):
    table, rows = store.published("t"), spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, p string")
    assert not table.exists()
    assert table.publish(rows, "p") == 1 and table.publish(rows.filter("v = 1"), "p", append=True) == 2
    assert table.publish(rows.filter("v = 9"), "p", replaced=["b", None]) == 3
    assert sorted(r.v for r in table.read().collect()) == [1, 1]
    assert sorted(r.v for r in table.read(1).collect()) == [1, 2, 3] and table.partitions() == ["a"]
    assert table.vacuum(keep=1) == 3 and table.versions() == [3] and table.vacuum(keep=1) == 0
    assert sorted(r.v for r in table.read().collect()) == [1, 1]
    table.publish(rows.filter("v = 9"), "p", replaced=["a"])
    assert table.read().collect() == [] and table.read().columns == ["v", "p"]
    table.publish(rows)
    assert table.read().count() == 3
    with pytest.raises(RuntimeError, match="another writer"):
        table._commit(5, {})


def test_ledger_reads_new_runs_only(spark, kept_up):
    r1, c = runs(spark, *OLD_RUNS, *RERUNS), company(spark)
    before = set(kept_up.published(dated.LEDGER).read().inputFiles())
    assert dated.append_ledger_by_run(kept_up, r1, c) == 0
    grown = (5001, 105, "late", "M001", "MATCHED", "1", "1")
    dated.add_results(kept_up, r1, results(spark, NEW, grown))
    new = dated.runs_not_in_ledger(kept_up, kept_up.published(dated.RESULTS).read())
    assert sorted(r.run_id for r in new.collect()) == [105, 300]
    assert dated.append_ledger_by_run(kept_up, r1, c) == 2
    after = kept_up.published(dated.LEDGER).read()
    added = set(after.inputFiles()) - before
    assert before <= set(after.inputFiles()) and {f.split("period=")[1][:10] for f in added} == {"2024-02-04", "2024-02-06"}
    assert sorted(r.result_id for r in spark.read.parquet(*added).collect()) == [5000, 5001]


def test_a_ledger_that_died_before_its_manifest_adds_nothing_twice(spark, kept_up, monkeypatch):
    r1, c = runs(spark, *OLD_RUNS, *RERUNS), company(spark)
    dated.add_results(kept_up, r1, results(spark, NEW))
    publish = type(kept_up).publish

    def dies(self, name, *args, **kwargs):
        if name == dated.LEDGER_RUNS:
            raise KeyboardInterrupt
        return publish(self, name, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(kept_up), "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            dated.append_ledger_by_run(kept_up, r1, c)
    assert dated.append_ledger_by_run(kept_up, r1, c) == 1
    assert kept_up.read(dated.LEDGER).filter("result_id = 5000").count() == 1


def test_dates_become_ranges(spark):
    day = datetime.date
    days = [day(2024, 1, 1), day(2024, 1, 2), day(2024, 1, 3), day(2024, 2, 1)]
    frame = spark.range(60).select(F.date_add(F.lit("2023-12-20").cast("date"), F.col("id").cast("int")).alias("d"))
    assert sorted(r.d for r in frame.filter(in_dates("d", days)).collect()) == days
    assert frame.filter(in_dates("d", [])).count() == 0
    assert "BETWEEN" not in str(in_dates("d", days[2:])) and next_period(day(2024, 12, 1), "month") == day(2025, 1, 1)
    assert next_period(day(2023, 1, 1), "year") == day(2024, 1, 1) and next_period(day(2024, 1, 1), "week") == day(2024, 1, 8)
    assert period_of(day(2024, 3, 3), "week") == day(2024, 2, 26)


def test_ledger_append_moves_whole_rows_by_run_only(spark):
    """Which results the ledger has already is told by ids; NULL is an id, and an id counts under any run."""
    at = datetime.datetime(2024, 1, 1)
    rows = [(i, i % 3, f"t{i}", "m", "MATCHED", None, None, None, at, "s") for i in range(6)]
    rows += [(None, 0, "none", "m", "MATCHED", None, None, None, at, "s"), (2, 1, "other run", "m", "MATCHED", None, None, None, at, "s")]
    known = spark.createDataFrame([(k, at.date()) for k in range(3)], "run_id long, day date")
    of_runs = spark.createDataFrame(rows, RESULTS).join(known.select("run_id"), "run_id", "left_semi")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        with dated._dealt_by_run(spark):
            left = dated._without(of_runs, spark.createDataFrame([(2,), (2,), (4,), (None,)], "result_id long")).join(known, "run_id")
            said = plan(left)
            assert sorted((r.id, r.run_id) for r in left.collect()) == [(0, 0), (1, 1), (3, 0), (5, 2)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    whole = [line for line in said.splitlines() if "Exchange hashpartitioning(run_id" in line]
    assert whole and not [line for line in whole if "coalesce" in line]
