"""Every registered query: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.functions.amounts import normalize_amount
from tallyspark.functions.text import joined, money, thousands
from tallyspark.operators import cdc, profile, quality, reconcile as matching
from tallyspark.operators.ordering import numbered
from tallyspark.plans import alerts, build, checks, curated, dated, incremental, marts, reports
from tallyspark.session import configure, fresh_dir
from tallyspark.sources import changelog, settlements as csv
from tallyspark.sources.store import Store, delete_path
from tallyspark.streaming import changes, matching as stream_matching
from workload import star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TEXT = "yyyy-MM-dd HH:mm:ss"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return function(configure(spark), sf.rstrip("/"))

    QUERIES[function.__name__] = run
    return run


def _times_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, TEXT) for c in columns})


def _store(spark: SparkSession, label: str) -> Store:
    return Store(spark, fresh_dir(spark, label))


def _current(spark: SparkSession, sf: str) -> DataFrame:
    return curated.results_current(
        star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    )


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return marts.ops_daily(star.runs(spark, sf), _current(spark, sf))


def _trended(spark: SparkSession, sf: str) -> DataFrame:
    return marts.with_trend(_daily(spark, sf))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return marts.run_history(star.runs(spark, sf), star.results(spark, sf))


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    return marts.cfo_weekly_summary(_current(spark, sf))


def _ranking(spark: SparkSession, sf: str) -> DataFrame:
    bare = curated.results_current(star.runs(spark, sf), star.results(spark, sf))
    return marts.cfo_weekly_merchant_ranking(bare, star.company(spark, sf))


# --- change logs to silver --------------------------------------------------------------


@query
def cdc_transactions(spark, sf):
    log = cdc.union_batches(star.transaction_batches(spark, sf))
    return cdc.latest_state(log, "transaction_id", tie_breakers=("id",))


@query
def transactions_loaded(spark, sf):
    """Two batch files with drifted columns through the loader."""
    folder, store = fresh_dir(spark, "batches"), _store(spark, "transactions-lake")
    paths = []
    for i, batch in enumerate(star.transaction_batches(spark, sf)):
        paths.append(f"{folder}/batch_{i}.parquet")
        batch.write.parquet(paths[-1])
    changelog.load_transactions(store, paths)
    return store.read("raw_transactions")


def _written_batches(spark: SparkSession, sf: str, change=lambda batch: batch) -> list[str]:
    paths = []
    for batch in star.transaction_batches(spark, sf):
        paths.append(fresh_dir(spark, "batch"))
        change(batch).write.parquet(paths[-1])
    return paths


@query
def cdc_load_accounting(spark, sf):
    """Raw, final and removed rows, as the load returns them."""
    counts = changelog.load_transactions(_store(spark, "counted-lake"), _written_batches(spark, sf))
    return spark.sql(f"SELECT {counts['raw']}L AS raw, {counts['final']}L AS final, {counts['removed']}L AS removed")


@query
def cdc_null_timestamps(spark, sf):
    """What the load says to a log in which some changes have no time; nothing is published."""
    store = _store(spark, "rejected-lake")
    holes = F.when(F.col("id") % 9 != 4, F.col("_timestamp"))
    paths = _written_batches(spark, sf, lambda batch: batch.withColumn("_timestamp", holes))
    try:
        changelog.load_transactions(store, paths)
        said = None
    except ValueError as exc:
        said = str(exc)
    return spark.sql("SELECT :said AS said, :published AS published", {"said": said, "published": store.exists("raw_transactions")})


@query
def extracts_landed(spark, sf):
    """Extracts copied as they are, with the row count that the copy returns, and what the table holds."""
    store, counts = _store(spark, "landed-lake"), []
    logs = {"raw_reconciliation_runs": star.runs_log, "raw_reconciliation_results": star.results_log, "raw_enterprise_company": star.supplier_log}
    for name, log in logs.items():
        path = fresh_dir(spark, "extract")
        log(spark, sf).write.parquet(path)
        landed = changelog.land(store, name, path)
        counts.append(store.read(name).agg(F.lit(name).alias("artifact"), F.lit(landed).cast("long").alias("landed"), F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("no_id")))
    return reduce(DataFrame.union, counts)


@query
def silver_runs(spark, sf):
    typed = cdc.typed_runs(star.runs_log(spark, sf), tie_breakers=("Op",))
    return _times_as_text(typed, "started_at", "completed_at", "created_at")


@query
def silver_results(spark, sf):
    typed = cdc.typed_results(star.results_log(spark, sf), tie_breakers=star.RESULT_TIES)
    return _times_as_text(typed, "created_at")


@query
def silver_company(spark, sf):
    return _times_as_text(cdc.typed_company(star.company_log(spark, sf)), "created_at", "updated_at")


@query
def company_history(spark, sf):
    versions = cdc.versioned_history(star.company_log(spark, sf), "id")
    return _times_as_text(
        versions.select("id", "merchant_id", "trade_name", "valid_from", "valid_to", "is_current"),
        "valid_from",
        "valid_to",
    )


# --- curated ----------------------------------------------------------------------------------


@query
def runs_latest(spark, sf):
    latest = curated.runs_latest(star.runs(spark, sf))
    return _times_as_text(latest, "started_at", "completed_at", "created_at")


@query
def winning_runs(spark, sf):
    return curated.winning_runs(star.runs(spark, sf))


@query
def results_current(spark, sf):
    return _times_as_text(_current(spark, sf), "created_at")


@query
def history_hot_key(spark, sf):
    """Versions of users of whom one has a third of all changes, all in one month."""
    log = star.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("k"),
        "event_id",
        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("Op"),
        F.col("ts").cast("timestamp").alias("_timestamp"),
    )
    versions = cdc.versioned_history(log, "k", tie_breakers=("event_id",), hot_changes=1000)
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("valid_from", "valid_to")}
    return versions.withColumns(text).select("k", "event_id", "valid_from", "valid_to", "is_current")


# --- marts ----------------------------------------------------------------------------------------


@query
def ops_daily(spark, sf):
    return _daily(spark, sf)


@query
def ops_trend(spark, sf):
    trend = marts.ops_trend(_daily(spark, sf))
    return trend.withColumn("pct_of_total_7d_avg", F.round("pct_of_total_7d_avg", 9))


@query
def run_history(spark, sf):
    return _times_as_text(_history(spark, sf), "started_at", "completed_at")


@query
def cfo_weekly_summary(spark, sf):
    return _weekly(spark, sf)


@query
def cfo_weekly_merchant_ranking(spark, sf):
    return _ranking(spark, sf)


@query
def compliance_ledger(spark, sf):
    ledger = marts.compliance_ledger(
        star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    )
    return _times_as_text(ledger, "started_at", "completed_at", "created_at")


@query
def ops_daily_from_logs(spark, sf):
    """Change logs to daily mart in one plan."""
    runs = cdc.typed_runs(star.runs_log(spark, sf), tie_breakers=("Op",))
    results = cdc.typed_results(star.results_log(spark, sf), tie_breakers=star.RESULT_TIES)
    return marts.ops_daily(runs, curated.results_current(runs, results))


@query
def gold_build(spark, sf):
    """Raw logs through loaders and ordered build; rows of every artifact, by SQL on its name."""
    store = _store(spark, "gold-lake")
    store.replace("raw_reconciliation_runs", star.runs_log(spark, sf))
    store.replace("raw_reconciliation_results", star.results_log(spark, sf))
    store.replace("raw_enterprise_company", star.supplier_log(spark, sf))
    changelog.seed_reconciliation(store, result_ties=star.RESULT_TIES)
    changelog.seed_company(store)
    built = [*build.build_silver(store), *build.build_gold(store)]
    counts = [f"SELECT '{name}' AS artifact, count(*) AS rows FROM {name}" for name in built]
    return spark.sql(" UNION ALL ".join(counts))


# --- settlement files --------------------------------------------------------------------------


def _loaded_drop(spark: SparkSession, sf: str) -> tuple[Store, DataFrame]:
    folder = fresh_dir(spark, "drop")
    star.write_drop(star.settlement_lines(spark, sf), folder)
    store = _store(spark, "settlement-lake")
    verdicts = csv.judge_and_load(store, folder, r"file_date=(\d{4}-\d{2}-\d{2})", recursive=True)
    return store, verdicts


@query
def settlements_loaded(spark, sf):
    store, _ = _loaded_drop(spark, sf)
    table = store.read(csv.TABLE).drop("_loaded_at", "_source_file")
    return _times_as_text(table, "settled_at")


@query
def settlements_verdicts(spark, sf):
    _, verdicts = _loaded_drop(spark, sf)
    return verdicts.select(
        "reference_date",
        "rows",
        "loaded",
        "duplicates",
        F.array_join("reasons", "; ").alias("reasons"),
        F.array_join("warnings", "; ").alias("warnings"),
    )


def _rename_parts(spark: SparkSession, folder: str, name: Callable[[str, str], str]) -> None:
    """Give the files of a drop other names, by their folder's and their own name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files, listed = fs.listFiles(path(folder), True), []
    while files.hasNext():
        listed.append(files.next().getPath())
    for file in listed:
        if file.getName().endswith(".csv"):
            fs.rename(file, path(file.getParent(), name(file.getParent().getName(), file.getName())))


#: Bytes of a split at least, and splits of a drop at most, where files are to be cut: a file of one of 80 months
#: comes in a dozen splits however large it is.
SPLIT_BYTES, SPLITS = 16 << 10, 1000


def _split_bytes(spark: SparkSession, folder: str, least: int = SPLIT_BYTES, most: int = SPLITS) -> int:
    """Size of the splits that cut a drop small: each task reports to the driver, so their number must not follow its size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return max(least, -(-(files.agg(F.sum("length")).first()[0] or 0) // most))


@query
def settlements_awkward_drop(spark, sf):
    """A wide header, a missing column, hidden names, a file without rows, line breaks between quotes in files that are
    cut into several splits, and good files, side by side."""
    folder, lines = fresh_dir(spark, "awkward"), star.settlement_lines(spark, sf)
    year = F.year("file_date")
    wide = [F.lit(None).cast("string").alias(f"{'filler' * 160}{i}") for i in range(75)]
    star.write_drop(lines.filter(year < 1994).select(*wide, "*"), f"{folder}/wide")
    star.write_drop(lines.filter(year == 1994).drop("status"), f"{folder}/lacking")
    star.write_drop(lines.filter(year == 1995), f"{folder}/hidden")
    _rename_parts(spark, f"{folder}/hidden", lambda _, name: f"_{name}")
    branch = F.concat("merchant_id", F.lit("\nbranch \"x\", floor\n"), F.col("_key") % 9)
    star.write_drop(lines.filter(year == 1996).withColumn("merchant_id", branch), f"{folder}/breaks")
    star.write_drop(lines.filter(year > 1996), f"{folder}/good")
    nothing = lines.filter("1 = 0").drop("file_date", "_key", "_seq").coalesce(1)
    nothing.write.option("header", True).csv(f"{folder}/empty/file_date=2001-01-01")
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(_split_bytes(spark, folder)))
    try:
        verdicts = csv.judge_and_load(_store(spark, "awkward-lake"), folder, r"file_date=(\d{4}-\d{2}-\d{2})", recursive=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", whole)
    return verdicts.select(
        F.substring_index("name", "/", 1).alias("part"),
        "reference_date",
        "rows",
        "loaded",
        F.array_join("reasons", "; ").alias("reasons"),
    )


@query
def settlements_by_callable(spark, sf):
    """Dates from a callable that gets each file's path and fails on the files of one year."""

    def dated(path):
        text = path.parent.name.partition("=")[2]
        if text.startswith("1995"):
            raise ValueError("closed year")
        return text

    folder = fresh_dir(spark, "drop")
    star.write_drop(star.settlement_lines(spark, sf), folder)
    verdicts = csv.judge_and_load(_store(spark, "callable-lake"), folder, dated, recursive=True)
    return verdicts.select("reference_date", "rows", "loaded", F.array_join("reasons", "; ").alias("reasons"))


def _write_single(ordered: DataFrame, folder: str, name: str) -> None:
    """One CSV file of rows in order. They are sorted and formatted by range in many tasks; a last one only strings the
    bytes of the parts together, a few at a time, as a file has one writer."""
    spark, step = ordered.sparkSession, 1 << 22
    parts = fresh_dir(spark, "parts")
    ordered.write.csv(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    listed = sorted(status.getPath().toString() for status in fs.globStatus(path(f"{parts}/part-*")))
    fs.mkdirs(path(folder))
    target, header = fs.makeQualified(path(folder, name)).toUri().toString(), ",".join(ordered.columns)

    # Defined here so that it travels by value and the executors need not have this package.
    def strung(batches):
        from pyarrow import fs as arrow

        def opened(uri):
            # Arrow knows object stores by their plain scheme only.
            return arrow.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))

        for batch in batches:
            system, place = opened(batch["target"][0])
            with system.open_output_stream(place) as out:
                out.write(f"{header}\n".encode())
                for uri in batch["parts"][0]:
                    system, part = opened(uri)
                    with system.open_input_stream(part) as stream:
                        while more := stream.read(step):
                            out.write(more)
            yield batch[["target"]]

    work = spark.createDataFrame([(target, listed)], "target string, parts array<string>")
    work.coalesce(1).mapInPandas(strung, "target string").collect()
    delete_path(spark, parts)


@query
def settlement_file_loaded(spark, sf):
    """All acceptable lines in one file, whose name looks like a pattern."""
    folder, key = fresh_dir(spark, "single"), F.col("_key")
    bad = F.col("transaction_id").eqNullSafe("") | F.col("amount").isin("0.00", "abc")
    lines = star.settlement_lines(spark, sf).filter(~bad)
    _write_single(lines.orderBy(key, "_seq").drop("_key", "_seq", "file_date"), folder, "all[1].csv")
    store = _store(spark, "single-lake")
    loaded = csv.load_file(store, f"{folder}/all[1].csv", "1999-01-31")
    table = store.read(csv.TABLE)
    return table.select("transaction_id", "reference_date", "amount", "_source_file", F.lit(loaded).cast("long").alias("loaded"))


@query
def settlements_loaded_at(spark, sf):
    """Rows per loaded file, and whether all carry a load time of this run."""
    started = spark.sql("SELECT current_timestamp()").first()[0]
    store, _ = _loaded_drop(spark, sf)
    fresh = F.bool_and(F.coalesce(F.col("_loaded_at") >= F.lit(started), F.lit(False))).alias("fresh")
    return store.read(csv.TABLE).groupBy("reference_date").agg(F.count("*").alias("rows"), fresh)


@query
def settlements_broken_rows(spark, sf):
    """One kind of broken row per month: blank merchant, unknown status, missing fields, ambiguous amount, long currency."""
    kind, hit = F.col("month") % 7, F.col("_key") % 20 == 0
    lines = star.settlement_lines(spark, sf).filter("_seq = 0").withColumn("month", F.year("file_date") * 12 + F.month("file_date"))
    lines = lines.withColumns({"transaction_id": F.concat(F.lit("T"), "_key"), "amount": F.concat("_key", F.lit(".50"))})
    broken = {
        "merchant_id": (0, "   "), "status": (1, "PENDING"), "currency": (2, None), "amount": (3, None),
        "processor_reference": (4, None),
    }
    for column, (n, value) in broken.items():
        lines = lines.withColumn(column, F.when((kind == n) & hit, F.lit(value)).otherwise(F.col(column)))
    lines = lines.withColumn("amount", F.when((kind == 5) & hit, F.lit("1,234.50")).otherwise(F.col("amount")))
    lines = lines.withColumn("currency", F.when((kind == 6) & hit, F.lit("REAL")).otherwise(F.col("currency")))
    folder = fresh_dir(spark, "broken")
    star.write_drop(lines.drop("month"), folder)
    verdicts = csv.judge_and_load(_store(spark, "broken-lake"), folder, r"file_date=(\d{4}-\d{2}-\d{2})", recursive=True)
    return verdicts.select(
        "reference_date", "rows", "loaded", F.array_join("reasons", "; ").alias("reasons"), F.array_join("warnings", "; ").alias("warnings")
    )


def _said(work: Callable[[], object]) -> str:
    try:
        return f"returned {work()}"
    except Exception as exc:
        return f"{type(exc).__name__}: {exc}"


@query
def refusals(spark, sf):
    """What loaders and checks say where inputs are missing, no file matches, or a key is not unique."""
    folder, store = fresh_dir(spark, "drop"), _store(spark, "refusing-lake")
    star.write_drop(star.settlement_lines(spark, sf), folder)
    company, runs = star.company(spark, sf), star.runs(spark, sf)
    cases = {
        "no folder": lambda: csv.load_directory(store, f"{folder}/nowhere", "(.*)"),
        "no file": lambda: csv.load_file(store, f"{folder}/none.csv", "2024-01-01"),
        "no file matches": lambda: csv.load_directory(store, folder, "(.*)", glob="*.tsv", recursive=True),
        "no batch": lambda: changelog.load_transactions(store, [f"{folder}/batch.parquet"]),
        "no silver": lambda: build.build_gold(store),
        "doubled merchants": lambda: quality.require_unique(company, ["merchant_id"], "company"),
        "unique runs": lambda: quality.require_unique(runs, ["id"], "runs"),
    }
    said = [(case, _said(work).replace(folder, "<drop>")) for case, work in cases.items()]
    return spark.createDataFrame(said, "case string, said string")


@query
def settlements_normalized(spark, sf):
    """Amount texts and what they parse to, every distinct pair once."""
    lines = star.settlement_lines(spark, sf)
    return lines.select("amount", normalize_amount(F.col("amount")).alias("parsed")).distinct()


@query
def settlements_upsert(spark, sf):
    """A table that is sent again in part, with changed amounts and new rows."""
    store = _store(spark, "upsert-lake")
    number = F.substring("transaction_id", 2, 20).cast("long")
    # Some have no date: they share the NULL partition.
    dated = F.when(number % 40 != 1, F.col("reference_date"))
    sent = star.settlements(spark, sf).withColumn("reference_date", dated)
    again = sent.filter((number % 3 == 0) & F.coalesce(F.year("reference_date") == 1997, F.lit(True)))
    store.upsert(csv.TABLE, sent.filter(number % 5 != 0), csv.KEYS)
    store.upsert(csv.TABLE, again.withColumn("amount", (F.col("amount") + 10).cast("decimal(18,2)")), csv.KEYS)
    table = store.read(csv.TABLE)
    return table.select("transaction_id", "reference_date", "merchant_id", "amount", "status")


@query
def settlements_union_by_name(spark, sf):
    """Two drops with different columns in different order, read together by name."""
    folder = fresh_dir(spark, "drift")
    lines = star.settlement_lines(spark, sf)
    early = F.col("file_date") < "1998-01-01"
    star.write_drop(lines.filter(early).drop("status", "settled_at", "processor_reference"), f"{folder}/a")
    star.write_drop(
        lines.filter(~early).select(
            "status", F.lower("merchant_id").alias("note"), "amount", "transaction_id", "file_date", "_key", "_seq"
        ),
        f"{folder}/b",
    )
    return csv.union_by_name(spark, folder, recursive=True).drop("name")


@query
def settlements_by_file(spark, sf):
    return csv.rows_by_file(star.settlements(spark, sf))


@query
def settlements_status_mix(spark, sf):
    return checks.status_mix(star.settlements(spark, sf))


@query
def settlements_reversed_check(spark, sf):
    return checks.reversed_check(checks.status_mix(star.settlements(spark, sf)))


@query
def settlements_per_day(spark, sf):
    return checks.settled_per_day(star.settlements(spark, sf))


@query
def settlements_amounts(spark, sf):
    stats = checks.amount_stats(star.settlements(spark, sf))
    return stats.withColumn("avg_amount", F.round("avg_amount", 4))


@query
def settlements_duplicate_ids(spark, sf):
    return quality.duplicate_keys(star.settlement_lines(spark, sf), ["transaction_id"])


# --- CFO report -----------------------------------------------------------------------------------


@query
def cfo_period(spark, sf):
    return reports.period_range(_weekly(spark, sf))


@query
def cfo_category_totals(spark, sf):
    return reports.category_totals(_weekly(spark, sf))


@query
def cfo_category_texts(spark, sf):
    """Category totals as a report prints them."""
    totals = reports.category_totals(_weekly(spark, sf))
    return totals.select("category", money(F.col("amount_brl")).alias("amount"), thousands(F.col("txn_count")).alias("transactions"))


@query
def cfo_headline(spark, sf):
    return reports.headline(reports.category_totals(_weekly(spark, sf)))


@query
def cfo_category_shares(spark, sf):
    shares = reports.category_shares(reports.category_totals(_weekly(spark, sf)))
    return shares.withColumn("share", F.round("share", 9))


@query
def cfo_daily_by_category(spark, sf):
    return reports.daily_by_category(_daily(spark, sf))


@query
def cfo_daily_table(spark, sf):
    return reports.daily_table(_daily(spark, sf))


@query
def cfo_top_merchants(spark, sf):
    return reports.top_merchants(_ranking(spark, sf))


@query
def cfo_weekly_rollup(spark, sf):
    return checks.weekly_rollup(_weekly(spark, sf))


@query
def cfo_distinct_weeks(spark, sf):
    return checks.distinct_values(_weekly(spark, sf), "week_start")


# --- run report ------------------------------------------------------------------------------------


def _run_lines(nested: DataFrame) -> DataFrame:
    lines = nested.drop("categories")
    return _times_as_text(lines, "started_at", "completed_at")


@query
def run_report_runs(spark, sf):
    """Runs of a year with their categories in one line."""
    window = reports.runs_between(_history(spark, sf), "1996-01-01", "1996-12-31")
    return _run_lines(reports.breakdown_text(reports.nested_runs(window)))


@query
def run_report_calendar(spark, sf):
    return _run_lines(reports.report_calendar(_history(spark, sf)))


@query
def run_report_ordered(spark, sf):
    ordered = reports.in_report_order(_history(spark, sf))
    return ordered.select("reference_date", "run_id", "category", "txn_count", "pct_of_total")


def _shown(artifact: str, rows: DataFrame, *columns: str) -> DataFrame:
    """Columns of an artifact with the position that each row has in the artifact's order."""
    placed = numbered(rows.select(*{*columns, *ORDER_COLUMNS[artifact]}), reports.report_order(artifact))
    return placed.select(*columns, "position")


#: Columns that the order of an artifact goes by.
ORDER_COLUMNS = {
    "gold_ops_reconciliation_daily": ("reference_date", "category"),
    "gold_ops_reconciliation_trend": ("reference_date", "category"),
    "gold_ops_run_history": ("reference_date", "started_at", "run_id", "category"),
    "gold_cfo_weekly_summary": ("week_start", "category"),
    "gold_cfo_weekly_merchant_ranking": ("week_start", "amount_brl", "merchant_id", "category", "legal_name", "trade_name"),
    "gold_compliance_ledger": ("reference_date", "run_id", "result_id", "legal_name", "document"),
}


@query
def ops_daily_positions(spark, sf):
    return _shown("gold_ops_reconciliation_daily", _daily(spark, sf), "reference_date", "category", "txn_count")


@query
def ops_trend_positions(spark, sf):
    return _shown("gold_ops_reconciliation_trend", _trended(spark, sf), "reference_date", "category", "run_id")


@query
def run_history_positions(spark, sf):
    return _shown("gold_ops_run_history", _history(spark, sf), "run_id", "category", "txn_count")


@query
def cfo_weekly_positions(spark, sf):
    return _shown("gold_cfo_weekly_summary", _weekly(spark, sf), "week_start", "category", "amount_brl")


@query
def cfo_ranking_positions(spark, sf):
    return _shown("gold_cfo_weekly_merchant_ranking", _ranking(spark, sf), "week_start", "merchant_id", "category", "legal_name", "amount_brl")


@query
def ledger_positions(spark, sf):
    rows = marts.compliance_ledger(star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf))
    return _shown("gold_compliance_ledger", rows, "result_id", "legal_name")


@query
def run_results_listed(spark, sf):
    """Per run its results as one text in order, and the hash of the text; a run has a few results."""
    part = F.concat_ws(":", "id", "category", F.coalesce(F.col("internal_amount").cast("string"), F.lit("-")))
    listed = star.results(spark, sf).withColumn("_part", part).groupBy("run_id").agg(
        F.expr("listagg(_part, ';') WITHIN GROUP (ORDER BY id, _part)").alias("results")
    )
    return listed.withColumn("digest", F.md5(F.col("results").cast("binary")))


@query
def no_data(spark, sf):
    """What alerts and reports say of a time before the first date: nothing."""
    before = F.col("reference_date") < "1900-01-01"
    trended, history = _trended(spark, sf).filter(before), _history(spark, sf).filter(before)
    weekly = _weekly(spark, sf).filter("week_start < '1900-01-01'")
    said = {
        "ops_alert": alerts.evaluate(trended), "alert_payload": alerts.payload(alerts.evaluate(trended)), "cfo_period": reports.period_range(weekly),
        "run_report": reports.nested_runs(history), "run_calendar": reports.report_calendar(history),
    }
    return reduce(DataFrame.union, [df.agg(F.lit(name).alias("product"), F.count("*").alias("rows")) for name, df in said.items()])


@query
def run_distinct_ids(spark, sf):
    return checks.distinct_values(_daily(spark, sf), "reference_date", "run_id")


# --- alerts -----------------------------------------------------------------------------------------


def _flat(evaluated: DataFrame) -> DataFrame:
    return evaluated.select(
        "reference_date",
        "run_status",
        "alert_level",
        "total",
        "match_rate",
        F.array_join(F.transform("alerts", lambda a: a["message"]), "\n").alias("messages"),
        F.array_join("breakdown", "\n").alias("breakdown"),
    )


@query
def ops_alerts(spark, sf):
    return _flat(alerts.evaluate(_trended(spark, sf)))


@query
def ops_alert_spikes(spark, sf):
    spikes = alerts.spikes(_trended(spark, sf))
    return spikes.withColumn("avg_7d", F.round("avg_7d", 9)).drop("message")


@query
def ops_alert_latest(spark, sf):
    trended = _trended(spark, sf)
    return _flat(alerts.evaluate(trended, dates=alerts.requested_date(star.runs(spark, sf), "")))


@query
def ops_alert_requested(spark, sf):
    """A year of dates asked for, days without any run among them."""
    days = star.runs(spark, sf).filter("year(reference_date) = 2001").select(
        F.explode(F.array(F.col("reference_date"), F.date_add("reference_date", 180))).alias("reference_date")
    )
    return _flat(alerts.evaluate(_trended(spark, sf), dates=days.distinct()))


@query
def ops_alert_payload(spark, sf):
    return alerts.payload(alerts.evaluate(_trended(spark, sf)))


@query
def ops_alert_files(spark, sf):
    """The payloads as written to one JSON file per date and read back."""
    folder = fresh_dir(spark, "alerts")
    alerts.write_payloads(alerts.payload(alerts.evaluate(_trended(spark, sf))), folder)
    return spark.read.text(folder).select(
        F.col("reference_date").cast("date"),
        F.get_json_object("value", "$.blocks[0].text.text").alias("title"),
        F.get_json_object("value", "$.blocks[1].fields[2].text").alias("total"),
    )


# --- profile ------------------------------------------------------------------------------------------


@query
def profile_results(spark, sf):
    return profile.profile(star.results(spark, sf), "results", ["id"])


@query
def profile_runs(spark, sf):
    return profile.profile(star.runs(spark, sf), "runs", ["reference_date", "status"])


@query
def profile_text_dates(spark, sf):
    """A table whose dates are text: the first column with a known name is taken."""
    log = cdc.union_batches(star.transaction_batches(spark, sf))
    return profile.ordered(profile.profile(log, "transactions", ["transaction_id"]))


@query
def merchant_duplicates(spark, sf):
    return quality.duplicate_keys(star.company(spark, sf), ["merchant_id"])


@query
def result_duplicates(spark, sf):
    return quality.duplicate_keys(star.results(spark, sf), ["run_id", "merchant_id"])


@query
def fingerprint_results(spark, sf):
    return profile.fingerprint(star.results(spark, sf), "transaction_id")


@query
def fingerprint_ordered(spark, sf):
    """Content and order of an amount column with NULLs, the results in order of run and id, ties by amount."""
    results = star.results(spark, sf).select("run_id", "id", "processor_amount")
    return profile.ordered_fingerprint(results, "processor_amount", ["run_id", "id"])


@query
def runs_joined_by_date(spark, sf):
    """The attempts of each date as one text, in order of their start; runs without an end have no text."""
    runs = star.runs(spark, sf).withColumn("attempt", F.when(F.col("status") != "IN_PROGRESS", F.concat("status", F.lit(" "), "id")))
    return runs.groupBy("reference_date").agg(F.count("*").alias("n"), joined("attempt", ["started_at", "id"], "; ").alias("attempts"))


# --- reconciliation --------------------------------------------------------------------------------


@query
def reconcile_transactions(spark, sf):
    return matching.reconcile(star.internal_side(spark, sf), star.processor_side(spark, sf))


@query
def reconcile_runs(spark, sf):
    """Per run date and category: the expansion of the literal per-run reading, counted."""
    per_run = matching.reconcile(star.internal_side(spark, sf), star.processor_side(spark, sf), scope="run")
    return per_run.groupBy("reference_date", "category").agg(
        F.count("*").alias("n"), F.sum("internal_amount").alias("internal_sum"), F.sum("difference").alias("difference_sum")
    )


@query
def reconcile_audit(spark, sf):
    """Recomputed categories against a stored classification that knows no window."""
    rest = F.col("o_orderkey") % 20
    stored = star.table(spark, sf, "orders").select(
        F.concat(F.lit("T"), F.col("o_orderkey")).alias("transaction_id"),
        F.when(rest == 19, "UNRECONCILED_PROCESSOR")
        .when(rest.isin(0, 7), "UNRECONCILED_INTERNAL")
        .when(rest.isin(2, 3), "MISMATCHED")
        .otherwise("MATCHED")
        .alias("category"),
    )
    recomputed = matching.reconcile(star.internal_side(spark, sf), star.processor_side(spark, sf))
    return matching.audit_categories(stored, recomputed)


@query
def unknown_to_internal(spark, sf):
    return checks.absent_from(star.processor_side(spark, sf), star.internal_side(spark, sf), "transaction_id")


@query
def known_to_processor(spark, sf):
    known = checks.present_in(star.internal_side(spark, sf), star.processor_side(spark, sf), "transaction_id")
    return known.select("transaction_id", "merchant_id", "amount")


@query
def both_sides_union(spark, sf):
    """UNION ALL of the ids of both sides, counted per side and merchant."""
    ids = (
        star.internal_side(spark, sf).select(F.lit("internal").alias("side"), "merchant_id")
        .union(star.processor_side(spark, sf).select(F.lit("processor").alias("side"), "merchant_id"))
    )
    return ids.groupBy("side", "merchant_id").agg(F.count("*").alias("n"))


@query
def newest_transactions(spark, sf):
    log = cdc.union_batches(star.transaction_batches(spark, sf))
    return checks.newest_rows(log, 10, ties=("id",))


@query
def drift_fill_rate(spark, sf):
    log = cdc.union_batches(star.transaction_batches(spark, sf))
    origin = F.when(F.col("_timestamp") < "2024-01-20", "batch_1_origin").otherwise("batch_2_origin")
    return checks.fill_rate(log, "payment_method", origin)


@query
def category_mix(spark, sf):
    return checks.category_mix(star.results(spark, sf))


@query
def run_operations(spark, sf):
    return checks.operations(star.runs_log(spark, sf))


# --- quality -------------------------------------------------------------------------------------------


def _result_rules() -> list[quality.Rule]:
    known = F.col("category").isin("MATCHED", "MISMATCHED", "UNRECONCILED_PROCESSOR", "UNRECONCILED_INTERNAL")
    return [
        quality.Rule("valid_transaction_id", F.col("transaction_id").isNotNull(), "transaction_id is NULL"),
        quality.Rule("amount_above_1000", F.col("internal_amount") > 1000, "amount too low", quality.DROP),
        quality.Rule("valid_category", known, "unknown category", quality.WARN),
        quality.Rule("small_difference", F.col("difference") <= 5, "large difference", quality.WARN),
    ]


@query
def quality_violations(spark, sf):
    return quality.violations(star.results(spark, sf), _result_rules())


@query
def quality_enforced(spark, sf):
    kept = quality.enforce(star.results(spark, sf), _result_rules())
    return kept.groupBy("category").agg(F.count("*").alias("n"), F.sum("internal_amount").alias("amount"))


@query
def quality_daily(spark, sf):
    return quality.daily_checks(_daily(spark, sf)).select(
        "reference_date",
        "volume",
        "match_rate",
        F.round("volume_mean", 6).alias("volume_mean"),
        F.round("volume_stddev", 6).alias("volume_stddev"),
        "low_match_rate",
        "unusual_volume",
    )


@query
def quality_daily_incremental(spark, sf):
    """Daily checks kept up: dates before 1998 first, then the others from the moments of the last date, some of them twice."""
    store, daily = _store(spark, "checks-lake"), _daily(spark, sf)
    dated.publish_whole(store, dated.DAILY, daily.filter("reference_date < '1998-01-01'"))
    dated.refresh_checks(store, [datetime.date(1900, 1, 1)])
    dated.publish_whole(store, dated.DAILY, daily)
    for first in (datetime.date(1998, 1, 1), datetime.date(1998, 4, 1)):
        dated.refresh_checks(store, [first])
    return store.read(dated.CHECKS).select(
        "reference_date",
        "volume",
        "match_rate",
        F.round("volume_mean", 6).alias("volume_mean"),
        F.round("volume_stddev", 6).alias("volume_stddev"),
        "low_match_rate",
        "unusual_volume",
    )


@query
def quality_audit_checks(spark, sf):
    """Audit rows of the daily checks and of the verdicts on settlement files."""
    folder = fresh_dir(spark, "audit")
    quality.append_audit(quality.daily_violations(quality.daily_checks(_daily(spark, sf))), folder, "run", dated.DAILY)
    _, verdicts = _loaded_drop(spark, sf)
    quality.append_audit(quality.file_violations(verdicts), folder, "run", csv.TABLE)
    return spark.read.parquet(folder).drop("checked_at")


@query
def quality_audit(spark, sf):
    folder = fresh_dir(spark, "audit")
    found = quality.violations(star.results(spark, sf), _result_rules())
    for label in ("first", "second"):
        quality.append_audit(found, folder, label, "silver_reconciliation_results")
    return spark.read.parquet(folder).drop("checked_at")


# --- streams and increments --------------------------------------------------------------------------

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    stream = changes.file_stream(spark, sf, EVENTS, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_append(spark, sf):
    """Events streamed into a table, all versions kept."""
    table, checkpoint = fresh_dir(spark, "stream-table"), fresh_dir(spark, "stream-checkpoint")
    changes.append_stream(_events(spark, sf), table, checkpoint).awaitTermination()
    return spark.read.parquet(table).groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("event_id").alias("last_event")
    )


@query
def stream_interval(spark, sf):
    """Events in several files, taken up by micro-batches at an interval until nothing is left."""
    folder, table, checkpoint = (fresh_dir(spark, x) for x in ("stream-files", "stream-table", "stream-checkpoint"))
    events = star.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(6).write.parquet(folder)
    stream = changes.file_stream(spark, folder, EVENTS.replace("timestamp_ntz", "timestamp"), files_per_batch=2)
    running = changes.append_stream(stream, table, checkpoint, every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    if sum(p["numInputRows"] > 0 for p in running.recentProgress) < 2:
        raise AssertionError("the events came in one batch")
    return spark.read.parquet(table).groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))


@query
def stream_upsert(spark, sf):
    """Events as settlements of their user and day, in two batches; what is sent last stays.

    Some have no day: they share the NULL partition, which the second batch touches too.
    """
    store, folder = _store(spark, "stream-lake"), fresh_dir(spark, "stream-files")
    events = star.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for half in (0, 1):
        events.filter(F.col("event_id") % 2 == half).repartition(2).write.mode("append").parquet(folder)
    stream = changes.file_stream(spark, folder, EVENTS.replace("timestamp_ntz", "timestamp"), files_per_batch=2).select(
        F.concat(F.lit("U"), F.col("user_id")).alias("transaction_id"),
        F.when(F.col("event_id") % 40 > 3, F.col("ts").cast("date")).alias("reference_date"),
        F.col("value").alias("amount"),
        "event_id",
    )
    handle = changes.upsert_handler(store, "daily_values", csv.KEYS, ["event_id"])
    changes.batch_stream(stream, handle, fresh_dir(spark, "stream-checkpoint")).awaitTermination()
    return store.read("daily_values")


@query
def stream_current_state(spark, sf):
    """Change log in several files, one per micro-batch, so that older changes come late.

    Some events have no user: NULL is a key like the others.
    """
    folder = fresh_dir(spark, "stream-files")
    log = star.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    log = log.withColumn("user_id", F.when(F.col("event_id") % 50 != 7, F.col("user_id")))
    part = F.pmod(F.col("event_id"), F.lit(3))
    for i in (2, 1, 0):
        log.filter(part == i).repartition(2).write.mode("append").parquet(folder)
    store = _store(spark, "state-lake")
    schema = EVENTS.replace("timestamp_ntz", "timestamp")
    stream = changes.file_stream(spark, folder, schema, files_per_batch=2)
    handle = changes.merge_changes_handler(store, "state", "user_id", ["ts", "event_id"], buckets=8)
    started = changes.batch_stream(stream, handle, fresh_dir(spark, "stream-checkpoint"))
    started.awaitTermination()
    if sum(p["numInputRows"] > 0 for p in started.recentProgress) < 2:
        raise AssertionError("the changes came in one batch, nothing was merged")
    current = store.read("state").filter("event_type <> 'error'")
    return current.select("user_id", "event_id", "event_type", "value")


@query
def stream_deduplicated(spark, sf):
    """Every event delivered twice, replays dropped inside the watermark."""
    twice = _events(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    unique = stream_matching.deduplicated(twice, "event_id", "ts").select("event_id", "event_type")
    table, checkpoint = fresh_dir(spark, "stream-table"), fresh_dir(spark, "stream-checkpoint")
    changes.append_stream(unique, table, checkpoint).awaitTermination()
    return spark.read.parquet(table)


#: Days of event time that a micro-batch of the matched streams covers; with a batch's delay they stay inside the lateness.
BATCH_DAYS, MATCH_LATENESS = 8, "21 days"


def _arriving(frame: DataFrame, at: str, label: str) -> tuple[str, int]:
    """Files in order of event time, every 13th row one batch late, and at last a row that closes the streams."""
    folder = fresh_dir(frame.sparkSession, label)
    day = F.datediff(F.col(at).cast("date"), F.lit("2024-01-01").cast("date"))
    late = (F.xxhash64("transaction_id", "amount") % 13 == 0).cast("int")
    numbered = frame.withColumn("_batch", F.floor(day / BATCH_DAYS) + F.coalesce(late, F.lit(0)))
    first, last = numbered.agg(F.min("_batch"), F.max("_batch")).first()
    for i in range(first, last + 1):
        numbered.filter(F.col("_batch") == i).drop("_batch").repartition(2).write.mode("append").parquet(folder)
    end = {"transaction_id": F.lit("end"), "amount": F.lit(0.0), at: F.lit("2100-01-01").cast("timestamp")}
    frame.sparkSession.range(2).select(*(end[c].alias(c) for c in frame.columns)).repartition(2).write.mode("append").parquet(folder)
    return folder, last - first + 1


@query
def stream_matches(spark, sf):
    """Two streams in several micro-batches: all four categories, late rows, rows without an id on both sides."""
    events = star.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    key, name = F.col("event_id"), F.col("event_id").cast("string")
    internal = events.select(
        F.when(key % 40 != 11, name).alias("transaction_id"), F.col("value").alias("amount"), F.col("ts").alias("created_at")
    )
    unknown = F.when(key % 5 == 0, F.concat(F.lit("P"), name)).otherwise(name)
    processor = events.select(
        F.when(key % 40 != 12, unknown).alias("transaction_id"),
        (F.col("value") + F.when(key % 9 == 0, 1.5).otherwise(0.0)).alias("amount"),
        (F.col("ts") + F.make_dt_interval(key.cast("int") % 12)).alias("settled_at"),
    )
    ours, theirs = _arriving(internal, "created_at", "internal-files")[0], _arriving(processor, "settled_at", "processor-files")[0]
    matched = stream_matching.match_streams(
        changes.file_stream(spark, ours, "transaction_id string, amount double, created_at timestamp", files_per_batch=2),
        changes.file_stream(spark, theirs, "transaction_id string, amount double, settled_at timestamp", files_per_batch=2),
        lateness=MATCH_LATENESS,
    )
    table, checkpoint = fresh_dir(spark, "stream-table"), fresh_dir(spark, "stream-checkpoint")
    changes.append_stream(matched.filter("transaction_id IS NULL OR transaction_id <> 'end'"), table, checkpoint).awaitTermination()
    return spark.read.parquet(table)


def _dates(runs: DataFrame) -> list:
    """One per calendar date."""
    return sorted(r[0] for r in runs.select("reference_date").distinct().collect())


def _arrival(spark: SparkSession, sf: str) -> tuple:
    """A store, the runs before some runs of 1998 arrive, the dates of these, and the results of the weeks they lie in.

    The results are stored by date; marts are built from the earlier runs and then refreshed for the dates.
    """
    runs, results, company = star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    late = (F.year("reference_date") == 1998) & (F.col("id") % 4 == 1)
    store, early, dates = _store(spark, "dated-lake"), runs.filter(~late), _dates(runs.filter(late))
    weeks = F.date_trunc("week", "reference_date").cast("date")
    at_hand = runs.filter(weeks >= F.lit("1997-12-29").cast("date"))
    days = dated.add_results(store, at_hand, results, "month")
    dated.refresh_current(store, runs, company, days, "month")
    return store, runs, early, dates


@query
def incremental_daily(spark, sf):
    """Daily mart without some runs of 1998, then refreshed for their dates."""
    store, runs, early, dates = _arrival(spark, sf)
    current = curated.results_current(early, star.results(spark, sf), star.company(spark, sf))
    dated.publish_whole(store, dated.DAILY, marts.ops_daily(early, current))
    return dated.refresh_daily(store, runs, dates, "month")


@query
def incremental_trend(spark, sf):
    store, runs, early, dates = _arrival(spark, sf)
    current = curated.results_current(early, star.results(spark, sf), star.company(spark, sf))
    daily = dated.publish_whole(store, dated.DAILY, marts.ops_daily(early, current))
    dated.publish_whole(store, dated.TREND, marts.ops_trend(daily))
    dated.publish_whole(store, dated.HISTORY, marts.run_history(early, star.results(spark, sf)))
    dated.refresh_ops(store, runs, dates, "month")
    return store.read(dated.TREND).withColumn("pct_of_total_7d_avg", F.round("pct_of_total_7d_avg", 9))


@query
def incremental_run_history(spark, sf):
    store, runs, early, dates = _arrival(spark, sf)
    dated.publish_whole(store, dated.HISTORY, marts.run_history(early, star.results(spark, sf)))
    dated.refresh_history(store, runs, dates, "month")
    return _times_as_text(store.read(dated.HISTORY), "started_at", "completed_at")


def _incremental_weeks(spark: SparkSession, sf: str) -> Store:
    store, runs, early, dates = _arrival(spark, sf)
    results, company = star.results(spark, sf), star.company(spark, sf)
    summary = marts.cfo_weekly_summary(curated.results_current(early, results, company))
    dated.publish_weeks(store, dated.SUMMARY, summary)
    ranking = marts.cfo_weekly_merchant_ranking(curated.results_current(early, results), company)
    dated.publish_weeks(store, dated.RANKING, ranking)
    dated.refresh_weeks(store, dates, grain="month")
    return store


@query
def incremental_weekly_summary(spark, sf):
    return _incremental_weeks(spark, sf).read(dated.SUMMARY)


@query
def incremental_weekly_ranking(spark, sf):
    return _incremental_weeks(spark, sf).read(dated.RANKING)


@query
def incremental_current(spark, sf):
    """Results of the winning runs, stored while some runs are missing, then found anew for the dates of these."""
    runs, results, company = star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    late = (F.year("reference_date") == 1998) & (F.col("id") % 4 == 1)
    store, early = _store(spark, "dated-lake"), runs.filter(~late)
    days = dated.add_results(store, early, results, "year")
    dated.refresh_current(store, early, company, days, "year")
    days = dated.add_results(store, runs.filter(late), results, "year")
    dated.refresh_current(store, runs, company, days, "year")
    return _times_as_text(store.read(dated.CURRENT), "created_at")


@query
def frozen_weeks(spark, sf):
    """Weekly summary of a partial load, kept where closed, fresh elsewhere."""
    runs, results, company = star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    store, partial = _store(spark, "frozen-lake"), results.filter("id % 8 <= 3")
    dated.publish_weeks(store, dated.SUMMARY, marts.cfo_weekly_summary(curated.results_current(runs, partial, company)))
    still_open = incremental.open_runs(runs, store.read(dated.SUMMARY), "1998-01-01")
    fresh = marts.cfo_weekly_summary(curated.results_current(still_open, results, company))
    return dated.publish_weeks(store, dated.SUMMARY, fresh, "1998-01-01")


@query
def ledger_appended(spark, sf):
    """Results of even ids, then all: the second time every run has grown or is new, and only new results are added."""
    runs, results, company = star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    store = _store(spark, "ledger-lake")
    for part in (results.filter("run_id % 2 = 0 AND id % 3 > 0"), results):
        dated.add_results(store, runs, part, "year")
        dated.append_ledger_by_run(store, runs, company, grain="year")
    ledger = store.read(dated.LEDGER)
    return ledger.select("result_id", "run_id", "reference_date", "run_status", "merchant_id", "legal_name", "category", "internal_amount")


@query
def snapshot_as_of(spark, sf):
    folder = fresh_dir(spark, "snapshots")
    runs, company = star.runs(spark, sf), star.company(spark, sf)
    for day, share in (("2024-01-05", 3), ("2024-01-12", 5), ("2024-01-19", 7)):
        seen = star.results(spark, sf).filter(F.col("id") % 8 <= share)
        summary = marts.cfo_weekly_summary(curated.results_current(runs, seen, company))
        incremental.write_snapshot(summary, folder, day)
    return incremental.read_as_of(spark.read.parquet(folder), "2024-01-15")


@query
def compliance_export(spark, sf):
    folder = fresh_dir(spark, "export")
    ledger = marts.compliance_ledger(
        star.runs(spark, sf), star.results(spark, sf), star.company(spark, sf)
    )
    incremental.export_by_date(ledger, folder)
    return spark.read.parquet(folder).groupBy("reference_date").agg(
        F.count("*").alias("rows"), F.sum("processor_amount").alias("processor_amount")
    )


