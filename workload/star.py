"""The domain's tables, derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
DAY_SECONDS = 86400


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _iso(instant: Column) -> Column:
    return F.date_format(instant, ISO)


def _later(instant: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(instant) + seconds)


# --- silver tables ---------------------------------------------------------------


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as reconciliation runs: many attempts per date, a third of them completed."""
    status = F.col("o_orderstatus")
    started = _later(_instant("o_orderdate"), (F.col("o_orderkey") * 7919) % DAY_SECONDS)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("reference_date"),
        F.concat(F.lit("settlement_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv")).alias("file_name"),
        F.when(status == "F", "COMPLETED").when(status == "O", "IN_PROGRESS").otherwise("FAILED").alias("status"),
        F.col("o_custkey").cast("int").alias("total_transactions"),
        started.alias("started_at"),
        F.when(status == "F", _later(started, F.lit(600))).alias("completed_at"),
        started.alias("created_at"),
        F.lit("historical_backfill").alias("source"),
    )


def _category() -> Column:
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((flag == "R") & (line == "F"), "UNRECONCILED_PROCESSOR")
        .when((flag == "R") & (line == "O"), "UNRECONCILED_INTERNAL")
        .when((flag == "A") & (line == "F"), "MISMATCHED")
        .otherwise("MATCHED")
    )


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as reconciliation results of the run with the order's id."""
    category, price = F.col("category"), F.col("l_extendedprice").cast("decimal(18,2)")
    internal = F.when(category != "UNRECONCILED_PROCESSOR", price)
    processor = F.when(category == "MISMATCHED", price + F.col("l_linenumber")).when(
        category != "UNRECONCILED_INTERNAL", price
    )
    return (
        table(spark, sf, "lineitem")
        .withColumn("category", _category())
        .select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("run_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("transaction_id"),
            F.col("l_suppkey").cast("string").alias("merchant_id"),
            "category",
            internal.cast("decimal(18,2)").alias("internal_amount"),
            processor.cast("decimal(18,2)").alias("processor_amount"),
            F.abs(internal - processor).cast("decimal(18,2)").alias("difference"),
            _instant("l_shipdate").alias("created_at"),
            F.lit("historical_backfill").alias("source"),
        )
    )


def company(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as merchants: some unknown, every 25th listed twice, some without trade name."""
    key = F.col("s_suppkey")
    copies = F.when(key % 25 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    trade = F.when(F.col("s_nationkey") % 5 == 0, "").when(
        F.col("s_nationkey") % 3 != 0, F.concat(F.lit("Loja "), key)
    )
    return (
        table(spark, sf, "supplier")
        .filter("s_acctbal > 0")
        .withColumn("copy", F.explode(copies))
        .select(
            (key + F.col("copy") * 1000000000).alias("id"),
            key.cast("string").alias("merchant_id"),
            F.concat(F.col("s_name"), F.when(F.col("copy") == 1, " II").otherwise("")).alias("legal_name"),
            trade.alias("trade_name"),
            F.lpad(key.cast("string"), 14, "0").alias("document"),
            F.col("s_nationkey").cast("string").alias("primary_cnae"),
            F.lit("2024-01-01").cast("timestamp").alias("created_at"),
            F.lit("2024-01-01").cast("timestamp").alias("updated_at"),
        )
    )


# --- change logs ---------------------------------------------------------------------


def _changes(df: DataFrame, *versions: Column) -> DataFrame:
    return df.select(F.explode(F.array_compact(F.array(*versions))).alias("v")).select("v.*")


def runs_log(spark: SparkSession, sf: str) -> DataFrame:
    """Insert of every run, update of the ended ones, delete of every 50th."""

    def version(op: str, status: Column, completed: Column, at: Column) -> Column:
        return F.struct(
            "id",
            F.col("reference_date").cast("string").alias("reference_date"),
            "file_name",
            status.alias("status"),
            F.col("total_transactions").cast("long").alias("total_transactions"),
            _iso(F.col("started_at")).alias("started_at"),
            _iso(completed).alias("completed_at"),
            _iso(F.col("created_at")).alias("created_at"),
            F.lit(op).alias("Op"),
            _iso(at).alias("_timestamp"),
        )

    status, started = F.col("status"), F.col("started_at")
    none = F.lit(None).cast("timestamp")
    return _changes(
        runs(spark, sf),
        version("I", F.lit("IN_PROGRESS"), none, started),
        F.when(status != "IN_PROGRESS", version("U", status, F.col("completed_at"), _later(started, F.lit(600)))),
        F.when(F.col("id") % 50 == 0, version("D", status, none, _later(started, F.lit(7200)))),
    )


RESULT_TIES = ("transaction_id", "merchant_id", "price")


def results_log(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as changes of results: several per id, some of them deletes."""
    op = F.when(F.col("l_quantity") > 48, "D").when(F.col("l_linenumber") > 4, "U").otherwise("I")
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("run_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("transaction_id"),
        F.col("l_suppkey").cast("string").alias("merchant_id"),
        _category().alias("category"),
        price.alias("internal_amount"),
        price.alias("processor_amount"),
        F.lit(0.0).alias("difference"),
        _iso(_instant("l_shipdate")).alias("created_at"),
        op.alias("Op"),
        _iso(_instant("l_shipdate")).alias("_timestamp"),
        price.alias("price"),
    )


def company_log(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as merchants with a rename for every third and a delete for every tenth."""
    key = F.col("c_custkey")
    start = F.lit("2024-01-01").cast("timestamp")

    def version(op: str, trade: str, at: Column) -> Column:
        return F.struct(
            key.alias("id"),
            F.concat(F.lit("M"), key).alias("merchant_id"),
            F.col("c_name").alias("legal_name"),
            F.concat(F.lit(trade), key).alias("trade_name"),
            F.lpad(key.cast("string"), 14, "0").alias("document"),
            F.col("c_nationkey").cast("string").alias("primary_cnae"),
            _iso(start).alias("created_at"),
            _iso(at).alias("updated_at"),
            F.lit(op).alias("Op"),
            _iso(at).alias("_timestamp"),
        )

    first = _later(start, key % 1000 * 3600)
    return _changes(
        table(spark, sf, "customer"),
        version("I", "Loja ", first),
        F.when(key % 3 == 0, version("U", "Nova ", _later(first, F.lit(40 * DAY_SECONDS)))),
        F.when(key % 10 == 0, version("D", "Nova ", _later(first, F.lit(90 * DAY_SECONDS)))),
    )


def supplier_log(spark: SparkSession, sf: str) -> DataFrame:
    """The merchants as inserts of a change log."""
    stamps = {c: _iso(F.col(c)) for c in ("created_at", "updated_at")}
    return company(spark, sf).withColumns(stamps).withColumns(
        {"Op": F.lit("I"), "_timestamp": F.col("created_at")}
    )


def transaction_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Events as transaction changes in two batches; only the second has payment_method."""
    kind = F.col("event_type")
    op = F.when((kind == "view") & (F.col("event_id") % 97 == 0), None)
    op = op.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U")
    changes = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("U"), F.col("user_id")).alias("transaction_id"),
        F.col("value").alias("amount"),
        op.alias("Op"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_timestamp"),
        F.get_json_object("props", "$.k").alias("payment_method"),
    )
    second = F.col("_timestamp") >= "2024-01-20"
    return [changes.filter(~second).drop("payment_method"), changes.filter(second)]


# --- settlement files ------------------------------------------------------------------


def settlement_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as settlement file lines, one file per month of the order date.

    Amounts come in three notations; every 200th transaction occurs twice, the second time
    with another amount. Of 13 months one holds zero amounts, one blank ids, one unreadable
    amounts.
    """
    key, month = F.col("o_orderkey"), F.col("month")
    cents = F.col("o_totalprice").cast("decimal(18,2)") + F.col("seq")
    units, hundredths = F.floor(cents), F.lpad((cents * 100 % 100).cast("int").cast("string"), 2, "0")
    grouped = F.replace(F.format_number(units, 0), F.lit(","), F.lit("."))
    notation = (
        F.when(key % 25 == 0, F.concat(F.lit("R$ "), grouped, F.lit(","), hundredths))
        .when(key % 7 == 0, F.concat(units.cast("string"), F.lit(","), hundredths))
        .otherwise(cents.cast("string"))
    )
    amount = (
        F.when((month % 13 == 0) & (key % 20 == 0), "0.00")
        .when((month % 13 == 2) & (key % 20 == 0), "abc")
        .otherwise(notation)
    )
    copies = F.when(key % 200 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    zone = F.when(key % 100 == 0, "").otherwise("Z")
    return (
        table(spark, sf, "orders")
        .withColumn("month", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
        .withColumn("seq", F.explode(copies))
        .select(
            F.when((month % 13 == 1) & (key % 20 == 0), "").otherwise(F.concat(F.lit("T"), key)).alias("transaction_id"),
            F.concat(F.lit("M"), F.col("o_custkey")).alias("merchant_id"),
            amount.alias("amount"),
            F.lit("BRL").alias("currency"),
            F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), zone).alias("settled_at"),
            F.concat(F.lit("PS-"), key).alias("processor_reference"),
            F.when(key % 50 == 0, "REVERSED").otherwise("SETTLED").alias("status"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("file_date"),
            key.alias("_key"),
            F.col("seq").alias("_seq"),
        )
    )


def write_drop(lines: DataFrame, folder: str) -> None:
    """One CSV per file date, lines in key order, in folders that carry the date."""
    (
        lines.hint("rebalance", "file_date")
        .sortWithinPartitions("file_date", "_key", "_seq")
        .drop("_key", "_seq")
        .write.partitionBy("file_date")
        .option("header", True)
        .option("emptyValue", "")
        .option("escape", '"')
        .csv(folder)
    )


def settlements(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as loaded settlements of monthly files."""
    key, month = F.col("o_orderkey"), F.trunc(F.col("o_orderdate").cast("date"), "month")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("T"), key).alias("transaction_id"),
        F.concat(F.lit("M"), F.col("o_custkey")).alias("merchant_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.lit("BRL").alias("currency"),
        _instant("o_orderdate").alias("settled_at"),
        F.concat(F.lit("PS-"), key).alias("processor_reference"),
        F.when(key % 50 == 0, "REVERSED").otherwise("SETTLED").alias("status"),
        F.lit("2024-01-01").cast("timestamp").alias("_loaded_at"),
        F.concat(F.lit("settlement_"), month.cast("string"), F.lit(".csv")).alias("_source_file"),
        month.alias("reference_date"),
    )


# --- two sides ---------------------------------------------------------------------------


def internal_side(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as internal transactions, every 20th (remainder 19) missing."""
    return (
        table(spark, sf, "orders")
        .filter("o_orderkey % 20 <> 19")
        .select(
            F.concat(F.lit("T"), F.col("o_orderkey")).alias("transaction_id"),
            F.concat(F.lit("M"), F.col("o_custkey")).alias("merchant_id"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            _instant("o_orderdate").alias("created_at"),
        )
    )


def processor_side(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as settlements: some absent, some off by a cent or more, some late, some early."""
    key = F.col("o_orderkey")
    rest = key % 20
    offset = F.when(rest == 1, "0.01").when(rest == 2, "0.02").when(rest == 3, "-5.00").otherwise("0.00")
    delay = F.when(rest == 4, 8).when(rest == 5, 7).when(rest == 6, -1).otherwise(key % 3)
    return (
        table(spark, sf, "orders")
        .filter("o_orderkey % 20 NOT IN (0, 7)")
        .select(
            F.concat(F.lit("T"), key).alias("transaction_id"),
            F.concat(F.lit("M"), F.col("o_custkey")).alias("merchant_id"),
            (F.col("o_totalprice").cast("decimal(18,2)") + offset.cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"),
            F.date_add(F.col("o_orderdate").cast("date"), delay.cast("int")).alias("reference_date"),
        )
    )
