"""Distributed fixture generator: seeded extracts and settlement files of any size.

Every draw is a hash of (row id, purpose, seed). The data therefore does not depend on the
number of partitions, and a task that is run again produces the same rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.schemas import SETTLEMENT_COLUMNS

# Fixed values of the generated distributions.
CATEGORY_MIX = {"MATCHED": 0.85, "MISMATCHED": 0.05, "UNRECONCILED_PROCESSOR": 0.05, "UNRECONCILED_INTERNAL": 0.05}
STATUS_MIX = {"COMPLETED": 0.92, "PENDING": 0.05, "FAILED": 0.03}
CURRENCY_MIX = {"BRL": 0.95, "USD": 0.04, "EUR": 0.01}
PAYMENT_METHODS = {"pix": 0.15, "credit_card": 0.15, "debit_card": 0.15, "boleto": 0.15}
CNAE_CODES = {"4712100": 0.2, "5611203": 0.2, "4711302": 0.2, "6201501": 0.2, "4789099": 0.2}
DUPLICATE_TRANSACTION = 0.001
COMMA_DECIMAL = 0.0005
NULL_MERCHANT = 0.0001
ORPHAN_REVERSAL = 0.003
NO_ZONE_SUFFIX = 0.01
LOWER_CASE_MERCHANT = 0.0005
LATE_SETTLEMENT = 0.005
REVERSED_SHARE = 0.02
FIRST_BATCH_SHARE = 0.7

DAY = 86400
ISO = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


@dataclass(frozen=True)
class Fixture:
    rows: int = 1_000_000
    days: int = 90
    merchants: int = 500
    seed: int = 42
    dirty: bool = True
    start: str = "2025-03-01"
    partitions: int | None = None

    def draw(self, purpose: str) -> Column:
        """Uniform in [0, 1), by the low 53 bits of a hash."""
        bits = F.xxhash64(F.col("n"), F.lit(purpose), F.lit(self.seed)).bitwiseAND(F.lit((1 << 53) - 1))
        return bits / F.lit(float(1 << 53))

    def whole(self, purpose: str, low: int, high: int) -> Column:
        """Integer from low to high, both included."""
        return (F.floor(self.draw(purpose) * (high - low + 1)) + low).cast("long")

    def chance(self, purpose: str, rate: float) -> Column:
        """A dirty-data event; never without the dirty mode."""
        return self.draw(purpose) < rate if self.dirty else F.lit(False)

    def one_of(self, purpose: str, mix: dict[str, float]) -> Column:
        """A value by its weight; NULL with the weight that is left to 1."""
        u, picked, reached = self.draw(purpose), F.lit(None).cast("string"), 1.0
        bounds = []
        total = 0.0
        for value, weight in mix.items():
            total += weight
            bounds.append((value, total))
        if total > 1.0 - 1e-9:
            picked = F.lit(bounds[-1][0])
        for value, reached in reversed(bounds):
            picked = F.when(u < reached, value).otherwise(picked)
        return picked

    def ids(self, spark: SparkSession, count: int) -> DataFrame:
        return spark.range(1, count + 1, 1, self.partitions).withColumnRenamed("id", "n")


def _iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO)


def _uuid(text: Column) -> Column:
    digest = F.md5(text)
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in parts])


def _merchant(number: Column) -> Column:
    return F.concat(F.lit("MERCH_"), F.lpad(number.cast("string"), 4, "0"))


def _cents(amount: Column) -> Column:
    return F.round(amount, 2)


def _day_zero(fixture: Fixture) -> Column:
    return F.unix_timestamp(F.lit(fixture.start), "yyyy-MM-dd")


def company_log(spark: SparkSession, fixture: Fixture) -> DataFrame:
    base = F.unix_timestamp(F.lit("2024-01-01"), "yyyy-MM-dd")
    created = base + fixture.whole("company_created", 0, 365) * DAY
    updated = created + fixture.whole("company_updated", 0, 180) * DAY
    number = F.lpad(F.col("n").cast("string"), 4, "0")
    return fixture.ids(spark, fixture.merchants).select(
        F.col("n").alias("id"),
        _merchant(F.col("n")).alias("merchant_id"),
        F.concat(F.lit("Empresa "), number, F.lit(" LTDA")).alias("legal_name"),
        F.concat(F.lit("Loja "), number).alias("trade_name"),
        fixture.whole("document", 10**13, 10**14 - 1).cast("string").alias("document"),
        fixture.one_of("cnae", CNAE_CODES).alias("primary_cnae"),
        _iso(created).alias("created_at"),
        _iso(updated).alias("updated_at"),
        F.lit("I").alias("Op"),
        _iso(created).alias("_timestamp"),
    )


def facts(spark: SparkSession, fixture: Fixture) -> DataFrame:
    """One row per transaction with both sides, from which all extracts are cut."""
    f = fixture
    radius = F.sqrt(-2.0 * F.log(1.0 - f.draw("normal_radius")))
    normal = radius * F.cos(2 * math.pi * f.draw("normal_angle"))
    amount = F.greatest(F.least(_cents(F.exp(4.5 + 1.2 * normal)), F.lit(500000.0)), F.lit(0.5))
    off = _cents((0.05 + 4.95 * f.draw("off_size")) * F.when(f.draw("off_sign") < 0.5, -1).otherwise(1))
    cent = F.when(f.draw("cent_sign") < 0.5, -0.01).otherwise(0.01)
    mismatched = F.col("category") == "MISMATCHED"
    theirs = (
        F.when(mismatched, F.greatest(F.lit(0.01), _cents(F.col("base") + off)))
        .when(f.draw("cent") < 0.3, _cents(F.col("base") + cent))
        .otherwise(F.col("base"))
    )
    settled = F.col("created") + F.when(
        f.chance("late", LATE_SETTLEMENT), f.whole("late_days", 8, 15) * DAY
    ).otherwise(f.whole("settle_hours", 1, 48) * 3600)
    has_internal = F.col("category") != "UNRECONCILED_PROCESSOR"
    has_processor = F.col("category") != "UNRECONCILED_INTERNAL"
    return (
        f.ids(spark, f.rows)
        .withColumns(
            {
                "category": f.one_of("category", CATEGORY_MIX),
                "base": amount,
                "created": _day_zero(f) + f.whole("day", 0, f.days - 1) * DAY + f.whole("second", 0, DAY - 1),
                "merchant_id": _merchant(f.whole("merchant", 1, f.merchants)),
                "currency": f.one_of("currency", CURRENCY_MIX),
                "transaction_id": _uuid(F.concat_ws("/", F.lit(f.seed), "n")),
            }
        )
        .withColumns(
            {
                "internal_amount": F.when(has_internal, F.col("base")),
                "processor_amount": F.when(has_processor, theirs),
                "settled": F.when(has_processor, settled),
            }
        )
        .withColumn("anchor", F.timestamp_seconds(F.coalesce("settled", "created")).cast("date"))
        .withColumn("run_id", F.datediff("anchor", F.lit(f.start).cast("date")).cast("long") + 1)
    )


def transaction_logs(spark: SparkSession, fixture: Fixture) -> tuple[DataFrame, DataFrame]:
    """The two batches; only the later one has payment_method. Replays follow a second later."""
    f = fixture
    replay = F.when(f.chance("replay", DUPLICATE_TRANSACTION), F.array(F.lit(0), F.lit(1)))
    created = F.col("created")
    log = (
        facts(spark, f)
        .filter(F.col("internal_amount").isNotNull())
        .withColumn("copy", F.explode(F.coalesce(replay, F.array(F.lit(0)))))
        .select(
            (F.col("n") + F.col("copy") * f.rows).alias("id"),
            "transaction_id",
            F.when(~f.chance("null_merchant", NULL_MERCHANT), F.col("merchant_id")).alias("merchant_id"),
            F.col("internal_amount").alias("amount"),
            "currency",
            f.one_of("status", STATUS_MIX).alias("status"),
            F.concat(F.lit("Payment "), "n").alias("description"),
            _iso(created).alias("created_at"),
            _iso(created + f.whole("update_minutes", 0, 180) * 60).alias("updated_at"),
            F.lit("I").alias("Op"),
            _iso(created + F.col("copy")).alias("_timestamp"),
            f.one_of("payment_method", PAYMENT_METHODS).alias("payment_method"),
            created.alias("_created"),
        )
    )
    later = F.col("_created") >= _day_zero(f) + int(f.days * FIRST_BATCH_SHARE) * DAY
    return log.filter(~later).drop("_created", "payment_method"), log.filter(later).drop("_created")


def results_log(spark: SparkSession, fixture: Fixture) -> DataFrame:
    created = _iso(F.col("created"))
    return facts(spark, fixture).select(
        F.col("n").alias("id"),
        "run_id",
        "transaction_id",
        "merchant_id",
        "category",
        "internal_amount",
        "processor_amount",
        _cents(F.abs(F.col("internal_amount") - F.col("processor_amount"))).alias("difference"),
        created.alias("created_at"),
        F.lit("I").alias("Op"),
        created.alias("_timestamp"),
    )


def settlement_lines(spark: SparkSession, fixture: Fixture) -> DataFrame:
    """Lines of the daily settlement files with ``file_date``; reversals without any partner
    are added in the dirty mode."""
    f = fixture
    zone = F.when(f.chance("no_zone", NO_ZONE_SUFFIX), "").otherwise("Z")
    stamp = F.date_format(F.timestamp_seconds("settled"), "yyyy-MM-dd'T'HH:mm:ss")
    plain = F.col("processor_amount").cast("decimal(18,2)").cast("string")
    regular = (
        facts(spark, f)
        .filter(F.col("processor_amount").isNotNull())
        .select(
            "transaction_id",
            F.when(f.chance("lower_case", LOWER_CASE_MERCHANT), F.lower("merchant_id")).otherwise(F.col("merchant_id")).alias("merchant_id"),
            F.when(f.chance("comma", COMMA_DECIMAL), F.replace(plain, F.lit("."), F.lit(","))).otherwise(plain).alias("amount"),
            "currency",
            F.concat(stamp, zone).alias("settled_at"),
            F.concat(F.lit("PS-"), F.substring(stamp, 1, 4), F.lit("-"), F.lpad(F.col("n").cast("string"), 10, "0")).alias("processor_reference"),
            F.when(f.draw("reversed") < REVERSED_SHARE, "REVERSED").otherwise("SETTLED").alias("status"),
            F.col("anchor").alias("file_date"),
        )
    )
    if not f.dirty:
        return regular
    settled = _day_zero(f) + f.whole("orphan_day", 0, f.days - 1) * DAY + f.whole("orphan_second", 0, DAY - 1)
    at = F.timestamp_seconds(settled)
    orphans = f.ids(spark, max(1, int(f.rows * ORPHAN_REVERSAL))).select(
        _uuid(F.concat_ws("/", F.lit("orphan"), F.lit(f.seed), "n")).alias("transaction_id"),
        _merchant(f.whole("orphan_merchant", 1, f.merchants)).alias("merchant_id"),
        _cents(10 + 4990 * f.draw("orphan_amount")).cast("decimal(18,2)").cast("string").alias("amount"),
        F.lit("BRL").alias("currency"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("settled_at"),
        F.concat(F.lit("PS-ORPHAN-"), F.lpad(F.col("n").cast("string"), 10, "0")).alias("processor_reference"),
        F.lit("REVERSED").alias("status"),
        at.cast("date").alias("file_date"),
    )
    return regular.unionByName(orphans)


def runs_log(spark: SparkSession, fixture: Fixture) -> DataFrame:
    """Insert and update of one run per date; totals count the lines of the date's file."""
    lines = settlement_lines(spark, fixture).groupBy("file_date").agg(F.count("*").alias("lines"))
    dates = facts(spark, fixture).select(F.col("anchor").alias("file_date"), "run_id").distinct()
    started = F.unix_timestamp("file_date") + 2 * 3600
    minutes = F.pmod(F.xxhash64("run_id", F.lit(fixture.seed)), F.lit(86)) + 5
    both = F.array(F.lit("I"), F.lit("U"))
    ended = F.col("Op") == "U"
    completed = started + minutes * 60
    return (
        dates.join(lines, "file_date", "left")
        .withColumn("Op", F.explode(both))
        .select(
            F.col("run_id").alias("id"),
            F.col("file_date").cast("string").alias("reference_date"),
            F.concat(F.lit("settlement_"), F.col("file_date").cast("string"), F.lit(".csv")).alias("file_name"),
            F.when(ended, "COMPLETED").otherwise("IN_PROGRESS").alias("status"),
            F.coalesce("lines", F.lit(0)).cast("long").alias("total_transactions"),
            _iso(started).alias("started_at"),
            F.when(ended, _iso(completed)).alias("completed_at"),
            _iso(started).alias("created_at"),
            "Op",
            _iso(F.when(ended, completed).otherwise(started)).alias("_timestamp"),
        )
    )


def write_all(spark: SparkSession, fixture: Fixture, folder: str) -> None:
    """All extracts below ``folder``; settlement files in one folder per date."""
    first, second = transaction_logs(spark, fixture)
    for name, log in {
        "enterprise_company": company_log(spark, fixture),
        "transactions_batch_1": first,
        "transactions_batch_2": second,
        "reconciliation_runs": runs_log(spark, fixture),
        "reconciliation_results": results_log(spark, fixture),
    }.items():
        log.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    (
        settlement_lines(spark, fixture)
        .select(*SETTLEMENT_COLUMNS, "file_date")
        .hint("rebalance", "file_date")
        .write.mode("overwrite")
        .partitionBy("file_date")
        .option("header", True)
        .csv(f"{folder}/paysettler")
    )
