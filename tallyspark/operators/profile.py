"""Table health: row and column counts, NULLs, duplicate keys, date range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tallyspark.operators.ordering import numbered

# Text columns that may hold dates, where no column has a date type.
DATE_NAMES = ("_timestamp", "created_at", "updated_at", "settled_at", "reference_date")


def date_column(df: DataFrame) -> str | None:
    """The first column of a date or timestamp type, else the first with a known name."""
    fields = df.schema.fields
    typed = [f.name for f in fields if isinstance(f.dataType, DateType | TimestampType | TimestampNTZType)]
    named = [f.name for f in fields if f.name in DATE_NAMES]
    return next(iter(typed + named), None)


def profile(df: DataFrame, table: str, key: Sequence[str] = ()) -> DataFrame:
    """Health of a table as rows (table, metric, column, value, pct).

    One aggregation reads the table once; the duplicate count is a second, on the key
    columns only. Columns without NULLs are left out.
    """
    names = df.columns
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(names)]
    day = date_column(df)
    when = F.col(f"`{day}`").try_cast("timestamp") if day else F.lit(None).cast("timestamp")
    stats = df.agg(
        F.count("*").alias("rows"), F.min(when).alias("low"), F.max(when).alias("high"), *nulls
    )

    def line(metric, column, value, pct=None):
        return F.struct(
            F.lit(metric).alias("metric"),
            F.lit(column).cast("string").alias("column"),
            value.cast("string").alias("value"),
            (F.lit(None) if pct is None else pct).cast("double").alias("pct"),
        )

    rows = F.col("rows")
    lines = [line("row_count", None, rows), line("column_count", None, F.lit(len(names)))]
    if day:
        text = "yyyy-MM-dd HH:mm:ss"
        lines.append(line("date_min", day, F.date_format("low", text)))
        lines.append(line("date_max", day, F.date_format("high", text)))
    for i, name in enumerate(names):
        count = F.col(f"null_{i}")
        lines.append(line("null_count", name, count, F.round(count / F.nullif(rows, F.lit(0)) * 100, 1)))
    report = (
        stats.select(F.explode(F.array(*lines)).alias("l"))
        .select("l.*")
        .filter("metric <> 'null_count' OR value <> '0'")
    )
    if key:
        duplicates = df.groupBy(*key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("d"))
        report = report.unionByName(
            duplicates.select(line("duplicate_pk_count", ",".join(key), F.col("d")).alias("l")).select("l.*")
        )
    return report.select(F.lit(table).alias("table"), "metric", "column", "value", "pct")


def ordered(report: DataFrame) -> DataFrame:
    """Summary lines first, then NULL counts, highest first."""
    is_null = F.col("metric") == "null_count"
    return report.orderBy(
        is_null, F.when(is_null, F.col("value").cast("long")).desc_nulls_last(), "metric", "column"
    )


def fingerprint(df: DataFrame, column: str) -> DataFrame:
    """Order-free content hash of a column: (rows, hash_sum, hash_xor).

    Concatenating all values in order would need them in one place; sum and xor of a
    60-bit hash merge from partial aggregates instead.
    """
    digest = F.conv(F.substring(F.md5(F.col(column).cast("string")), 1, 15), 16, 10).cast("long")
    return df.select(digest.alias("h")).agg(
        F.count("*").alias("rows"),
        F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"),
    )


def ordered_fingerprint(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Content hash of a column that tells its order, too: (rows, hash_sum, hash_xor).

    Each value is hashed together with its position in the sorted table, so that two values
    that change places change the hash, and NULL differs from the empty text. Positions come
    from ``ordering.numbered``, so neither the sort nor the hash needs the table in one task.
    NULL comes first, and rows that tie in ``order`` go by their value, so that the hash is the same in every run.
    """
    keys = list(dict.fromkeys([*order, column]))
    placed = numbered(df.select(*keys), [F.col(k).asc_nulls_first() for k in keys])
    value = F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))
    return fingerprint(placed.select(F.concat("position", value).alias("placed")), "placed")
