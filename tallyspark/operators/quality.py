"""Row rules, aggregate checks and the audit trail."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

FAIL, DROP, WARN = "fail", "drop", "warn"

# Fixed values of the daily checks.
MIN_MATCH_RATE = 0.80
VOLUME_DEVIATIONS = 2.0


@dataclass(frozen=True)
class Rule:
    """``holds`` is what a good row satisfies; a row violates it only where it is FALSE."""

    name: str
    holds: Column
    message: str
    action: str = FAIL

    @property
    def violated(self) -> Column:
        return F.coalesce(~self.holds, F.lit(False))

    @property
    def count(self) -> Column:
        return F.count_if(self.violated).alias(self.name)


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, action, violations, rows) from one aggregation over the data."""
    totals = df.agg(F.count("*").alias("_rows"), *[r.count for r in rules])
    listed = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.lit(r.message).alias("message"),
                F.col(r.name).alias("violations"),
                F.col("_rows").alias("rows"),
            )
            for r in rules
        ]
    )
    return totals.select(F.explode(listed).alias("r")).select("r.*")


def enforce(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None
) -> DataFrame:
    """Rows that may go on: a "fail" violation ends the job, a "drop" violation removes the
    row, a "warn" violation is only counted.

    Counts of all rules come with the job itself if an Observation is given.
    """
    if observation is not None:
        df = df.observe(observation, F.count("*").alias("rows"), *[r.count for r in rules])
    failing = [r for r in rules if r.action == FAIL]
    if failing:
        check = F.coalesce(
            *[F.when(r.violated, F.raise_error(F.lit(r.message)).cast("boolean")) for r in failing],
            F.lit(True),
        )
        df = df.filter(check)
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(~rule.violated)
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row and how many; NULLs are equal to each other."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    duplicates = duplicate_keys(df, keys).count()
    if duplicates:
        raise ValueError(f"{name}: {duplicates} duplicate key(s) on ({', '.join(keys)})")


def daily_totals(daily: DataFrame) -> DataFrame:
    """(reference_date, volume, match_rate) from the daily mart, one row per calendar date."""
    matched = F.col("category") == "MATCHED"
    return daily.groupBy("reference_date").agg(
        F.sum("txn_count").alias("volume"),
        F.coalesce(F.max(F.when(matched, F.col("pct_of_total"))), F.lit(0.0)).alias("match_rate"),
    )


def _checked(per_date: DataFrame, min_match_rate: float, deviations: float) -> dict[str, Column]:
    unusual = F.abs(F.col("volume") - F.col("volume_mean")) > F.col("volume_stddev") * deviations
    return {
        "low_match_rate": F.col("match_rate") <= min_match_rate,
        "unusual_volume": F.coalesce(unusual, F.lit(False)),
    }


def daily_checks(
    daily: DataFrame,
    min_match_rate: float = MIN_MATCH_RATE,
    deviations: float = VOLUME_DEVIATIONS,
) -> DataFrame:
    """Soft checks per date: match rate, and volume against all previous dates.

    The input is the daily mart. Its dates are totalled before the window, which therefore
    sees one row per calendar date.
    """
    per_date = daily_totals(daily)
    before = Window.orderBy("reference_date").rowsBetween(Window.unboundedPreceding, -1)
    mean, spread = F.avg("volume").over(before), F.stddev_samp("volume").over(before)
    measured = per_date.withColumn("volume_mean", mean).withColumn("volume_stddev", spread)
    return measured.withColumns(_checked(measured, min_match_rate, deviations))


#: Nothing before the first date.
NO_MOMENTS = {"n": 0, "mean": 0.0, "m2": 0.0}


def daily_checks_after(
    daily: DataFrame,
    moments: dict,
    min_match_rate: float = MIN_MATCH_RATE,
    deviations: float = VOLUME_DEVIATIONS,
) -> DataFrame:
    """The same for dates that follow others, of which only the moments are known: count, mean,
    and sum of squared deviations. Adds ``n``, ``mean`` and ``m2`` up to and with each date.

    Moments merge: with volumes taken from the mean so far, d = v - mean, the new ones are
    n + k, mean + S(d) / (n + k), and m2 + S(d d) - S(d)^2 / (n + k). So a new date needs the
    last one's moments, not the history.
    """
    d = F.col("volume").cast("double") - F.lit(float(moments["mean"]))
    upto = Window.orderBy("reference_date").rowsBetween(Window.unboundedPreceding, 0)
    n = F.lit(int(moments["n"])) + F.count("*").over(upto)
    own = daily_totals(daily).withColumns({"_s": F.sum(d).over(upto), "_ss": F.sum(d * d).over(upto), "n": n})
    merged = own.withColumns(
        {
            "mean": F.lit(float(moments["mean"])) + F.col("_s") / F.col("n"),
            "m2": F.greatest(F.lit(float(moments["m2"])) + F.col("_ss") - F.col("_s") * F.col("_s") / F.col("n"), F.lit(0.0)),
        }
    )

    def before(column: str) -> Column:
        return F.lag(column, 1, moments[column]).over(Window.orderBy("reference_date"))

    known = merged.withColumns({"_n": before("n"), "_mean": before("mean"), "_m2": before("m2")})
    measured = known.withColumns(
        {
            "volume_mean": F.when(F.col("_n") > 0, F.col("_mean")),
            "volume_stddev": F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1))),
        }
    )
    return measured.withColumns(_checked(measured, min_match_rate, deviations)).drop("_s", "_ss", "_n", "_mean", "_m2")


def daily_violations(checked: DataFrame) -> DataFrame:
    """Daily checks as rule rows: dates that fail each check, of all dates."""
    return _as_rules(checked, {"match_rate": F.col("low_match_rate"), "daily_volume": F.col("unusual_volume")}, WARN)


def file_violations(verdicts: DataFrame) -> DataFrame:
    """Verdicts on settlement files as rule rows: files that were rejected, and that had repeated transactions."""
    rejected = _as_rules(verdicts, {"file_accepted": F.size("reasons") > 0}, FAIL)
    return rejected.unionByName(_as_rules(verdicts, {"transactions_once": F.col("duplicates") > 0}, WARN))


def _as_rules(rows: DataFrame, failed: dict[str, Column], action: str) -> DataFrame:
    listed = [
        F.struct(F.lit(name).alias("rule"), F.lit(action).alias("action"), F.count_if(bad).alias("violations"), F.count("*").alias("rows"))
        for name, bad in failed.items()
    ]
    return rows.agg(F.array(*listed).alias("_all")).select(F.explode("_all").alias("r")).select("r.*")


def append_audit(results: DataFrame, path: str, run_label: str, subject: str) -> None:
    """Append one row per rule to the audit table."""
    (
        results.select(
            F.lit(run_label).alias("run_label"),
            F.lit(subject).alias("subject"),
            "rule",
            "action",
            "violations",
            "rows",
            F.current_timestamp().alias("checked_at"),
        )
        .write.mode("append")
        .parquet(path)
    )
