"""Parquet change-log extracts: landing and current state."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyspark.operators.cdc import (
    latest_state,
    require_timestamps,
    typed_company,
    typed_results,
    typed_runs,
    union_batches,
)
from tallyspark.schemas import COMPANY_RAW, RESULTS_RAW, RUNS_RAW
from tallyspark.sources.store import Store, delete_path, path_exists, stage

logger = logging.getLogger(__name__)

RAW_SCHEMAS = {
    "raw_reconciliation_runs": RUNS_RAW,
    "raw_reconciliation_results": RESULTS_RAW,
    "raw_enterprise_company": COMPANY_RAW,
}


def require_input(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"input not found: {path}")
    return path


def read_batches(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Batches with drifted columns as one frame.

    Each batch is read with its own schema: one read over all paths would take the schema
    of one file and lose the columns the others have in addition.
    """
    return union_batches(spark.read.parquet(require_input(spark, p)) for p in paths)


def load_transactions(
    store: Store, paths: Sequence[str], tie_breakers: Sequence[str] = ("id",)
) -> dict[str, int]:
    """Current transactions into ``raw_transactions``; returns raw, final and removed rows.

    The counts are observed by the writing job, not scanned for.
    """
    log = read_batches(store.spark, paths)
    require_timestamps(log)
    raw, final = Observation("raw"), Observation("final")
    counted = log.observe(raw, F.count("*").alias("n"))
    current = latest_state(counted, "transaction_id", tie_breakers=tie_breakers)
    store.replace("raw_transactions", current.observe(final, F.count("*").alias("n")))
    counts = {"raw": raw.get["n"], "final": final.get["n"]}
    counts["removed"] = counts["raw"] - counts["final"]
    logger.info("raw_transactions: %(raw)d read, %(final)d kept, %(removed)d removed", counts)
    return counts


def land(store: Store, name: str, path: str) -> int:
    """Copy an extract as it is; the row count comes from the writing job."""
    landed = Observation(name)
    log = store.spark.read.schema(RAW_SCHEMAS[name]).parquet(require_input(store.spark, path))
    store.replace(name, log.observe(landed, F.count("*").alias("n")))
    return landed.get["n"]


def _seed(store: Store, raw: str, silver: str, typed: DataFrame) -> int:
    """Publish a silver table once its staged rows have passed; a bad log leaves the old table.

    Uniqueness of id comes with the ranking; what is left of a primary key is NOT NULL.
    """
    seen = Observation(silver)
    missing = F.count_if(F.col("id").isNull())
    staged, folder = stage(typed.observe(seen, F.count("*").alias("n"), missing.alias("missing")), f"seed-{silver}")
    try:
        if seen.get["missing"]:
            raise ValueError(f"{silver}: id is NULL in {seen.get['missing']} row(s)")
        store.take(silver, staged, folder)
    finally:
        delete_path(store.spark, folder)
    logger.info("%s: %d rows from %s", silver, seen.get["n"], raw)
    return seen.get["n"]


def seed_reconciliation(
    store: Store, run_ties: Sequence[str] = (), result_ties: Sequence[str] = ()
) -> dict[str, int]:
    """Silver runs and results; the ties name columns that decide changes of equal time."""
    store.require("raw_reconciliation_runs", "raw_reconciliation_results")
    return {
        "runs_loaded": _seed(
            store, "raw_reconciliation_runs", "silver_reconciliation_runs",
            typed_runs(store.read("raw_reconciliation_runs"), run_ties),
        ),
        "results_loaded": _seed(
            store, "raw_reconciliation_results", "silver_reconciliation_results",
            typed_results(store.read("raw_reconciliation_results"), result_ties),
        ),
    }


def seed_company(store: Store) -> int:
    store.require("raw_enterprise_company")
    return _seed(
        store, "raw_enterprise_company", "silver_enterprise_company",
        typed_company(store.read("raw_enterprise_company")),
    )

