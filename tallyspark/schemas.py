"""Column contracts of the raw extracts and the fixed value domains."""

from __future__ import annotations

# Result categories, in report order.
MATCHED = "MATCHED"
MISMATCHED = "MISMATCHED"
UNRECONCILED_PROCESSOR = "UNRECONCILED_PROCESSOR"
UNRECONCILED_INTERNAL = "UNRECONCILED_INTERNAL"
CATEGORIES = (MATCHED, MISMATCHED, UNRECONCILED_PROCESSOR, UNRECONCILED_INTERNAL)
RISK_CATEGORIES = CATEGORIES[1:]

# Run states, settlement states, change operations.
COMPLETED = "COMPLETED"
NO_RUN = "NO_RUN"
SETTLEMENT_STATUSES = ("SETTLED", "REVERSED")
DELETE = "D"

# Names of the settlement file columns.
SETTLEMENT_COLUMNS = (
    "transaction_id",
    "merchant_id",
    "amount",
    "currency",
    "settled_at",
    "processor_reference",
    "status",
)

RUNS_RAW = (
    "id long, reference_date string, file_name string, status string, "
    "total_transactions long, started_at string, completed_at string, created_at string, "
    "Op string, _timestamp string"
)

RESULTS_RAW = (
    "id long, run_id long, transaction_id string, merchant_id string, category string, "
    "internal_amount double, processor_amount double, difference double, created_at string, "
    "Op string, _timestamp string"
)

COMPANY_RAW = (
    "id long, merchant_id string, legal_name string, trade_name string, document string, "
    "primary_cnae string, created_at string, updated_at string, Op string, _timestamp string"
)

RUNS = (
    "id long, reference_date date, file_name string, status string, total_transactions int, "
    "started_at timestamp, completed_at timestamp, created_at timestamp, source string"
)

RESULTS = (
    "id long, run_id long, transaction_id string, merchant_id string, category string, "
    "internal_amount decimal(18,2), processor_amount decimal(18,2), difference decimal(18,2), "
    "created_at timestamp, source string"
)

COMPANY = (
    "id long, merchant_id string, legal_name string, trade_name string, document string, "
    "primary_cnae string, created_at timestamp, updated_at timestamp"
)

SETTLEMENTS = (
    "transaction_id string, merchant_id string, amount decimal(18,2), currency string, "
    "settled_at timestamp, processor_reference string, status string, _loaded_at timestamp, "
    "_source_file string, reference_date date"
)
