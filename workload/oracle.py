"""SQL counterparts of the registered queries, for an independent engine."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


CATEGORY = """CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'UNRECONCILED_PROCESSOR'
    WHEN 'RO' THEN 'UNRECONCILED_INTERNAL' WHEN 'AF' THEN 'MISMATCHED' ELSE 'MATCHED' END"""

RUNS = """runs AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS reference_date,
    'settlement_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS file_name,
    CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'IN_PROGRESS' ELSE 'FAILED' END AS status,
    CAST(o_custkey AS INTEGER) AS total_transactions,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS started_at,
    CASE WHEN o_orderstatus = 'F'
      THEN o_orderdate + to_seconds((o_orderkey * 7919) % 86400 + 600) END AS completed_at,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_at,
    'historical_backfill' AS source
  FROM orders)"""

RESULTS = f"""priced AS (
  SELECT *, {CATEGORY} AS category, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem),
sided AS (
  SELECT *, CASE WHEN category <> 'UNRECONCILED_PROCESSOR' THEN price END AS ours,
    CASE category WHEN 'UNRECONCILED_INTERNAL' THEN NULL
      WHEN 'MISMATCHED' THEN price + l_linenumber ELSE price END AS theirs FROM priced),
results AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey AS run_id,
    concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS transaction_id,
    CAST(l_suppkey AS VARCHAR) AS merchant_id, category,
    CAST(ours AS DECIMAL(18,2)) AS internal_amount,
    CAST(theirs AS DECIMAL(18,2)) AS processor_amount,
    CAST(abs(ours - theirs) AS DECIMAL(18,2)) AS difference,
    l_shipdate AS created_at, 'historical_backfill' AS source
  FROM sided)"""

COMPANY = """company AS (
  SELECT s_suppkey + copy * 1000000000 AS id, CAST(s_suppkey AS VARCHAR) AS merchant_id,
    s_name || CASE copy WHEN 1 THEN ' II' ELSE '' END AS legal_name,
    CASE WHEN s_nationkey % 5 = 0 THEN '' WHEN s_nationkey % 3 <> 0 THEN concat('Loja ', s_suppkey) END
      AS trade_name,
    lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS document,
    CAST(s_nationkey AS VARCHAR) AS primary_cnae
  FROM supplier JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR s_suppkey % 25 = 0
  WHERE s_acctbal > 0)"""

WINNING = """attempts AS (
  SELECT id, reference_date,
    rank() OVER (PARTITION BY reference_date ORDER BY started_at DESC, id DESC) AS place
  FROM runs WHERE status = 'COMPLETED'),
winning AS (SELECT reference_date, id AS run_id FROM attempts WHERE place = 1)"""

LATEST = """newest AS (
  SELECT *, rank() OVER (PARTITION BY reference_date ORDER BY started_at DESC, id DESC) AS place
  FROM runs),
latest AS (SELECT * EXCLUDE (place) FROM newest WHERE place = 1)"""

CURRENT = """curr AS (
  SELECT r.id, r.run_id, w.reference_date, r.transaction_id, r.merchant_id, r.category,
    r.internal_amount, r.processor_amount, r.difference, r.created_at, r.source,
    c.legal_name, c.trade_name, c.document, c.primary_cnae
  FROM winning w JOIN results r USING (run_id) LEFT JOIN company c ON c.merchant_id = r.merchant_id)"""

DAILY = """cells AS (
  SELECT reference_date, category, count(*) AS n, sum(internal_amount) AS i,
    sum(processor_amount) AS p, sum(difference) AS d
  FROM curr GROUP BY ALL),
totals AS (SELECT reference_date, sum(n) AS total FROM cells GROUP BY ALL),
daily AS (
  SELECT l.reference_date, l.id AS run_id, l.status AS run_status, category,
    CAST(coalesce(n, 0) AS BIGINT) AS txn_count,
    round(CAST(n AS DOUBLE) / CAST(total AS DOUBLE), 6) AS pct_of_total,
    CAST(i AS DECIMAL(28,2)) AS internal_amount_sum,
    CAST(p AS DECIMAL(28,2)) AS processor_amount_sum,
    CAST(d AS DECIMAL(28,2)) AS abs_difference_sum
  FROM latest l LEFT JOIN cells USING (reference_date) LEFT JOIN totals USING (reference_date))"""

TREND = """trended AS (
  SELECT *, avg(pct_of_total) OVER (PARTITION BY category ORDER BY reference_date
    ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS pct_of_total_7d_avg FROM daily)"""

HISTORY = """per_cell AS (SELECT run_id, category, count(*) AS n FROM results GROUP BY ALL),
per_run AS (SELECT run_id, count(*) AS total FROM results GROUP BY ALL),
history AS (
  SELECT id AS run_id, reference_date, file_name, status AS run_status, total_transactions,
    started_at, completed_at, category, coalesce(n, 0) AS txn_count,
    round(CAST(n AS DOUBLE) / total, 6) AS pct_of_total
  FROM runs LEFT JOIN per_cell ON per_cell.run_id = runs.id
    LEFT JOIN per_run ON per_run.run_id = runs.id)"""

WEEKLY = """weekly AS (
  SELECT CAST(date_trunc('week', reference_date) AS DATE) AS week_start,
    CAST(date_trunc('week', reference_date) AS DATE) + 6 AS week_end,
    category, count(*) AS txn_count,
    CAST(sum(coalesce(processor_amount, internal_amount)) AS DECIMAL(28,2)) AS amount_brl
  FROM curr GROUP BY ALL)"""

RANKING = """ranking AS (
  SELECT CAST(date_trunc('week', reference_date) AS DATE) AS week_start, merchant_id, category,
    count(*) AS txn_count,
    CAST(sum(coalesce(processor_amount, internal_amount)) AS DECIMAL(38,2)) AS amount_brl,
    legal_name, trade_name
  FROM curr WHERE category <> 'MATCHED' GROUP BY ALL)"""

LEDGER = """ledger AS (
  SELECT r.id AS result_id, r.run_id, reference_date, file_name, started_at, completed_at,
    status AS run_status, transaction_id, r.merchant_id, legal_name, document, category,
    internal_amount, processor_amount, difference, r.created_at
  FROM results r JOIN runs ON runs.id = r.run_id
    LEFT JOIN company ON company.merchant_id = r.merchant_id)"""

TO_CURRENT = (RUNS, RESULTS, COMPANY, WINNING, CURRENT)
TO_DAILY = (*TO_CURRENT, LATEST, DAILY)
TO_TREND = (*TO_DAILY, TREND)
TO_HISTORY = (RUNS, RESULTS, HISTORY)
TO_WEEKLY = (*TO_CURRENT, WEEKLY)
TO_RANKING = (*TO_CURRENT, RANKING)
TO_LEDGER = (RUNS, RESULTS, COMPANY, LEDGER)

# --- change logs ---------------------------------------------------------------------------

EVENT_LOG = """log AS (
  SELECT event_id AS id, concat('U', user_id) AS transaction_id, value AS amount,
    CASE WHEN event_type = 'view' AND event_id % 97 = 0 THEN NULL WHEN event_type = 'error' THEN 'D'
      WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS "Op",
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS _timestamp,
    CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN props ->> '$.k' END AS payment_method
  FROM events)"""

ORACLE["cdc_transactions"] = _with(EVENT_LOG) + """
SELECT id, transaction_id, amount, "Op", _timestamp, payment_method FROM log
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY _timestamp DESC, id DESC) = 1 AND "Op" <> 'D'"""

ORACLE["transactions_loaded"] = ORACLE["cdc_transactions"]

ORACLE["cdc_load_accounting"] = _with(EVENT_LOG, """kept AS (
  SELECT * FROM log
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY _timestamp DESC, id DESC) = 1 AND "Op" <> 'D')""") + """
SELECT (SELECT count(*) FROM log) AS raw, (SELECT count(*) FROM kept) AS final,
  (SELECT count(*) FROM log) - (SELECT count(*) FROM kept) AS removed"""

ORACLE["cdc_null_timestamps"] = _with(EVENT_LOG) + """
SELECT concat('_timestamp is NULL in ', count(*), ' row(s); the latest change is undecidable') AS said, false AS published
FROM log WHERE id % 9 = 4"""

ORACLE["extracts_landed"] = _with(RUNS, COMPANY) + """
SELECT 'raw_reconciliation_runs' AS artifact, n AS landed, n AS rows, 0 AS no_id FROM (
  SELECT count(*) + count(*) FILTER (status <> 'IN_PROGRESS') + count(*) FILTER (id % 50 = 0) AS n FROM runs)
UNION ALL SELECT 'raw_reconciliation_results', count(*), count(*), 0 FROM lineitem
UNION ALL SELECT 'raw_enterprise_company', count(*), count(*), 0 FROM company"""

ORACLE["silver_runs"] = _with(RUNS) + f"""
SELECT id, reference_date, file_name,
  CASE WHEN status = 'IN_PROGRESS' THEN 'IN_PROGRESS' ELSE status END AS status, total_transactions,
  {_text('started_at')}, {_text('completed_at')}, {_text('created_at')}, source
FROM runs WHERE id % 50 <> 0"""

RESULT_LOG = f"""kept AS (
  SELECT *, l_orderkey * 8 + l_linenumber AS id,
    concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS transaction_id,
    CAST(l_suppkey AS VARCHAR) AS merchant_id, {CATEGORY} AS category
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber ORDER BY l_shipdate DESC,
    concat(l_orderkey, '-', l_linenumber, '-', l_partkey) DESC, CAST(l_suppkey AS VARCHAR) DESC,
    l_extendedprice DESC) = 1)"""

ORACLE["silver_results"] = _with(RESULT_LOG) + """
SELECT id, l_orderkey AS run_id, transaction_id, merchant_id, category,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS internal_amount,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS processor_amount,
  CAST(0 AS DECIMAL(18,2)) AS difference,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at, 'historical_backfill' AS source
FROM kept WHERE l_quantity <= 48"""

COMPANY_TIMES = """merchants AS (
  SELECT *, TIMESTAMP '2024-01-01' + to_seconds(c_custkey % 1000 * 3600) AS first_at FROM customer)"""

ORACLE["silver_company"] = _with(COMPANY_TIMES) + """
SELECT c_custkey AS id, concat('M', c_custkey) AS merchant_id, c_name AS legal_name,
  concat(CASE WHEN c_custkey % 3 = 0 THEN 'Nova ' ELSE 'Loja ' END, c_custkey) AS trade_name,
  lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS document, CAST(c_nationkey AS VARCHAR) AS primary_cnae,
  '2024-01-01 00:00:00' AS created_at,
  strftime(first_at + CASE WHEN c_custkey % 3 = 0 THEN INTERVAL 40 DAYS ELSE INTERVAL 0 DAYS END,
    '%Y-%m-%d %H:%M:%S') AS updated_at
FROM merchants WHERE c_custkey % 10 <> 0"""

ORACLE["company_history"] = _with(COMPANY_TIMES, """versions AS (
  SELECT c_custkey AS id, 'Loja ' AS label, first_at AS valid_from, false AS gone FROM merchants
  UNION ALL SELECT c_custkey, 'Nova ', first_at + INTERVAL 40 DAYS, false FROM merchants WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 'Nova ', first_at + INTERVAL 90 DAYS, true FROM merchants WHERE c_custkey % 10 = 0),
spans AS (SELECT *, lead(valid_from) OVER (PARTITION BY id ORDER BY valid_from) AS valid_to FROM versions)""") + f"""
SELECT id, concat('M', id) AS merchant_id, concat(label, id) AS trade_name, valid_to IS NULL AS is_current,
  {_text('valid_from')}, {_text('valid_to')} FROM spans WHERE NOT gone"""

# --- curated and marts ------------------------------------------------------------------------

ORACLE["runs_latest"] = _with(RUNS, LATEST) + f"""
SELECT id, reference_date, file_name, status, total_transactions, source,
  {_text('started_at')}, {_text('completed_at')}, {_text('created_at')} FROM latest"""

ORACLE["winning_runs"] = _with(RUNS, WINNING) + "SELECT * FROM winning"

ORACLE["results_current"] = _with(*TO_CURRENT) + f"""
SELECT * EXCLUDE (created_at), {_text('created_at')} FROM curr"""

ORACLE["ops_daily"] = _with(*TO_DAILY) + "SELECT * FROM daily"

ORACLE["ops_trend"] = _with(*TO_TREND) + """
SELECT * EXCLUDE (run_status, pct_of_total_7d_avg), round(pct_of_total_7d_avg, 9) AS pct_of_total_7d_avg
FROM trended"""

ORACLE["run_history"] = _with(*TO_HISTORY) + f"""
SELECT * EXCLUDE (started_at, completed_at), {_text('started_at')}, {_text('completed_at')} FROM history"""

ORACLE["cfo_weekly_summary"] = _with(*TO_WEEKLY) + "SELECT * FROM weekly"

ORACLE["cfo_weekly_merchant_ranking"] = _with(*TO_RANKING) + "SELECT * FROM ranking"

ORACLE["compliance_ledger"] = _with(*TO_LEDGER) + f"""
SELECT * EXCLUDE (started_at, completed_at, created_at),
  {_text('started_at')}, {_text('completed_at')}, {_text('created_at')} FROM ledger"""

KEPT_RUNS = RUNS.replace("FROM orders)", "FROM orders WHERE o_orderkey % 50 <> 0)")
KEPT_RESULTS = """results AS (
  SELECT id, l_orderkey AS run_id, transaction_id, merchant_id, category, l_shipdate AS created_at,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS internal_amount, 'historical_backfill' AS source,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS processor_amount, CAST(0 AS DECIMAL(18,2)) AS difference
  FROM kept WHERE l_quantity <= 48)"""

ORACLE["ops_daily_from_logs"] = _with(
    KEPT_RUNS,
    RESULT_LOG,
    KEPT_RESULTS,
    WINNING,
    "curr AS (SELECT * FROM results JOIN winning USING (run_id))",
    LATEST,
    DAILY,
) + "SELECT * FROM daily"

ORACLE["gold_build"] = _with(
    KEPT_RUNS, RESULT_LOG, KEPT_RESULTS, COMPANY, WINNING, CURRENT, LATEST, DAILY, HISTORY, WEEKLY, RANKING, LEDGER
) + """
SELECT 'silver_reconciliation_runs_latest' AS artifact, count(*) AS rows FROM latest
UNION ALL SELECT 'silver_reconciliation_results_current', count(*) FROM curr
UNION ALL SELECT 'gold_ops_reconciliation_daily', count(*) FROM daily
UNION ALL SELECT 'gold_ops_reconciliation_trend', count(*) FROM daily
UNION ALL SELECT 'gold_ops_run_history', count(*) FROM history
UNION ALL SELECT 'gold_cfo_weekly_summary', count(*) FROM weekly
UNION ALL SELECT 'gold_cfo_weekly_merchant_ranking', count(*) FROM ranking
UNION ALL SELECT 'gold_compliance_ledger', count(*) FROM ledger"""

# --- settlement files ----------------------------------------------------------------------------

LINES = """dated AS (
  SELECT *, year(o_orderdate) * 12 + month(o_orderdate) AS m,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS file_date FROM orders),
lines AS (
  SELECT *, seq, CAST(o_totalprice AS DECIMAL(18,2)) + seq AS cents,
    CASE WHEN m % 13 = 1 AND o_orderkey % 20 = 0 THEN '' ELSE concat('T', o_orderkey) END AS transaction_id
  FROM dated JOIN (VALUES (0), (1)) AS s(seq) ON seq = 0 OR o_orderkey % 200 = 0),
texts AS (
  SELECT *, CASE WHEN m % 13 = 0 AND o_orderkey % 20 = 0 THEN '0.00'
      WHEN m % 13 = 2 AND o_orderkey % 20 = 0 THEN 'abc'
      WHEN o_orderkey % 25 = 0 THEN 'R$ ' || replace(format('{:,}', CAST(floor(cents) AS BIGINT)), ',', '.')
        || ',' || right(CAST(cents AS VARCHAR), 2)
      WHEN o_orderkey % 7 = 0 THEN replace(CAST(cents AS VARCHAR), '.', ',')
      ELSE CAST(cents AS VARCHAR) END AS amount,
    CASE WHEN m % 13 = 0 AND o_orderkey % 20 = 0 THEN CAST(0 AS DECIMAL(18,2))
      WHEN m % 13 = 2 AND o_orderkey % 20 = 0 THEN NULL ELSE CAST(cents AS DECIMAL(18,2)) END AS parsed
  FROM lines),
bad AS (SELECT DISTINCT file_date FROM texts WHERE m % 13 IN (0, 1, 2) AND o_orderkey % 20 = 0)"""

ORACLE["settlements_loaded"] = _with(LINES) + """
SELECT transaction_id, concat('M', o_custkey) AS merchant_id, parsed AS amount, 'BRL' AS currency,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS settled_at, concat('PS-', o_orderkey) AS processor_reference,
  CASE WHEN o_orderkey % 50 = 0 THEN 'REVERSED' ELSE 'SETTLED' END AS status, file_date AS reference_date
FROM texts WHERE file_date NOT IN (FROM bad)
  AND seq = CASE WHEN o_orderkey % 200 = 0 THEN 1 ELSE 0 END"""

FILES = """ids AS (
  SELECT file_date, transaction_id, count(*) AS n, count(*) FILTER (parsed <= 0) AS low,
    count(*) FILTER (parsed IS NULL) AS unreadable
  FROM texts GROUP BY ALL),
files AS (
  SELECT file_date, sum(n) AS n, count(*) AS ids, count(*) FILTER (n > 1) AS dup, sum(low) AS low,
    sum(unreadable) AS unreadable, coalesce(sum(n) FILTER (transaction_id = ''), 0) AS blank
  FROM ids GROUP BY ALL),
judged AS (
  SELECT *, CAST(n AS BIGINT) AS rows, CASE WHEN low + unreadable + blank > 0 THEN 0 ELSE ids END AS loaded,
    concat_ws('; ',
      CASE WHEN low > 0 THEN concat('amount is zero or less (', low, ' rows)') END,
      CASE WHEN blank > 0 THEN concat('transaction_id is blank (', blank, ' rows)') END,
      CASE WHEN unreadable > 0 THEN concat('Unreadable amounts found (', unreadable, ' rows)') END) AS reasons
  FROM files)"""

ORACLE["settlements_verdicts"] = _with(LINES, FILES) + """
SELECT file_date AS reference_date, rows, loaded, dup AS duplicates, reasons,
  CASE WHEN dup > 0 THEN concat(dup, ' transaction ids occur several times, the last row counts') ELSE '' END AS warnings
FROM judged"""

ORACLE["settlements_awkward_drop"] = _with(LINES, FILES, """named AS (
  SELECT *, CASE WHEN year(file_date) < 1994 THEN 'wide' WHEN year(file_date) = 1994 THEN 'lacking'
    WHEN year(file_date) = 1995 THEN 'hidden' WHEN year(file_date) = 1996 THEN 'breaks' ELSE 'good' END AS part
  FROM judged)""") + """
SELECT part, CASE WHEN part <> 'hidden' THEN file_date END AS reference_date,
  CASE WHEN part IN ('wide', 'breaks', 'good') THEN rows ELSE 0 END AS rows,
  CASE WHEN part IN ('wide', 'breaks', 'good') THEN loaded ELSE 0 END AS loaded,
  CASE part WHEN 'lacking' THEN 'header lacks status'
    WHEN 'hidden' THEN 'file or folder name begins with an underscore or a dot, which Spark does not read'
    ELSE reasons END AS reasons
FROM named
UNION ALL SELECT 'empty', DATE '2001-01-01', 0, 0, 'no rows below the header'"""

ORACLE["settlements_by_callable"] = _with(LINES, FILES) + """
SELECT CASE WHEN ok THEN file_date END AS reference_date, CASE WHEN ok THEN rows ELSE 0 END AS rows,
  CASE WHEN ok THEN loaded ELSE 0 END AS loaded,
  CASE WHEN ok THEN reasons ELSE 'reference_date callable failed (ValueError: closed year)' END AS reasons
FROM (SELECT *, year(file_date) <> 1995 AS ok FROM judged)"""

ORACLE["settlement_file_loaded"] = _with(LINES, """kept AS (
  SELECT transaction_id, parsed AS amount FROM texts WHERE transaction_id <> '' AND parsed > 0
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY seq DESC) = 1)""") + """
SELECT transaction_id, DATE '1999-01-31' AS reference_date, amount, 'all[1].csv' AS _source_file,
  (SELECT count(*) FROM kept) AS loaded
FROM kept"""

ORACLE["settlements_loaded_at"] = _with(LINES) + """
SELECT file_date AS reference_date, count(*) AS rows, true AS fresh FROM texts
WHERE file_date NOT IN (FROM bad) AND seq = CASE WHEN o_orderkey % 200 = 0 THEN 1 ELSE 0 END GROUP BY ALL"""

ORACLE["settlements_broken_rows"] = """
WITH months AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_date, (year(o_orderdate) * 12 + month(o_orderdate)) % 7 AS kind,
    count(*) AS rows, count(*) FILTER (o_orderkey % 20 = 0) AS hits
  FROM orders GROUP BY ALL),
noted AS (
  SELECT *, concat(CASE kind WHEN 0 THEN 'merchant_id is blank' WHEN 1 THEN 'Unknown statuses found' WHEN 2 THEN 'Missing currencies found'
      WHEN 3 THEN 'Missing amounts found' WHEN 4 THEN 'Missing processor references found' WHEN 5 THEN 'Ambiguous amounts found'
      ELSE 'Currency codes not of length 3 found' END, ' (', hits, ' rows)') AS note FROM months)
SELECT reference_date, rows, CASE WHEN kind < 5 AND hits > 0 THEN 0 ELSE rows END AS loaded,
  CASE WHEN kind < 5 AND hits > 0 THEN note ELSE '' END AS reasons, CASE WHEN kind >= 5 AND hits > 0 THEN note ELSE '' END AS warnings
FROM noted"""

ORACLE["refusals"] = _with(COMPANY) + """
SELECT 'no folder' AS "case", 'NotADirectoryError: settlement folder not found: <drop>/nowhere' AS said
UNION ALL SELECT 'no file', 'FileNotFoundError: settlement file not found: <drop>/none.csv'
UNION ALL SELECT 'no file matches', 'returned {}'
UNION ALL SELECT 'no batch', 'FileNotFoundError: input not found: <drop>/batch.parquet'
UNION ALL SELECT 'no silver', 'RuntimeError: not loaded yet: silver_reconciliation_runs, silver_reconciliation_results, silver_enterprise_company'
UNION ALL SELECT 'doubled merchants', concat('ValueError: company: ', count(*), ' duplicate key(s) on (merchant_id)')
FROM (SELECT merchant_id FROM company GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique runs', 'returned None'"""

ORACLE["settlements_normalized"] = _with(LINES) + "SELECT DISTINCT amount, parsed FROM texts"

ORACLE["settlements_union_by_name"] = _with(LINES) + """
SELECT amount, CASE WHEN file_date < DATE '1998-01-01' THEN 'BRL' END AS currency,
  CASE WHEN file_date < DATE '1998-01-01' THEN concat('M', o_custkey) END AS merchant_id,
  CASE WHEN file_date >= DATE '1998-01-01' THEN concat('m', o_custkey) END AS note,
  CASE WHEN file_date >= DATE '1998-01-01'
    THEN CASE WHEN o_orderkey % 50 = 0 THEN 'REVERSED' ELSE 'SETTLED' END END AS status,
  nullif(transaction_id, '') AS transaction_id, false AS surplus
FROM texts"""

ORACLE["settlements_duplicate_ids"] = _with(LINES) + """
SELECT transaction_id, count(*) AS occurrences FROM lines GROUP BY ALL HAVING count(*) > 1"""

SETTLEMENTS = """settlements AS (
  SELECT concat('T', o_orderkey) AS transaction_id, concat('M', o_custkey) AS merchant_id,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS settled_on,
    CASE WHEN o_orderkey % 50 = 0 THEN 'REVERSED' ELSE 'SETTLED' END AS status,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS reference_date, o_orderkey
  FROM orders)"""

ORACLE["settlements_upsert"] = _with(SETTLEMENTS) + """
SELECT transaction_id, CASE WHEN o_orderkey % 40 <> 1 THEN reference_date END AS reference_date, merchant_id, status,
  CAST(amount + CASE WHEN o_orderkey % 3 = 0 AND (year(reference_date) = 1997 OR o_orderkey % 40 = 1) THEN 10 ELSE 0 END
    AS DECIMAL(18,2)) AS amount
FROM settlements
WHERE o_orderkey % 5 <> 0 OR (o_orderkey % 3 = 0 AND (year(reference_date) = 1997 OR o_orderkey % 40 = 1))"""

ORACLE["settlements_by_file"] = _with(SETTLEMENTS) + """
SELECT 'settlement_' || strftime(reference_date, '%Y-%m-%d') || '.csv' AS _source_file, count(*) AS rows
FROM settlements GROUP BY ALL"""

MIX = """mix AS (
  SELECT status, count(*) AS total_rows, CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount,
    min(settled_on) AS earliest_date, max(settled_on) AS latest_date,
    CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM settlements) * 100 AS pct
  FROM settlements GROUP BY ALL)"""

ORACLE["settlements_status_mix"] = _with(SETTLEMENTS, MIX) + "SELECT * FROM mix"

ORACLE["settlements_reversed_check"] = _with(SETTLEMENTS, MIX) + """
SELECT pct AS reversed_pct, abs(pct - 2.0) <= 1.0 AS as_expected FROM mix WHERE status = 'REVERSED'"""

ORACLE["settlements_per_day"] = _with(SETTLEMENTS) + """
SELECT settled_on AS date, count(*) AS transactions FROM settlements GROUP BY ALL"""

ORACLE["settlements_amounts"] = _with(SETTLEMENTS) + """
SELECT min(amount) AS min_amount, max(amount) AS max_amount,
  round(avg(CAST(amount AS DOUBLE)), 4) AS avg_amount, count(*) FILTER (amount <= 0) AS not_positive,
  count(*) FILTER (settled_on IS NULL) AS null_dates FROM settlements"""

# --- CFO report -------------------------------------------------------------------------------------

ORACLE["cfo_period"] = _with(*TO_WEEKLY) + """
SELECT min(week_start) AS period_start, max(week_end) AS period_end FROM weekly"""

TOTALS = """totals AS (
  SELECT category, CAST(sum(txn_count) AS BIGINT) AS txn_count,
    CAST(sum(amount_brl) AS DECIMAL(38,2)) AS amount_brl FROM weekly GROUP BY ALL)"""

ORACLE["cfo_category_totals"] = _with(*TO_WEEKLY, TOTALS) + "SELECT * FROM totals"

ORACLE["cfo_category_texts"] = _with(*TO_WEEKLY, TOTALS) + """
SELECT category, 'R$ ' || format('{:,.2f}', CAST(amount_brl AS DOUBLE)) AS amount, format('{:,}', CAST(txn_count AS BIGINT)) AS transactions
FROM totals"""

ORACLE["cfo_headline"] = _with(*TO_WEEKLY, TOTALS) + """
SELECT CAST(sum(amount_brl) AS DECIMAL(38,2)) AS total_brl, CAST(sum(txn_count) AS BIGINT) AS total_txn
FROM totals"""

ORACLE["cfo_category_shares"] = _with(*TO_WEEKLY, TOTALS) + """
SELECT category, replace(category, 'UNRECONCILED_', 'UNR_') AS label, amount_brl,
  round(CAST(amount_brl AS DOUBLE) / (SELECT CAST(sum(amount_brl) AS DOUBLE) FROM totals), 9) AS share
FROM totals"""

BY_CATEGORY = """by_category AS (
  SELECT reference_date, category, txn_count,
    CAST(coalesce(processor_amount_sum, internal_amount_sum, 0) AS DECIMAL(28,2)) AS amount_brl
  FROM daily WHERE category IS NOT NULL)"""

ORACLE["cfo_daily_by_category"] = _with(*TO_DAILY, BY_CATEGORY) + "SELECT * FROM by_category"

ORACLE["cfo_daily_table"] = _with(*TO_DAILY, BY_CATEGORY) + """
SELECT reference_date,
  CAST(coalesce(sum(amount_brl) FILTER (category = 'MATCHED'), 0) AS DECIMAL(38,2)) AS matched,
  CAST(coalesce(sum(amount_brl) FILTER (category = 'MISMATCHED'), 0) AS DECIMAL(38,2)) AS mismatched,
  CAST(coalesce(sum(amount_brl) FILTER (category = 'UNRECONCILED_PROCESSOR'), 0) AS DECIMAL(38,2))
    AS unreconciled_processor,
  CAST(coalesce(sum(amount_brl) FILTER (category = 'UNRECONCILED_INTERNAL'), 0) AS DECIMAL(38,2))
    AS unreconciled_internal,
  CAST(sum(amount_brl) AS DECIMAL(38,2)) AS total, CAST(sum(txn_count) AS BIGINT) AS txns
FROM by_category GROUP BY ALL"""

ORACLE["cfo_top_merchants"] = _with(*TO_RANKING, """sums AS (
  SELECT merchant_id, max(legal_name) AS legal, max(trade_name) AS trade,
    CAST(sum(txn_count) AS BIGINT) AS txn_count, CAST(sum(amount_brl) AS DECIMAL(38,2)) AS amount_brl
  FROM ranking GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (ORDER BY amount_brl DESC NULLS LAST, merchant_id ASC NULLS LAST) AS place FROM sums)""") + """
SELECT CAST(place AS INTEGER) AS rank, merchant_id,
  coalesce(nullif(trade, ''), nullif(legal, ''), nullif(merchant_id, ''), '(unknown merchant)') AS merchant,
  txn_count, amount_brl FROM placed WHERE place <= 10"""

ORACLE["cfo_weekly_rollup"] = _with(*TO_WEEKLY) + """
SELECT week_start, week_end, count(*) AS categories, CAST(sum(txn_count) AS BIGINT) AS total_txns
FROM weekly GROUP BY ALL"""

ORACLE["cfo_distinct_weeks"] = _with(*TO_WEEKLY) + "SELECT DISTINCT week_start FROM weekly"

# --- run report -----------------------------------------------------------------------------------------

NESTED = """nested AS (
  SELECT run_id, reference_date, file_name, run_status, total_transactions,
    strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
    strftime(completed_at, '%Y-%m-%d %H:%M:%S') AS completed_at,
    coalesce(string_agg(category || ': ' || format('{:,}', txn_count) || ' ('
      || printf('%.1f%%', coalesce(pct_of_total, 0) * 100) || ')', '; ' ORDER BY category), 'no results') AS breakdown
  FROM history GROUP BY ALL)"""

ORACLE["run_report_runs"] = _with(*TO_HISTORY, NESTED) + """
SELECT * FROM nested WHERE year(reference_date) = 1996"""

ORACLE["run_report_calendar"] = _with(*TO_HISTORY, NESTED, """days AS (
  SELECT CAST(d AS DATE) AS reference_date FROM (SELECT unnest(generate_series(
    max(reference_date) - INTERVAL 7 DAYS, CAST(max(reference_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM history))""") + """
SELECT reference_date, nested.* EXCLUDE (reference_date) FROM days LEFT JOIN nested USING (reference_date)"""

ORACLE["run_report_ordered"] = _with(*TO_HISTORY) + """
SELECT reference_date, run_id, category, txn_count, pct_of_total FROM history
ORDER BY reference_date DESC, started_at DESC, run_id, category"""

ORACLE["ops_daily_positions"] = _with(*TO_DAILY) + """
SELECT reference_date, category, txn_count, row_number() OVER (ORDER BY reference_date, category NULLS LAST) AS position FROM daily"""

ORACLE["ops_trend_positions"] = _with(*TO_DAILY) + """
SELECT reference_date, category, run_id, row_number() OVER (ORDER BY reference_date, category NULLS LAST) AS position FROM daily"""

ORACLE["run_history_positions"] = _with(*TO_HISTORY) + """
SELECT run_id, category, txn_count,
  row_number() OVER (ORDER BY reference_date DESC, started_at DESC, run_id, category NULLS LAST) AS position FROM history"""

ORACLE["cfo_weekly_positions"] = _with(*TO_WEEKLY) + """
SELECT week_start, category, amount_brl, row_number() OVER (ORDER BY week_start, category NULLS LAST) AS position FROM weekly"""

ORACLE["cfo_ranking_positions"] = _with(*TO_RANKING) + """
SELECT week_start, merchant_id, category, legal_name, amount_brl, row_number() OVER (ORDER BY week_start, amount_brl DESC NULLS LAST,
  merchant_id NULLS LAST, category NULLS LAST, legal_name NULLS LAST, trade_name NULLS LAST) AS position FROM ranking"""

ORACLE["ledger_positions"] = _with(*TO_LEDGER) + """
SELECT result_id, legal_name, row_number() OVER (ORDER BY reference_date, run_id, result_id, legal_name NULLS LAST,
  document NULLS LAST) AS position FROM ledger"""

ORACLE["run_results_listed"] = _with(RESULTS) + """
SELECT run_id, results, md5(results) AS digest FROM (
  SELECT run_id, string_agg(part, ';' ORDER BY id, part) AS results FROM (
    SELECT run_id, id, concat_ws(':', id, category, coalesce(CAST(internal_amount AS VARCHAR), '-')) AS part FROM results)
  GROUP BY run_id)"""

ORACLE["no_data"] = """
SELECT product, count(o_orderkey) AS rows
FROM (VALUES ('ops_alert'), ('alert_payload'), ('cfo_period'), ('run_report'), ('run_calendar')) AS p(product)
  LEFT JOIN orders ON o_orderdate < DATE '1900-01-01' GROUP BY ALL"""

ORACLE["run_distinct_ids"] = _with(*TO_DAILY) + "SELECT DISTINCT reference_date, run_id FROM daily"

# --- alerts ------------------------------------------------------------------------------------------------

RATED = """rated AS (
  SELECT *, coalesce(pct_of_total, 0.0) AS rate, pct_of_total_7d_avg AS a,
    CASE WHEN category = 'MISMATCHED' THEN 0.05::DOUBLE
      WHEN category LIKE 'UNRECONCILED_%' THEN 0.10::DOUBLE END AS threshold
  FROM trended),
spiked AS (
  SELECT *, coalesce(rate > threshold AND (a IS NULL OR rate > a * 1.5::DOUBLE), false) AS spike,
    category || ' rate ' || printf('%.1f%%', rate * 100) || ' exceeds threshold '
      || printf('%.1f%%', threshold * 100)
      || CASE WHEN a <> 0 THEN ' and is ' || printf('%.1f', rate / a) || '× the 7-day avg ('
        || printf('%.1f%%', a * 100) || ')' ELSE '' END AS message,
    '  ' || CASE category WHEN 'MATCHED' THEN ':white_check_mark:' WHEN 'MISMATCHED' THEN ':warning:'
      ELSE ':x:' END || ' *' || category || '*: ' || printf('%.1f%%', rate * 100) || ' ('
      || format('{:,}', txn_count) || ' txns)' AS line
  FROM rated)"""


def _evaluated(source: str) -> str:
    return f"""grouped AS (
  SELECT reference_date, coalesce(max(run_status), 'NO_RUN') AS run_status,
    CAST(coalesce(sum(txn_count) FILTER (category IS NOT NULL), 0) AS BIGINT) AS total,
    coalesce(max(rate) FILTER (category = 'MATCHED'), 0.0) AS match_rate,
    string_agg(message, chr(10) ORDER BY category) FILTER (spike) AS spikes,
    coalesce(string_agg(line, chr(10) ORDER BY category) FILTER (category IS NOT NULL), '') AS breakdown
  FROM {source} GROUP BY ALL),
evaluated AS (
  SELECT reference_date, run_status, total, match_rate, breakdown,
    CASE WHEN run_status <> 'COMPLETED' OR spikes IS NOT NULL THEN 'CRITICAL' ELSE 'OK' END AS alert_level,
    concat_ws(chr(10), CASE WHEN run_status <> 'COMPLETED' THEN 'Run for ' || strftime(reference_date, '%Y-%m-%d')
      || ' ended with status ''' || run_status || ''' — reconciliation may be incomplete or absent.' END,
      spikes) AS messages
  FROM grouped)"""


ORACLE["ops_alerts"] = _with(*TO_TREND, RATED, _evaluated("spiked")) + "SELECT * FROM evaluated"

ORACLE["ops_alert_spikes"] = _with(*TO_TREND, RATED) + """
SELECT reference_date, 'RATE_SPIKE' AS type, category, rate, threshold, round(a, 9) AS avg_7d
FROM spiked WHERE spike"""

ORACLE["ops_alert_latest"] = _with(
    *TO_TREND, RATED, "asked AS (SELECT * FROM spiked WHERE reference_date = (SELECT max(reference_date) FROM runs))",
    _evaluated("asked"),
) + "SELECT * FROM evaluated"

ORACLE["ops_alert_requested"] = _with(
    *TO_TREND, RATED,
    """days AS (SELECT DISTINCT unnest([reference_date, reference_date + 180]) AS reference_date
  FROM runs WHERE year(reference_date) = 2001),
asked AS (SELECT * FROM days LEFT JOIN spiked USING (reference_date))""",
    _evaluated("asked"),
) + "SELECT * FROM evaluated"

PAYLOAD = r"""payloads AS (
  SELECT reference_date, alert_level, total,
    CASE alert_level WHEN 'OK' THEN ':large_green_circle:' ELSE ':red_circle:' END
      || ' Reconciliation ' || alert_level || ' — ' || strftime(reference_date, '%Y-%m-%d') AS title,
    '{"type":"mrkdwn","text":"' AS md, '{"type":"divider"}' AS divider,
    run_status, match_rate, strftime(reference_date, '%Y-%m-%d') AS day,
    replace(breakdown, chr(10), '\n') AS lines,
    replace('  :warning: ' || replace(messages, chr(10), chr(10) || '  :warning: '), chr(10), '\n') AS warned
  FROM evaluated)"""

ORACLE["ops_alert_payload"] = _with(*TO_TREND, RATED, _evaluated("spiked"), PAYLOAD) + r"""
SELECT reference_date, alert_level,
  '{"blocks":[{"type":"header","text":{"type":"plain_text","text":"' || title || '"}},'
  || '{"type":"section","fields":[' || md || '*Status*\n' || alert_level || '"},'
  || md || '*Run Status*\n' || run_status || '"},'
  || md || '*Total Transactions*\n' || format('{:,}', total) || '"},'
  || md || '*Match Rate*\n' || printf('%.1f%%', match_rate * 100) || '"}]},' || divider || ','
  || CASE alert_level WHEN 'OK' THEN '' ELSE '{"type":"section","text":' || md || '*Active Alerts*\n' || warned
    || '"}},' || divider || ',' END
  || '{"type":"section","text":' || md || '*Category Breakdown*\n' || lines || '"}},'
  || '{"type":"context","elements":[' || md || '_Reference date: ' || day || ' · not delivered, payload only_"}]}]}'
  AS payload
FROM payloads"""

ORACLE["ops_alert_files"] = _with(*TO_TREND, RATED, _evaluated("spiked"), PAYLOAD) + """
SELECT reference_date, title, '*Total Transactions*' || chr(10) || format('{:,}', total) AS total FROM payloads"""

# --- profile --------------------------------------------------------------------------------------------------


def _profile(table: str, source: str, date: str, key: str, columns: list[str]) -> str:
    nulls = "\n".join(
        f"""UNION ALL SELECT 'null_count', '{c}', CAST(count(*) - count("{c}") AS VARCHAR),
  round(CAST(count(*) - count("{c}") AS DOUBLE) / count(*) * 100, 1) FROM {source} HAVING count(*) > count("{c}")"""
        for c in columns
    )
    return f"""SELECT '{table}' AS "table", metric, "column", value, pct FROM (
SELECT 'row_count' AS metric, CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS VARCHAR) AS value,
  CAST(NULL AS DOUBLE) AS pct FROM {source}
UNION ALL SELECT 'column_count', NULL, '{len(columns)}', NULL
UNION ALL SELECT 'date_min', '{date}', strftime(min(TRY_CAST({date} AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S'), NULL FROM {source}
UNION ALL SELECT 'date_max', '{date}', strftime(max(TRY_CAST({date} AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S'), NULL FROM {source}
UNION ALL SELECT 'duplicate_pk_count', '{key}', CAST(count(*) AS VARCHAR), NULL
  FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1)
{nulls})"""


ORACLE["profile_results"] = _with(RESULTS) + _profile(
    "results", "results", "created_at", "id",
    ["id", "run_id", "transaction_id", "merchant_id", "category", "internal_amount", "processor_amount",
     "difference", "created_at", "source"],
)
ORACLE["profile_runs"] = _with(RUNS) + _profile(
    "runs", "runs", "reference_date", "reference_date,status",
    ["id", "reference_date", "file_name", "status", "total_transactions", "started_at", "completed_at",
     "created_at", "source"],
)
ORACLE["profile_text_dates"] = _with(EVENT_LOG) + _profile(
    "transactions", "log", "_timestamp", "transaction_id",
    ["id", "transaction_id", "amount", "Op", "_timestamp", "payment_method"],
)

ORACLE["merchant_duplicates"] = _with(COMPANY) + """
SELECT merchant_id, count(*) AS occurrences FROM company GROUP BY ALL HAVING count(*) > 1"""

ORACLE["result_duplicates"] = _with(RESULTS) + """
SELECT run_id, merchant_id, count(*) AS occurrences FROM results GROUP BY ALL HAVING count(*) > 1"""

ORACLE["fingerprint_results"] = _with(RESULTS, """hashed AS (
  SELECT CAST('0x' || substr(md5(transaction_id), 1, 15) AS BIGINT) AS h FROM results)""") + """
SELECT count(*) AS rows, CAST(sum(h) AS DECIMAL(38,0)) AS hash_sum, bit_xor(h) AS hash_xor FROM hashed"""

ORACLE["fingerprint_ordered"] = _with(RESULTS, """placed AS (
  SELECT row_number() OVER (ORDER BY run_id, id, processor_amount NULLS FIRST) || coalesce('=' || processor_amount, '') AS placed FROM results),
hashed AS (SELECT CAST('0x' || substr(md5(placed), 1, 15) AS BIGINT) AS h FROM placed)""") + """
SELECT count(*) AS rows, CAST(sum(h) AS DECIMAL(38,0)) AS hash_sum, bit_xor(h) AS hash_xor FROM hashed"""

ORACLE["runs_joined_by_date"] = _with(RUNS) + """
SELECT reference_date, count(*) AS n,
  string_agg(CASE WHEN status <> 'IN_PROGRESS' THEN status || ' ' || id END, '; ' ORDER BY started_at, id) AS attempts
FROM runs GROUP BY reference_date"""

# --- reconciliation --------------------------------------------------------------------------------------------

SIDES = """i AS (
  SELECT concat('T', o_orderkey) AS tid, concat('M', o_custkey) AS mid,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS created
  FROM orders WHERE o_orderkey % 20 <> 19),
p AS (
  SELECT concat('T', o_orderkey) AS tid, concat('M', o_custkey) AS mid,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE o_orderkey % 20 WHEN 1 THEN 0.01 WHEN 2 THEN 0.02
      WHEN 3 THEN -5.00 ELSE 0.00 END AS DECIMAL(18,2)) AS amount,
    CAST(o_orderdate AS DATE) + CAST(CASE o_orderkey % 20 WHEN 4 THEN 8 WHEN 5 THEN 7 WHEN 6 THEN -1
      ELSE o_orderkey % 3 END AS INTEGER) AS ref
  FROM orders WHERE o_orderkey % 20 NOT IN (0, 7))"""

CLASSIFIED = """classified AS (
  SELECT coalesce(i.tid, p.tid) AS transaction_id, coalesce(p.ref, i.created) AS reference_date,
    coalesce(i.mid, p.mid) AS merchant_id,
    CASE WHEN i.tid IS NULL THEN 'UNRECONCILED_PROCESSOR' WHEN p.tid IS NULL THEN 'UNRECONCILED_INTERNAL'
      WHEN abs(i.amount - p.amount) <= 0.01 THEN 'MATCHED' ELSE 'MISMATCHED' END AS category,
    i.amount AS internal_amount, p.amount AS processor_amount,
    CAST(abs(i.amount - p.amount) AS DECIMAL(18,2)) AS difference
  FROM i FULL JOIN p ON i.tid = p.tid AND i.created BETWEEN p.ref - 7 AND p.ref)"""

ORACLE["reconcile_transactions"] = _with(SIDES, CLASSIFIED) + "SELECT * FROM classified"

ORACLE["reconcile_runs"] = _with(SIDES, """dates AS (SELECT DISTINCT ref FROM p),
reach AS (SELECT i.*, ref AS run FROM i JOIN dates ON ref BETWEEN created AND created + 7),
per_run AS (
  SELECT coalesce(p.ref, r.run) AS reference_date,
    CASE WHEN r.tid IS NULL THEN 'UNRECONCILED_PROCESSOR' WHEN p.tid IS NULL THEN 'UNRECONCILED_INTERNAL'
      WHEN abs(r.amount - p.amount) <= 0.01 THEN 'MATCHED' ELSE 'MISMATCHED' END AS category,
    r.amount AS ours, abs(r.amount - p.amount) AS diff
  FROM reach r FULL JOIN p ON r.tid = p.tid AND r.run = p.ref)""") + """
SELECT reference_date, category, count(*) AS n, CAST(sum(ours) AS DECIMAL(28,2)) AS internal_sum,
  CAST(sum(diff) AS DECIMAL(28,2)) AS difference_sum FROM per_run GROUP BY ALL"""

ORACLE["reconcile_audit"] = _with(SIDES, CLASSIFIED, """stored AS (
  SELECT concat('T', o_orderkey) AS transaction_id,
    CASE o_orderkey % 20 WHEN 19 THEN 'UNRECONCILED_PROCESSOR' WHEN 0 THEN 'UNRECONCILED_INTERNAL'
      WHEN 7 THEN 'UNRECONCILED_INTERNAL' WHEN 2 THEN 'MISMATCHED' WHEN 3 THEN 'MISMATCHED' ELSE 'MATCHED' END AS category
  FROM orders),
again AS (SELECT * FROM classified)""") + """
SELECT s.category AS stored, a.category AS recomputed, count(*) AS transactions
FROM stored s FULL JOIN again a USING (transaction_id) GROUP BY ALL"""

ORACLE["unknown_to_internal"] = _with(SIDES) + """
SELECT tid AS transaction_id, mid AS merchant_id, amount, ref AS reference_date FROM p
WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.tid = p.tid)"""

ORACLE["known_to_processor"] = _with(SIDES) + """
SELECT tid AS transaction_id, mid AS merchant_id, amount FROM i WHERE tid IN (SELECT tid FROM p)"""

ORACLE["both_sides_union"] = _with(SIDES) + """
SELECT side, merchant_id, count(*) AS n FROM (
  SELECT 'internal' AS side, mid AS merchant_id FROM i UNION ALL SELECT 'processor', mid FROM p) GROUP BY ALL"""

ORACLE["newest_transactions"] = _with(EVENT_LOG) + """
SELECT * FROM log ORDER BY _timestamp DESC, id DESC LIMIT 10"""

ORACLE["drift_fill_rate"] = _with(EVENT_LOG) + """
SELECT CASE WHEN _timestamp < '2024-01-20' THEN 'batch_1_origin' ELSE 'batch_2_origin' END AS origin,
  count(*) AS total, count(payment_method) AS filled,
  CAST(count(payment_method) AS DOUBLE) / count(*) AS fill_rate FROM log GROUP BY ALL"""

ORACLE["category_mix"] = _with(RESULTS, """mix AS (
  SELECT category, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM results) AS share
  FROM results GROUP BY ALL)""") + """
SELECT category, n, share, CASE category WHEN 'MATCHED' THEN share BETWEEN 0.78 AND 0.92
  ELSE share BETWEEN 0.01 AND 0.10 END AS in_band FROM mix"""

ORACLE["run_operations"] = """
SELECT 'I' AS "Op", count(*) AS n FROM orders
UNION ALL SELECT 'U', count(*) FROM orders WHERE o_orderstatus IN ('F', 'P')
UNION ALL SELECT 'D', count(*) FROM orders WHERE o_orderkey % 50 = 0"""

# --- quality ----------------------------------------------------------------------------------------------------

ORACLE["quality_violations"] = _with(RESULTS) + """
SELECT 'valid_transaction_id' AS rule, 'fail' AS action, 'transaction_id is NULL' AS message,
  count(*) FILTER (transaction_id IS NULL) AS violations, count(*) AS rows FROM results
UNION ALL SELECT 'amount_above_1000', 'drop', 'amount too low', count(*) FILTER (internal_amount <= 1000), count(*) FROM results
UNION ALL SELECT 'valid_category', 'warn', 'unknown category', count(*) FILTER (category IS NULL), count(*) FROM results
UNION ALL SELECT 'small_difference', 'warn', 'large difference', count(*) FILTER (difference > 5), count(*) FROM results"""

ORACLE["quality_enforced"] = _with(RESULTS) + """
SELECT category, count(*) AS n, CAST(sum(internal_amount) AS DECIMAL(28,2)) AS amount
FROM results WHERE internal_amount IS NULL OR internal_amount > 1000 GROUP BY ALL"""

ORACLE["quality_daily"] = _with(*TO_DAILY, """days AS (
  SELECT reference_date, CAST(sum(txn_count) AS BIGINT) AS volume,
    coalesce(max(pct_of_total) FILTER (category = 'MATCHED'), 0.0) AS match_rate FROM daily GROUP BY ALL),
framed AS (
  SELECT *, avg(volume) OVER w AS m, stddev_samp(volume) OVER w AS s FROM days
  WINDOW w AS (ORDER BY reference_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""") + """
SELECT reference_date, volume, match_rate, round(m, 6) AS volume_mean, round(s, 6) AS volume_stddev,
  match_rate <= 0.80 AS low_match_rate, coalesce(abs(volume - m) > s * 2.0, false) AS unusual_volume FROM framed"""

ORACLE["quality_daily_incremental"] = ORACLE["quality_daily"]

ORACLE["quality_audit_checks"] = _with(*TO_DAILY, LINES, FILES, """days AS (
  SELECT reference_date, sum(txn_count) AS volume,
    coalesce(max(pct_of_total) FILTER (category = 'MATCHED'), 0.0) AS match_rate FROM daily GROUP BY ALL),
framed AS (
  SELECT *, avg(volume) OVER w AS m, stddev_samp(volume) OVER w AS s FROM days
  WINDOW w AS (ORDER BY reference_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""") + """
SELECT 'run' AS run_label, 'gold_ops_reconciliation_daily' AS subject, 'match_rate' AS rule, 'warn' AS action,
  count(*) FILTER (match_rate <= 0.80) AS violations, count(*) AS rows FROM framed
UNION ALL SELECT 'run', 'gold_ops_reconciliation_daily', 'daily_volume', 'warn', count(*) FILTER (abs(volume - m) > s * 2.0), count(*) FROM framed
UNION ALL SELECT 'run', 'raw_paysettler_settlements', 'file_accepted', 'fail', count(*) FILTER (reasons <> ''), count(*) FROM judged
UNION ALL SELECT 'run', 'raw_paysettler_settlements', 'transactions_once', 'warn', count(*) FILTER (dup > 0), count(*) FROM judged"""

ORACLE["quality_audit"] = _with(RESULTS, """found AS (
  SELECT 'valid_transaction_id' AS rule, 'fail' AS action, count(*) FILTER (transaction_id IS NULL) AS violations,
    count(*) AS rows FROM results
  UNION ALL SELECT 'amount_above_1000', 'drop', count(*) FILTER (internal_amount <= 1000), count(*) FROM results
  UNION ALL SELECT 'valid_category', 'warn', count(*) FILTER (category IS NULL), count(*) FROM results
  UNION ALL SELECT 'small_difference', 'warn', count(*) FILTER (difference > 5), count(*) FROM results)""") + """
SELECT run_label, 'silver_reconciliation_results' AS subject, found.* FROM found, (VALUES ('first'), ('second')) AS l(run_label)"""

# --- streams and increments ----------------------------------------------------------------------------------------

ORACLE["stream_append"] = """
SELECT event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY ALL"""

ORACLE["stream_interval"] = """
SELECT user_id, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY ALL"""

ORACLE["stream_upsert"] = """
SELECT concat('U', user_id) AS transaction_id, CASE WHEN event_id % 40 > 3 THEN CAST(ts AS DATE) END AS reference_date,
  value AS amount, event_id
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CASE WHEN event_id % 40 > 3 THEN CAST(ts AS DATE) END
  ORDER BY event_id % 2 DESC, event_id DESC) = 1"""

ORACLE["stream_current_state"] = """
SELECT CASE WHEN event_id % 50 <> 7 THEN user_id END AS user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY CASE WHEN event_id % 50 <> 7 THEN user_id END ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'"""

ORACLE["stream_deduplicated"] = "SELECT event_id, event_type FROM events"

ORACLE["history_hot_key"] = """
WITH log AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS k, event_id, event_type, ts FROM events),
versions AS (SELECT *, lead(ts) OVER (PARTITION BY k ORDER BY ts, event_id) AS next FROM log)
SELECT k, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from, strftime(next, '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
  next IS NULL AS is_current
FROM versions WHERE event_type <> 'error'"""

ORACLE["stream_matches"] = """
WITH i AS (
  SELECT CASE WHEN event_id % 40 <> 11 THEN CAST(event_id AS VARCHAR) END AS id, CAST(value AS DECIMAL(18,2)) AS ours,
    CAST(ts AS DATE) AS created FROM events),
p AS (
  SELECT CASE WHEN event_id % 40 <> 12 THEN CASE WHEN event_id % 5 = 0 THEN 'P' ELSE '' END || CAST(event_id AS VARCHAR) END AS id,
    CAST(value + CASE WHEN event_id % 9 = 0 THEN 1.5 ELSE 0 END AS DECIMAL(18,2)) AS theirs,
    CAST(ts + to_days(CAST(event_id % 12 AS INTEGER)) AS DATE) AS ref FROM events)
SELECT coalesce(i.id, p.id) AS transaction_id, coalesce(ref, created) AS reference_date,
  CASE WHEN created IS NULL THEN 'UNRECONCILED_PROCESSOR' WHEN ref IS NULL THEN 'UNRECONCILED_INTERNAL'
    WHEN abs(ours - theirs) <= 0.01 THEN 'MATCHED' ELSE 'MISMATCHED' END AS category,
  ours AS internal_amount, theirs AS processor_amount, CAST(abs(ours - theirs) AS DECIMAL(18,2)) AS difference
FROM i FULL JOIN p ON i.id = p.id AND created BETWEEN ref - 7 AND ref"""

ORACLE["incremental_daily"] = ORACLE["ops_daily"]
ORACLE["incremental_trend"] = ORACLE["ops_trend"]
ORACLE["incremental_current"] = ORACLE["results_current"]
ORACLE["incremental_run_history"] = ORACLE["run_history"]
ORACLE["incremental_weekly_summary"] = ORACLE["cfo_weekly_summary"]
ORACLE["incremental_weekly_ranking"] = ORACLE["cfo_weekly_merchant_ranking"]

ORACLE["frozen_weeks"] = _with(*TO_CURRENT) + """
SELECT CAST(date_trunc('week', reference_date) AS DATE) AS week_start,
  CAST(date_trunc('week', reference_date) AS DATE) + 6 AS week_end, category, count(*) AS txn_count,
  CAST(sum(coalesce(processor_amount, internal_amount)) AS DECIMAL(28,2)) AS amount_brl
FROM curr
WHERE id % 8 <= 3 OR CAST(date_trunc('week', reference_date) AS DATE) + 6 >= DATE '1998-01-01'
  OR NOT EXISTS (SELECT 1 FROM curr c WHERE c.id % 8 <= 3 AND date_trunc('week', c.reference_date)
    = date_trunc('week', curr.reference_date))
GROUP BY ALL"""

ORACLE["ledger_appended"] = _with(*TO_LEDGER) + """
SELECT result_id, run_id, reference_date, run_status, merchant_id, legal_name, category, internal_amount FROM ledger"""

ORACLE["snapshot_as_of"] = _with(
    RUNS, RESULTS.replace("FROM sided)", "FROM sided WHERE (l_orderkey * 8 + l_linenumber) % 8 <= 5)"),
    COMPANY, WINNING, CURRENT, WEEKLY,
) + "SELECT * FROM weekly"

ORACLE["compliance_export"] = _with(*TO_LEDGER) + """
SELECT reference_date, count(*) AS rows, CAST(sum(processor_amount) AS DECIMAL(28,2)) AS processor_amount
FROM ledger GROUP BY ALL"""
