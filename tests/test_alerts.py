import json
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.text import display_name, one_digit, percent, short_label
from tallyspark.plans import alerts

SCHEMA = (
    "reference_date date, run_status string, category string, txn_count long, "
    "pct_of_total double, pct_of_total_7d_avg double"
)


def trended(spark, *rows, day="2025-03-15", status="COMPLETED"):
    text = [(day, status, *r) for r in rows]
    return spark.createDataFrame(text, SCHEMA.replace("date date", "date string")).withColumn(
        "reference_date", F.col("reference_date").cast("date")
    )


def one(df, **kwargs):
    return alerts.evaluate(df, **kwargs).first()


def test_text_rounds_like_the_exact_binary_value(spark):
    rng = random.Random(7)
    values = [0.0625, 0.0725, 0.1015, 0.1025, 0.1045, 0.1055, 0.05, 0.0005, 0.00049, 0.9995, 1.0, 0.0]
    values += [round(rng.random(), 4) for _ in range(3000)] + [rng.random() for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", percent(F.col("v")).alias("p"), one_digit(F.col("v") * 1234.5).alias("o")
    )
    for r in rows.collect():
        assert r.p == f"{r.v:.1%}", r.v
        assert r.o == f"{r.v * 1234.5:.1f}", r.v


def test_names(spark):
    rows = [("T", "L", "M"), ("", "L", "M"), (None, "", "M"), (None, None, ""), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, l string, m string")
    names = [r[0] for r in df.select(display_name(F.col("t"), F.col("l"), F.col("m"))).collect()]
    assert names == ["T", "L", "M", "(unknown merchant)", "(unknown merchant)"]
    assert spark.range(1).select(short_label(F.lit("UNRECONCILED_INTERNAL"))).first()[0] == "UNR_INTERNAL"


@pytest.mark.parametrize(
    ("row", "fires"),
    [
        (("MISMATCHED", 10, 0.06, None), True),
        (("MISMATCHED", 10, 0.05, None), False),
        (("MISMATCHED", 10, 0.06, 0.04), False),
        (("MISMATCHED", 10, 0.0601, 0.04), True),
        (("UNRECONCILED_INTERNAL", 10, 0.10, None), False),
        (("UNRECONCILED_PROCESSOR", 10, 0.11, 0.0), True),
        (("MATCHED", 10, 0.99, None), False),
        (("OTHER", 10, 0.99, None), False),
        (("MISMATCHED", 10, None, None), False),
    ],
)
def test_spike_rule(spark, row, fires):
    result = one(trended(spark, row))
    assert (len(result.alerts), result.alert_level) == ((1, "CRITICAL") if fires else (0, "OK"))


def test_messages(spark):
    rows = trended(
        spark, ("MISMATCHED", 1234, 0.12, 0.05), ("UNRECONCILED_INTERNAL", 5, 0.2, 0.0), ("MATCHED", 8, 0.68, 0.9), status="FAILED"
    )
    result = one(rows)
    assert [a.message for a in result.alerts] == [
        "Run for 2025-03-15 ended with status 'FAILED' — reconciliation may be incomplete or absent.",
        "MISMATCHED rate 12.0% exceeds threshold 5.0% and is 2.4× the 7-day avg (5.0%)",
        "UNRECONCILED_INTERNAL rate 20.0% exceeds threshold 10.0%",
    ]
    assert result.breakdown == [
        "  :white_check_mark: *MATCHED*: 68.0% (8 txns)",
        "  :warning: *MISMATCHED*: 12.0% (1,234 txns)",
        "  :x: *UNRECONCILED_INTERNAL*: 20.0% (5 txns)",
    ]
    assert result.total == 1247 and result.match_rate == 0.68


def test_latest_requested_and_unknown_dates(spark):
    rows = trended(spark, ("MATCHED", 1, 1.0, None)).union(
        trended(spark, (None, 0, None, None), day="2025-03-16", status="FAILED")
    )
    for default in (None, ""):
        latest = one(rows, dates=alerts.requested_date(rows, default))
        assert (str(latest.reference_date), latest.run_status, latest.total) == ("2025-03-16", "FAILED", 0)
    unknown = one(rows, dates=alerts.requested_date(rows, "2030-01-01"))
    assert (unknown.run_status, unknown.alert_level, unknown.breakdown) == ("NO_RUN", "CRITICAL", [])
    assert alerts.latest_date(rows.filter("false")).count() == 0


def test_payload_files(spark, tmp_path):
    rows = trended(spark, ("MATCHED", 1000, 0.9, None), ("MISMATCHED", 100, 0.1, None)).union(
        trended(spark, ("MATCHED", 1, 1.0, None), day="2025-03-16")
    )
    folder = str(tmp_path / "alerts")
    for _ in range(2):
        alerts.write_payloads(alerts.payload(alerts.evaluate(rows)), folder)
    stored = {str(r.reference_date): json.loads(r.value) for r in spark.read.text(folder).collect()}
    blocks = stored["2025-03-15"]["blocks"]
    assert [b["type"] for b in blocks] == ["header", "section", "divider", "section", "divider", "section", "context"]
    assert blocks[0]["text"] == {"type": "plain_text", "text": ":red_circle: Reconciliation CRITICAL — 2025-03-15"}
    assert [f["text"] for f in blocks[1]["fields"]] == [
        "*Status*\nCRITICAL", "*Run Status*\nCOMPLETED", "*Total Transactions*\n1,100", "*Match Rate*\n90.0%",
    ]
    assert set(blocks[2]) == {"type"}
    assert blocks[3]["text"]["text"] == "*Active Alerts*\n  :warning: MISMATCHED rate 10.0% exceeds threshold 5.0%"
    quiet = stored["2025-03-16"]["blocks"]
    assert [b["type"] for b in quiet] == ["header", "section", "divider", "section", "context"]
    assert quiet[4]["elements"][0]["text"] == "_Reference date: 2025-03-16 · not delivered, payload only_"
