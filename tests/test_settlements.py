import datetime
import logging
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.functions.amounts import ambiguous_amount, normalize_amount
from tallyspark.sources import settlements as csv

HEADER = "transaction_id,merchant_id,amount,currency,settled_at,processor_reference,status"
DATED = r"(\d{4}-\d{2}-\d{2})"


def line(txn="TXN1", merchant="MERCH1", amount="100.00", settled="2025-03-15T10:00:00Z", status="SETTLED", currency="BRL"):
    return f"{txn},{merchant},{amount},{currency},{settled},REF1,{status}"


def drop(folder, name, *lines, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder / name)


def loaded(store):
    return {(r.transaction_id, str(r.reference_date)): r.amount for r in store.read(csv.TABLE).collect()}


def test_key_spans_dates(store, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "settlement_2025-03-15.csv", line("TXN1"), line("TXN2"))
    drop(folder, "settlement_2025-03-16.csv", line("TXN1"), line("TXN3"))
    result = csv.load_directory(store, str(folder), DATED)
    assert result == {"settlement_2025-03-15.csv": 2, "settlement_2025-03-16.csv": 2}
    assert store.read(csv.TABLE).count() == len(loaded(store)) == 4


def test_reload_is_idempotent_and_vanished_keys_stay(store, tmp_path):
    path = drop(tmp_path / "in", "a.csv", line("TXN1"), line("TXN2"))
    assert csv.load_file(store, path, "2025-03-15") == 2
    assert csv.load_file(store, path, "2025-03-15") == 2
    assert store.read(csv.TABLE).count() == 2
    drop(tmp_path / "in", "a.csv", line("TXN1", amount="7.50"))
    csv.load_file(store, path, "2025-03-15")
    assert loaded(store) == {("TXN1", "2025-03-15"): Decimal("7.50"), ("TXN2", "2025-03-15"): Decimal("100.00")}


def test_last_occurrence_in_file_wins(store, tmp_path, caplog):
    path = drop(tmp_path / "in", "a.csv", line(amount="100.00"), line(amount="200.00"))
    with caplog.at_level(logging.WARNING):
        assert csv.load_file(store, path, "2025-03-15") == 1
    assert any("transaction ids occur several times" in r.message for r in caplog.records)
    assert loaded(store) == {("TXN1", "2025-03-15"): Decimal("200.00")}


def test_last_occurrence_wins_across_splits(spark, store, tmp_path):
    lines = [line(f"TXN{i % 500}", amount=f"{i + 1}.00") for i in range(20000)]
    path = drop(tmp_path / "in", "a.csv", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert csv.load_file(store, path, "2025-03-15") == 500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = {(f"TXN{k}", "2025-03-15"): Decimal(19500 + k + 1) for k in range(500)}
    assert loaded(store) == expected


@pytest.mark.parametrize(
    ("bad", "message"),
    [
        (line(amount="0.00"), "amount is zero or less"),
        (line(amount="-5.00"), "amount is zero or less"),
        (line(txn=""), "transaction_id is blank"),
        (line(txn="  "), "transaction_id is blank"),
        (line(merchant=""), "merchant_id is blank"),
        (line(amount="abc"), "Unreadable amounts"),
        (line(amount=""), "Missing amounts"),
        (line(status="PENDING"), "Unknown statuses"),
        (line(settled="yesterday"), "settled_at"),
        (line() + ",more", "surplus fields"),
        (line(amount="R$ 32.245,91"), "surplus fields"),
    ],
)
def test_halting_rules_reject_the_file(store, tmp_path, bad, message):
    path = drop(tmp_path / "in", "a.csv", line("OK1"), bad)
    with pytest.raises(ValueError, match=message):
        csv.load_file(store, path, "2025-03-15")
    assert not store.exists(csv.TABLE)


def test_amount_formats(spark):
    texts = {
        "152.30": "152.30", "R$ 32.245,91": "32245.91", "R$ 10.00": "10.00", " 7,5 ": "7.50",
        "1,234.50": "1.23", "1,2,3": None, "abc": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", normalize_amount(F.col("t")).alias("a"), ambiguous_amount(F.col("t")).alias("odd")).collect()
    assert {r.t: None if r.a is None else str(r.a) for r in rows} == texts
    assert [r.t for r in rows if r.odd] == ["1,234.50"]


def test_date_from_name_and_from_callable(store, tmp_path):
    drop(tmp_path / "in", "day1.csv", line("TXN1"))
    assert csv.load_directory(store, str(tmp_path / "in"), lambda name: "2025-01-01") == {"day1.csv": 1}
    drop(tmp_path / "other", "settlement_2025-03-15.csv", line("TXN2"))
    csv.load_directory(store, str(tmp_path / "other"), r"\d{4}-\d{2}-\d{2}")
    assert set(loaded(store)) == {("TXN1", "2025-01-01"), ("TXN2", "2025-03-15")}


def test_bad_files_are_left_out_and_others_load(store, tmp_path, caplog):
    folder = tmp_path / "in"
    drop(folder, "settlement_2025-03-11.csv", "TXN1,M,1.00,BRL,2025-03-15T10:00:00Z,R", header=HEADER.replace(",status", ""))
    drop(folder, "settlement_2025-03-12.csv")
    drop(folder, "settlement_2025-03-13.csv", line(amount="-5.00"))
    drop(folder, "undated.csv", line("TXN9"))
    drop(folder, "settlement_2025-03-16.csv", line("TXN2"))
    (folder / "README.txt").write_text("not a csv")
    with caplog.at_level(logging.ERROR):
        assert csv.load_directory(store, str(folder), DATED) == {"settlement_2025-03-16.csv": 1}
    log = caplog.text
    assert "header lacks status" in log and "no rows below the header" in log and "reference_date" in log
    assert set(loaded(store)) == {("TXN2", "2025-03-16")}


def test_columns_are_found_by_name(store, tmp_path):
    header = "note,status,processor_reference,settled_at,currency,amount,merchant_id,transaction_id"
    drop(tmp_path / "in", "settlement_2025-03-15.csv", "x,SETTLED,R,2025-03-15T10:00:00Z,BRL,5.00,M1,TXN7", header=header)
    drop(tmp_path / "in", "settlement_2025-03-16.csv", line("TXN8"))
    csv.load_directory(store, str(tmp_path / "in"), DATED)
    assert loaded(store)[("TXN7", "2025-03-15")] == Decimal("5.00")
    assert loaded(store)[("TXN8", "2025-03-16")] == Decimal("100.00")


def test_later_file_name_wins_for_one_date(store, tmp_path):
    drop(tmp_path / "in", "a_2025-03-15.csv", line(amount="1.00"))
    drop(tmp_path / "in", "b_2025-03-15.csv", line(amount="2.00"))
    csv.load_directory(store, str(tmp_path / "in"), DATED)
    assert loaded(store) == {("TXN1", "2025-03-15"): Decimal("2.00")}


def test_times_without_zone_are_utc(store, tmp_path):
    path = drop(
        tmp_path / "in", "a.csv", line("T1", settled="2025-03-15T10:00:00"), line("T2", settled="2025-03-15T10:00:00Z"),
        line("T3", settled="2025-03-15T10:00:00+00:00"),
    )
    csv.load_file(store, path, "2025-03-15")
    times = {r[0] for r in store.read(csv.TABLE).select(F.date_format("settled_at", "HH:mm")).collect()}
    assert times == {"10:00"}


def test_missing_inputs(store, tmp_path):
    with pytest.raises(NotADirectoryError):
        csv.load_directory(store, str(tmp_path / "nowhere"), DATED)
    with pytest.raises(FileNotFoundError):
        csv.load_file(store, str(tmp_path / "nothing.csv"), "2025-03-15")


def test_no_matching_file(store, tmp_path, caplog):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("x")
    with caplog.at_level(logging.WARNING):
        assert csv.load_directory(store, str(tmp_path / "in"), DATED) == {}
    assert "no files matching" in caplog.text


def test_union_by_name(spark, tmp_path):
    folder = tmp_path / "in put+1"
    drop(folder, "a.csv", "1,2", header="x,y")
    drop(folder, "b.csv", '3,"4,5"', header="z,x")
    rows = {r.name: r.asDict() for r in csv.union_by_name(spark, str(folder)).collect()}
    assert rows == {
        "a.csv": {"name": "a.csv", "x": "1", "y": "2", "z": None, "surplus": False},
        "b.csv": {"name": "b.csv", "x": "4,5", "y": None, "z": "3", "surplus": False},
    }


def test_load_metadata(store, tmp_path):
    path = drop(tmp_path / "in", "a.csv", line())
    csv.load_file(store, path, "2025-03-15")
    row = store.read(csv.TABLE).first()
    assert row._source_file == "a.csv" and row.reference_date == datetime.date(2025, 3, 15)
    assert row._loaded_at is not None
    assert [tuple(r) for r in csv.rows_by_file(store.read(csv.TABLE)).collect()] == [("a.csv", 1)]


def test_quoted_fields(store, tmp_path):
    path = drop(tmp_path / "in", "a.csv", line(merchant='"M ""X"", Ltda"', amount='"R$ 32.245,91"'))
    csv.load_file(store, path, "2025-03-15")
    row = store.read(csv.TABLE).first()
    assert (row.merchant_id, row.amount) == ('M "X", Ltda', Decimal("32245.91"))


def verdicts(store, folder, dates=DATED, **options):
    return {v.name: "; ".join(v.reasons) for v in csv.judge_and_load(store, str(folder), dates, **options).collect()}


def test_header_is_read_to_its_end(store, tmp_path):
    folder = tmp_path / "in"
    filler = ",".join(f"{'x' * 300}{i}" for i in range(400))
    drop(folder, "2025-03-15.csv", "," * 400 + line(), header=f"{filler},{HEADER}")
    drop(folder, "2025-03-16.csv", line("TXN2") + ",note", header=HEADER + ",odd name")
    assert verdicts(store, folder) == {"2025-03-15.csv": "", "2025-03-16.csv": ""}
    assert store.read(csv.TABLE).count() == 2


def test_hidden_files_get_a_verdict(store, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "2025-03-15.csv", line())
    drop(folder, "_2025-03-16.csv", line())
    drop(folder, ".2025-03-17.csv", line())
    drop(folder, "_other.txt", line())
    found = verdicts(store, folder)
    assert set(found) == {"2025-03-15.csv", "_2025-03-16.csv", ".2025-03-17.csv"}
    assert found["2025-03-15.csv"] == "" and "begins with" in found["_2025-03-16.csv"]


def test_a_raising_callable_costs_its_file_only(store, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "2025-03-15.csv", line())
    drop(folder, "undated.csv", line("TXN2"))
    found = verdicts(store, folder, lambda path: {"2025-03-15": "2025-03-15"}[path.stem])
    assert found["2025-03-15.csv"] == "" and "callable failed (KeyError" in found["undated.csv"]
    assert store.read(csv.TABLE).count() == 1


def test_file_names_are_no_patterns(store, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    path = drop(folder, "a[1]{x}*.csv", line("TXN9"))
    drop(folder, "a1x.csv", line("TXN8"))
    assert csv.load_file(store, path, "2025-03-15") == 1
    assert loaded(store) == {("TXN9", "2025-03-15"): Decimal("100.00")}
    monkeypatch.chdir(folder)
    with pytest.raises(FileNotFoundError):
        csv.load_file(store, str(folder / "missing.csv"), "2025-03-15")


def test_union_marks_surplus_fields(spark, tmp_path):
    drop(tmp_path / "in", "a.csv", line(), line("TXN2") + ",more")
    assert {r.transaction_id: r.surplus for r in csv.union_by_name(spark, str(tmp_path / "in")).collect()} == {"TXN1": False, "TXN2": True}


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_quoted_line_breaks_in_several_splits(spark, store, tmp_path, ending):
    """Fields with line breaks, quotes and commas, long enough to reach over splits of the file."""
    folder, want = tmp_path / "in", {}
    folder.mkdir()
    text = [HEADER]
    for i in range(400):
        merchant = f"M{i}" if i % 3 else f"M{i}" + "\n".join(["", 'say ""it"", twice', "x" * (i % 7) * 40, ""])
        want[f"TXN{i}"] = merchant.replace('""', '"')
        text.append(line(f"TXN{i}", f'"{merchant}"' if i % 3 == 0 else merchant, amount=f"{i + 1}.00"))
    (folder / "2025-03-15.csv").write_bytes(ending.join(text).encode() + ending.encode())
    drop(folder, "2025-03-16.csv", line("A"), line("B"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert csv.load_directory(store, str(folder), DATED) == {"2025-03-15.csv": 400, "2025-03-16.csv": 2}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    table = store.read(csv.TABLE).filter("reference_date = '2025-03-15'").collect()
    assert {r.transaction_id: r.merchant_id for r in table} == want


def test_a_quote_too_many_costs_its_file_only(store, tmp_path, caplog, monkeypatch):
    monkeypatch.setattr(csv, "MAX_RECORD", 500)
    folder = tmp_path / "in"
    drop(folder, "2025-03-15.csv", line("A"), line("B", merchant='"M'), *[line(f"C{i}") for i in range(30)])
    drop(folder, "2025-03-16.csv", line("A"))
    assert csv.load_directory(store, str(folder), DATED) == {"2025-03-16.csv": 1}
    assert "Quoted fields without an end" in caplog.text


def test_hidden_names_at_every_level(spark, tmp_path):
    for name in ("a.csv", "_b.csv", "c/d.csv", "c/.e.csv", "_f/g.csv", "c/_h/i/j.csv", "c/_k.txt", "c[1]/_l.csv"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text("x")
    root = str(tmp_path / "in")
    assert sorted(n for _, n in csv.hidden_files(spark, root, "*.csv", True)) == ["_b.csv", "_f/g.csv", "c/.e.csv", "c/_h/i/j.csv", "c[1]/_l.csv"]
    assert [n for _, n in csv.hidden_files(spark, root)] == ["_b.csv"]
