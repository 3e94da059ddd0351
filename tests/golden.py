"""The hand-written silver tables that several tests share."""

from tallyspark import schemas


def _frame(spark, rows, schema):
    text = spark.createDataFrame(rows, ", ".join(f"{c.split()[0]} string" for c in schema.split(", ")))
    return text.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in schema.split(", ")])


def runs(spark, *extra):
    rows = [
        (1, "2024-01-08", "f1.csv", "COMPLETED", 3, "2024-01-08 08:00:00"),
        (2, "2024-01-08", "f1.csv", "COMPLETED", 3, "2024-01-08 09:00:00"),
        (3, "2024-01-14", "f2.csv", "COMPLETED", 2, "2024-01-14 08:00:00"),
        (4, "2024-01-15", "f3.csv", "COMPLETED", 1, "2024-01-15 08:00:00"),
        *extra,
    ]
    filled = [tuple(str(v) for v in (*r, r[5].replace(":00:00", ":01:00"), r[5], "test")) for r in rows]
    return _frame(spark, filled, schemas.RUNS)


def results(spark, *extra):
    rows = [
        (10, 1, "txn-A", "M001", "MATCHED", "100", "100"),
        (11, 1, "txn-B", "M002", "MISMATCHED", "200", "195"),
        (12, 1, "txn-C", "M003", "UNRECONCILED_INTERNAL", "300", None),
        (20, 2, "txn-A", "M001", "MATCHED", "100", "100"),
        (21, 2, "txn-D", "M001", "MATCHED", "50", "50"),
        (22, 2, "txn-C", "M003", "UNRECONCILED_INTERNAL", "300", None),
        (30, 3, "txn-E", "M001", "MATCHED", "150", "150"),
        (31, 3, "txn-F", "M002", "MISMATCHED", "250", "240"),
        (40, 4, "txn-G", "M001", "MATCHED", "120", "120"),
        *extra,
    ]

    def fill(r):
        difference = None if None in r[5:7] else str(abs(float(r[5]) - float(r[6])))
        return tuple(None if v is None else str(v) for v in (*r, difference, "2024-01-08 08:01:00", "test"))

    return _frame(spark, [fill(r) for r in rows], schemas.RESULTS.replace("decimal(18,2)", "decimal(18,2)"))


def company(spark, *extra):
    rows = [
        (1, "M001", "ACME Corp Ltda", "ACME", "12.345.678/0001-90", "6201-5"),
        (2, "M002", "Beta Comercio SA", "Beta", "98.765.432/0001-10", "4711-3"),
        (3, "M003", "Gama Servicos ME", "Gama", "11.111.111/0001-11", "6209-1"),
        *extra,
    ]
    day = "2024-01-01 00:00:00"
    return _frame(spark, [tuple(str(v) for v in (*r, day, day)) for r in rows], schemas.COMPANY)


def as_log(df, op="I"):
    """A silver table as a raw change log with text timestamps and float amounts."""
    columns = []
    for field in df.schema.fields:
        kind, name = field.dataType.simpleString(), field.name
        if kind == "timestamp":
            columns.append(f"date_format({name}, \"yyyy-MM-dd'T'HH:mm:ss+00:00\") {name}")
        elif kind == "date":
            columns.append(f"cast({name} as string) {name}")
        elif kind.startswith("decimal"):
            columns.append(f"cast({name} as double) {name}")
        elif kind == "int":
            columns.append(f"cast({name} as long) {name}")
        elif name != "source":
            columns.append(name)
    stamp = "started_at" if "started_at" in df.columns else "created_at"
    stamped = f"date_format({stamp}, \"yyyy-MM-dd'T'HH:mm:ss+00:00\") _timestamp"
    return df.selectExpr(*columns, f"'{op}' Op", stamped)
