"""Daily processor CSV drops: listing, header probe, verdict per file, load."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyspark.functions.amounts import ambiguous_amount, normalize_amount
from tallyspark.operators.cdc import last_per_key
from tallyspark.operators.quality import FAIL, WARN, Rule, duplicate_keys
from tallyspark.schemas import SETTLEMENT_COLUMNS, SETTLEMENT_STATUSES
from tallyspark.sources.store import Store, delete_path, is_folder, path_exists, stage

logger = logging.getLogger(__name__)

TABLE = "raw_paysettler_settlements"
KEYS = ("transaction_id", "reference_date")
READ_BYTES = 1 << 16
FILES_PER_PROBE_TASK = 256
#: Characters of a record at most.
MAX_RECORD = 1 << 21

DatePattern = str | Callable[[str], str]


# --- listing and headers -----------------------------------------------------


def list_files(spark: SparkSession, folder: str, glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(file, name) of the matching files; ``name`` is the path below the folder.

    Spark lists in parallel, and as the content column is not selected no file is opened.
    """
    if not is_folder(spark, folder):
        raise NotADirectoryError(f"settlement folder not found: {folder}")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    root = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/") + "/"
    file = F.col("_metadata.file_path")
    # The metadata path is percent-encoded, in which a plus sign stands for itself.
    plain = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    return reader.load(folder).select(
        file.alias("file"), F.substring_index(plain, root, -1).alias("name")
    )


def hidden_files(spark: SparkSession, folder: str, glob: str = "*.csv", recursive: bool = False) -> list[tuple[str, str]]:
    """(file, name) of matching files that Spark's readers pass over, as a part of the path
    begins with an underscore or a dot; usually none.

    The file system matches such names level by level, so that only they reach the driver,
    and only hidden folders are walked.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    matches, base = jvm.org.apache.hadoop.fs.GlobFilter(glob), root.toUri().getPath().rstrip("/") + "/"
    literal = re.sub(r"([\\*?\[\]{}^,])", r"\\\1", folder.rstrip("/"))
    found, level = [], ""
    while True:
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{literal}/{level}[_.]*")) or []:
            if not status.isDirectory():
                found.append(status.getPath())
            elif recursive:
                inside = fs.listFiles(status.getPath(), True)
                while inside.hasNext():
                    found.append(inside.next().getPath())
        level += "[!_.]*/"
        # Visible folders of the next level; a trailing star would name their files, too.
        if not recursive or not fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{literal}/{level}*")):
            break
    return [(p.toString(), p.toUri().getPath().split(base, 1)[-1]) for p in found if matches.accept(p)]


def with_headers(files: DataFrame) -> DataFrame:
    """Adds ``header``, the names in the first line of each file, read by the executors.

    The line is read to its end, however far that is. A file that cannot be read has an
    empty header and says why in ``problem``; the others are not affected.
    """
    step = READ_BYTES

    # Defined here so that it travels by value and the executors need not have this package.
    def first_lines(batches):
        import csv

        from pyarrow import fs

        def first_line(uri):
            # Arrow knows object stores by their plain scheme only.
            system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            raw = b""
            with system.open_input_stream(path) as stream:
                while b"\n" not in raw and b"\r" not in raw and (more := stream.read(step)):
                    raw += more
            return raw.replace(b"\r", b"\n").split(b"\n", 1)[0].decode("utf-8-sig", errors="replace")

        for batch in batches:
            headers, problems = [], []
            for uri in batch["file"]:
                try:
                    names, problem = next(csv.reader([first_line(uri)]), []), None
                except Exception as exc:  # one bad file must not stop the others
                    names, problem = [], f"header cannot be read ({type(exc).__name__})"
                headers.append([name.strip() for name in names])
                problems.append(problem)
            yield batch.assign(header=headers, problem=problems)

    tasks = max(1, -(-files.count() // FILES_PER_PROBE_TASK))
    return files.repartition(tasks).mapInPandas(
        first_lines, "file string, name string, header array<string>, problem string"
    )


def _width(files: DataFrame) -> int:
    return files.agg(F.max(F.size("header"))).first()[0] or 1


def _by_name(lines: DataFrame, files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns of ``lines`` (file, _block, _line, _open, _fields), by the headers of ``files``.

    A column that a file lacks is NULL. ``_surplus`` marks rows with more fields than the
    header has names.
    """
    named = files.withColumn("_width", F.size("header")).select("*", *[F.array_position("header", c).alias(f"_at_{i}") for i, c in enumerate(columns)])
    fields = [
        F.get("_fields", F.col(f"_at_{i}").cast("int") - 1).alias(c) for i, c in enumerate(columns)
    ]
    extra = [c for c in files.columns if c not in ("file", "header")]
    surplus = F.get("_fields", F.col("_width")).isNotNull().alias("_surplus")
    return lines.join(named, "file").select(*extra, "_block", "_line", "_open", surplus, *fields)


def read_by_name(files: DataFrame, folder: str, columns: Sequence[str], glob: str, recursive: bool) -> DataFrame:
    """The named columns of all files as text, wherever each file has them, read line by line.

    One scan over the folder reads columns by position; ``files`` (file, header, further
    columns) turns positions into names and drops the rows of files it does not list.
    ``_block`` and ``_line`` order the rows of a file also when the file is read in several
    splits; ``_open`` marks lines with an odd number of quotes, on which a field goes on.
    """
    width = _width(files)
    # No line has as many fields as the schema, so the reader keeps the text of each beside them.
    reader = files.sparkSession.read.schema(", ".join([*(f"_c{i} string" for i in range(width + 2)), "_text string"]))
    reader = reader.option("columnNameOfCorruptRecord", "_text")
    reader = reader.option("header", True).option("escape", '"').option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.csv(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        F.coalesce(_quotes(F.col("_text")) % 2 == 1, F.lit(False)).alias("_open"),
        F.array(*[f"_c{i}" for i in range(width + 2)]).alias("_fields"),
    )
    return _by_name(lines, files, columns)


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def records(lines: DataFrame) -> DataFrame:
    """Whole records (file, _block, _line, text) from the lines (file, _block, _line, text) of files.

    A line break between quotes belongs to its field. Whether a line begins inside a field is
    the parity of all quotes before it in its file: the quotes of each split are counted, the
    counts of a file's splits are added up in order, and only then is the parity carried on from
    line to line within a split. So files stay splittable, and a field may even reach over a
    split. Lines are joined up by the line that their record begins with. A file with a record
    of more than ``MAX_RECORD`` characters, as one quote too many makes, has no records.
    """
    line = lines.withColumn("_odd", _quotes(F.col("text")))
    file, split = Window.partitionBy("file").orderBy("_block"), Window.partitionBy("file", "_block").orderBy("_line")
    earlier = (Window.unboundedPreceding, -1)
    # One row per split of a file.
    splits = line.groupBy("file", "_block").agg(F.sum("_odd").alias("_quotes"))
    splits = splits.withColumn("_quoted", F.coalesce(F.sum("_quotes").over(file.rowsBetween(*earlier)), F.lit(0))).drop("_quotes")
    before = F.col("_quoted") + F.coalesce(F.sum("_odd").over(split.rowsBetween(*earlier)), F.lit(0))
    begins = line.join(splits, ["file", "_block"]).withColumn("_begins", before % 2 == 0)
    own = F.last(F.when(F.col("_begins"), F.col("_line")), ignorenulls=True).over(split.rowsBetween(Window.unboundedPreceding, 0))
    placed = begins.withColumn("_own", own)
    lasts = placed.groupBy("file", "_block").agg(F.max("_own").alias("_last"))
    last = F.when(F.col("_last").isNotNull(), F.struct("_block", "_last"))
    lasts = lasts.withColumn("_carried", F.last(last, ignorenulls=True).over(file.rowsBetween(*earlier))).drop("_last")
    record = placed.join(lasts, ["file", "_block"]).select(
        "file",
        F.when(F.col("_own").isNotNull(), F.col("_block")).otherwise(F.col("_carried._block")).alias("_first_block"),
        F.coalesce("_own", "_carried._last").alias("_first"),
        F.struct("_block", "_line", "text").alias("_part"),
    )
    size = record.groupBy("file", "_first_block", "_first").agg(F.sum(F.length("_part.text") + 1).alias("_size"))
    endless = size.filter(F.col("_size") > MAX_RECORD).select("file").distinct()
    joined = record.join(endless, "file", "left_anti").groupBy("file", "_first_block", "_first").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    text = F.rtrim(F.array_join("_parts.text", "\n"), F.lit("\r"))
    return joined.select("file", F.col("_first_block").alias("_block"), F.col("_first").alias("_line"), text.alias("text"))


def read_records(files: DataFrame, folder: str, columns: Sequence[str], glob: str, recursive: bool) -> DataFrame:
    """As ``read_by_name``, for files with line breaks between quotes: by record instead of line."""
    width = _width(files)
    reader = files.sparkSession.read.option("lineSep", "\n").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        F.col("value").alias("text"),
    )
    whole = records(lines.join(files.select("file"), "file", "left_semi")).filter("length(trim(text)) > 0")
    # The first record of a file is its header.
    head = F.min(F.struct("_block", "_line")).alias("_head")
    heads = whole.groupBy("file").agg(head)
    rows = whole.join(heads, "file").filter(F.struct("_block", "_line") > F.col("_head"))
    schema = ", ".join(f"_c{i} string" for i in range(width + 1))
    parsed = F.from_csv("text", schema, {"escape": '"'})
    fields = rows.withColumn("_row", parsed).select(
        "file", "_block", "_line", F.lit(False).alias("_open"), F.array(*[f"_row._c{i}" for i in range(width + 1)]).alias("_fields")
    )
    return _by_name(fields, files, columns)


def union_by_name(spark: SparkSession, folder: str, glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """All files of a folder as text columns, united by header name.

    ``surplus`` marks lines with more fields than their header has names; what stands beyond
    the last name has no column to go to. Files without a readable header fail the union.
    """
    files = with_headers(list_files(spark, folder, glob, recursive))
    headed, staged = stage(files, "csv-headers")
    problem = headed.filter("problem IS NOT NULL").first()
    if problem:
        raise ValueError(f"{problem.name}: {problem.problem}")
    headed = headed.drop("problem")
    names = [r[0] for r in headed.select(F.explode("header")).distinct().orderBy(F.col("col")).collect()]
    united = read_by_name(headed, folder, names, glob, recursive)
    return united.select("name", *names, F.col("_surplus").alias("surplus"))


# --- reference dates -----------------------------------------------------------


def with_reference_dates(files: DataFrame, dates: DatePattern) -> DataFrame:
    """Adds ``reference_date``, NULL where none can be derived.

    A pattern yields its first capture group, or the whole match if it has none. A callable
    gets the path below the folder (a ``PurePosixPath``) of one file at a time, on the
    executors: the file list stays distributed. If it raises, that is the file's ``problem``.
    """
    if callable(dates):

        def dated(batches):
            from pathlib import PurePosixPath

            for batch in batches:
                found, problems = [], list(batch["problem"])
                for i, name in enumerate(batch["name"]):
                    try:
                        found.append(str(dates(PurePosixPath(name))))
                    except Exception as exc:  # one bad file must not stop the others
                        found.append(None)
                        problems[i] = problems[i] or f"reference_date callable failed ({type(exc).__name__}: {exc})"
                yield batch.assign(_date=found, problem=problems)

        columns = "file string, name string, header array<string>, problem string, _date string"
        files = files.mapInPandas(dated, columns)
        text = F.col("_date")
    else:
        groups = files.sparkSession._jvm.java.util.regex.Pattern.compile(dates).matcher("").groupCount()
        text = F.regexp_extract("name", dates, 1 if groups else 0)
    return files.withColumn("reference_date", text.try_cast("date")).drop("_date")


# --- rules ---------------------------------------------------------------------


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.length(F.trim(column)) > 0)


def settlement_rules() -> list[Rule]:
    """Row rules over the parsed columns; a violated "fail" rule rejects the whole file."""
    amount, text = F.col("amount"), F.col("amount_text")
    rules = [
        Rule("amount_positive", amount > 0, "amount is zero or less"),
        Rule("transaction_id_filled", _filled("transaction_id"), "transaction_id is blank"),
        Rule("merchant_id_filled", _filled("merchant_id"), "merchant_id is blank"),
        Rule("amount_parses", text.isNull() | amount.isNotNull(), "Unreadable amounts found"),
        Rule("amount_present", text.isNotNull(), "Missing amounts found"),
        Rule("settled_at_parses", F.col("settled_at").isNotNull(), "Missing or unreadable settled_at found"),
        Rule("currency_present", F.col("currency").isNotNull(), "Missing currencies found"),
        Rule("reference_present", F.col("processor_reference").isNotNull(), "Missing processor references found"),
        Rule("status_known", F.coalesce(F.col("status").isin(*SETTLEMENT_STATUSES), F.lit(False)), "Unknown statuses found"),
        Rule("quotes_end", ~F.col("_open"), "Quoted fields without an end found"),
        Rule("fields_fit", ~F.col("_surplus"), "Rows with surplus fields found"),
        Rule("amount_unambiguous", ~ambiguous_amount(text), "Ambiguous amounts found", WARN),
        Rule("currency_length", F.length("currency") == 3, "Currency codes not of length 3 found", WARN),
    ]
    return rules


# --- load ------------------------------------------------------------------------


def _parse(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Typed columns and ``violated``, one bit per rule that a row violates."""
    typed = (
        rows.withColumnRenamed("amount", "amount_text")
        .withColumn("amount", normalize_amount(F.col("amount_text")))
        .withColumn("settled_at", F.col("settled_at").try_cast("timestamp"))
    )
    bits = [F.when(r.violated, 1 << i).otherwise(0) for i, r in enumerate(rules)]
    mask = reduce(lambda a, b: a.bitwiseOR(b), bits)
    return typed.withColumn("violated", mask).select(
        "file_no", "_block", "_line", *SETTLEMENT_COLUMNS, "violated", "_open"
    )


def _repeated(rows: DataFrame) -> DataFrame:
    """Transactions that occur more than once in a file. Only the keys are shuffled, and an
    id that fills the file travels as one row per task."""
    return duplicate_keys(rows, ["file_no", "transaction_id"])


def _last_in_file(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows with repeated transactions reduced to the last occurrence in file order.

    Only the repeated ones are ranked; all other rows pass without a shuffle as long as
    the repeated keys are few enough to be broadcast, which Spark decides by their size.
    """
    keys = ["file_no", "transaction_id"]
    again = repeated.select(*keys)
    order = [F.col("_block").desc(), F.col("_line").desc()]
    last = last_per_key(rows.join(again, keys, "left_semi"), keys, order)
    return rows.join(again, keys, "left_anti").unionByName(last)


def _verdicts(
    files: DataFrame, rows: DataFrame, repeated: DataFrame, rules: Sequence[Rule]
) -> DataFrame:
    """(file_no, file, name, reference_date, rows, loaded, duplicates, reasons, warnings)
    per file."""
    counts = rows.groupBy("file_no").agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(F.col("violated").bitwiseAND(F.lit(1 << i)) != 0).alias(r.name)
            for i, r in enumerate(rules)
        ],
    )
    doubles = repeated.groupBy("file_no").agg(
        F.count("*").alias("duplicates"), F.sum(F.col("occurrences") - 1).alias("superseded")
    )
    header = F.coalesce(F.col("header"), F.array().cast("array<string>"))
    absent = F.array_except(F.array(*map(F.lit, SETTLEMENT_COLUMNS)), header)

    def notes(action: str, *more: Column) -> Column:
        found = [
            F.when(F.col(r.name) > 0, F.concat(F.lit(f"{r.message} ("), F.col(r.name), F.lit(" rows)")))
            for r in rules
            if r.action == action
        ]
        return F.array_compact(F.array(*more, *found))

    rows_read = F.coalesce("rows", F.lit(0))
    header_ok = F.size(absent) == 0
    dated = F.col("reference_date").isNotNull()
    together = files.join(counts, "file_no", "left").join(doubles, "file_no", "left")
    judged = together.select(
        "file_no",
        "file",
        "name",
        "reference_date",
        rows_read.alias("rows"),
        F.coalesce("duplicates", F.lit(0)).alias("duplicates"),
        (rows_read - F.coalesce("superseded", F.lit(0))).alias("distinct_ids"),
        notes(
            FAIL,
            F.col("problem"),
            F.when(F.col("problem").isNull() & ~header_ok, F.concat(F.lit("header lacks "), F.array_join(F.sort_array(absent), ", "))),
            F.when(header_ok & dated & (rows_read == 0), F.lit("no rows below the header")),
            F.when(F.col("problem").isNull() & ~dated, F.lit("No reference_date can be derived")),
        ).alias("reasons"),
        notes(
            WARN,
            F.when(F.col("duplicates") > 0, F.concat("duplicates", F.lit(" transaction ids occur several times, the last row counts"))),
        ).alias("warnings"),
    )
    loaded = F.when(F.size("reasons") == 0, F.col("distinct_ids")).otherwise(F.lit(0))
    return judged.withColumn("loaded", loaded).drop("distinct_ids")


def judge_and_load(
    store: Store,
    folder: str,
    dates: DatePattern,
    glob: str = "*.csv",
    recursive: bool = False,
) -> DataFrame:
    """Load every acceptable file of a folder; returns one verdict row per file.

    All files go through the same few jobs: list them and probe headers, read and check
    the rows (staged), judge per file, upsert. A file with a reason against it loads nothing
    and does not hinder the others. Of several files with one reference date, the last in
    name order wins for equal transactions.
    """
    spark = store.spark
    listed = with_reference_dates(with_headers(list_files(spark, folder, glob, recursive)), dates)
    hidden = hidden_files(spark, folder, glob, recursive)
    if hidden:
        why = "file or folder name begins with an underscore or a dot, which Spark does not read"
        named = spark.createDataFrame(hidden, "file string, name string")
        listed = listed.unionByName(named.withColumn("problem", F.lit(why)), allowMissingColumns=True)
    # The number stands for the long path in the shuffles; it is fixed by being written.
    numbered = listed.withColumn("file_no", F.monotonically_increasing_id())
    files, files_dir = stage(numbered, "settlement-files")
    rules = settlement_rules()
    readable = files.filter("reference_date IS NOT NULL AND problem IS NULL").select("file", "file_no", "header")
    for column in SETTLEMENT_COLUMNS:
        readable = readable.filter(F.array_contains("header", column))
    lines = read_by_name(readable, folder, SETTLEMENT_COLUMNS, glob, recursive)
    rows, rows_dir = stage(_parse(lines, rules), "settlement-rows")
    # Files in which a quoted field goes on over a line break are read again, by record.
    broken = rows.filter("_open").select("file_no").distinct()
    broken_dir = None
    if not broken.isEmpty():
        again = read_records(readable.join(broken, "file_no", "left_semi"), folder, SETTLEMENT_COLUMNS, glob, recursive)
        whole, broken_dir = stage(_parse(again, rules), "settlement-records")
        rows = rows.join(whole.select("file_no").distinct(), "file_no", "left_anti").unionByName(whole)
    repeated, repeated_dir = stage(_repeated(rows), "settlement-repeated")
    verdicts, verdicts_dir = stage(_verdicts(files, rows, repeated, rules), "settlement-verdicts")

    accepted = verdicts.filter(F.size("reasons") == 0).select(
        "file_no", "name", "reference_date", "duplicates"
    )
    # One row per calendar date.
    per_date = accepted.groupBy("reference_date").agg(
        F.count("*").alias("files"), F.sum("duplicates").alias("duplicates")
    ).collect()
    if per_date:
        if any(d.duplicates for d in per_date):
            rows = _last_in_file(rows, repeated)
        incoming = rows.join(accepted.drop("duplicates"), "file_no").select(
            *SETTLEMENT_COLUMNS,
            F.current_timestamp().alias("_loaded_at"),
            F.col("name").alias("_source_file"),
            "reference_date",
        )
        if any(d.files > 1 for d in per_date):
            incoming = last_per_key(incoming, KEYS, [F.col("_source_file").desc()])
        store.upsert(TABLE, incoming, KEYS, touched=[d.reference_date for d in per_date])
    delete_path(spark, files_dir)
    for folder_of in (rows_dir, broken_dir, repeated_dir):
        if folder_of:
            delete_path(spark, folder_of)
    logger.info("verdicts of %s written to %s", folder, verdicts_dir)
    return verdicts


def load_directory(
    store: Store, folder: str, dates: DatePattern, glob: str = "*.csv", recursive: bool = False
) -> dict[str, int]:
    """Rows loaded per accepted file. Rejected files are logged and left out."""
    loaded: dict[str, int] = {}
    found = False
    for v in judge_and_load(store, folder, dates, glob, recursive).toLocalIterator():
        found = True
        for warning in v.warnings:
            logger.warning("%s: %s", v.name, warning)
        if v.reasons:
            logger.error("%s skipped: %s", v.name, "; ".join(v.reasons))
        else:
            loaded[v.name] = v.loaded
    if not found:
        logger.warning("no files matching %r in %s", glob, folder)
    return loaded


def load_file(store: Store, path: str, reference_date: str) -> int:
    """Load one file; a reason against it raises ValueError."""
    if not path_exists(store.spark, path):
        raise FileNotFoundError(f"settlement file not found: {path}")
    place = store.spark._jvm.org.apache.hadoop.fs.Path(path)
    name, parent = place.getName(), place.getParent()
    # The name stands for itself, whatever signs of a pattern it holds.
    literal = re.sub(r"([\\*?\[\]{}^,])", r"\\\1", name)
    folder = parent.toString() if parent and parent.toString() else "."
    verdict = judge_and_load(store, folder, lambda _: reference_date, glob=literal).first()
    if verdict is None:
        raise ValueError(f"{name}: not among the files of {folder}")
    for warning in verdict.warnings:
        logger.warning("%s: %s", name, warning)
    if verdict.reasons:
        raise ValueError(f"{name}: {'; '.join(verdict.reasons)}")
    return verdict.loaded


def rows_by_file(settlements: DataFrame) -> DataFrame:
    return settlements.groupBy("_source_file").agg(F.count("*").alias("rows"))
