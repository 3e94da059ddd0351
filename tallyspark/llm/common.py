"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import fresh_dir
from tallyspark.sources.store import delete_path

#: Rows of one Arrow batch are handed on in slices of about this many characters, so that
#: a run of very long texts does not fill a worker.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that `written` makes inside are deleted at the end; what is to last is staged inside by other means."""
    paths: list[str] = []
    token = _SCRATCH.set(paths)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            delete_path(spark, path)


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: lineage is cut and every executor can reread it."""
    path = fresh_dir(df.sparkSession, label)
    if (paths := _SCRATCH.get()) is not None:
        paths.append(path)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text modulo n; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of the batches with their texts; a null text is the empty one."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > SLICE_CHARS:
                part = batch.slice(start, i - start)
                yield part, [t or "" for t in part.column(column).to_pylist()]
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, [t or "" for t in part.column(column).to_pylist()]


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_text(docs: DataFrame, keep: list[str], text_column: str) -> tuple[DataFrame, str]:
    """The kept columns and the text, and the name that the text has there; it is carried once."""
    if text_column in keep:
        return docs.select(*(F.col(f"`{c}`") for c in keep)), text_column
    name = "_text"
    while name in keep:
        name = f"_{name}"
    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_column}`").alias(name)), name


def beside(part: pa.RecordBatch, keep: list[str], **columns: pa.Array) -> pa.RecordBatch:
    """The kept columns of a part together with new ones."""
    names = [*keep, *columns]
    return pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *columns.values()], names=names)


def schema_with(df: DataFrame, keep: list[str], new: str):
    """Schema of the kept columns followed by new ones in DDL."""
    from pyspark.sql import types as T

    added = T.StructType.fromDDL(new)
    return T.StructType([*(df.schema[k] for k in keep), *added.fields])
