"""Streams of change logs and settlements into tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators.cdc import last_per_key
from tallyspark.sources.store import Store, delete_path, in_partitions, stage


def file_stream(
    spark: SparkSession, folder: str, schema: str, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _start(writer, every: str | None) -> StreamingQuery:
    """Every ``every`` (such as "5 minutes"), or once over all that has arrived."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def append_stream(
    stream: DataFrame, table: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep all versions: append to a parquet table, exactly once by its commit log."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return _start(writer.option("path", table).option("checkpointLocation", checkpoint), every)


def batch_stream(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle)
    return _start(writer.option("checkpointLocation", checkpoint), every)


def upsert_handler(
    store: Store, table: str, keys: Sequence[str], newest_first: Sequence[str], partition: str = "reference_date"
) -> Callable[[DataFrame, int], None]:
    """Micro-batch upsert. A batch that is run again after a failure changes nothing."""

    def handle(batch: DataFrame, _: int) -> None:
        order = [F.col(c).desc_nulls_last() for c in newest_first]
        incoming, folder = stage(last_per_key(batch, keys, order), "stream-batch")
        store.upsert(table, incoming, keys, partition)
        delete_path(store.spark, folder)

    return handle


def merge_changes_handler(
    store: Store,
    table: str,
    key: str,
    newest_first: Sequence[str],
    partition: Column | None = None,
    buckets: int = 64,
) -> Callable[[DataFrame, int], None]:
    """Keep the latest change of every key, deletes included; readers drop the deletes.

    An older change that arrives late does not replace a newer one: stored and incoming
    changes are ranked together, in the partitions the batch touches and nowhere else.
    ``partition`` must not change over the life of a key. The creation date is the best
    choice where changes carry it, as most changes concern recent rows; without it keys
    are spread over hash buckets, of which a large batch touches all.
    """
    if partition is None:
        partition = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def handle(batch: DataFrame, _: int) -> None:
        order = [F.col(c).desc_nulls_last() for c in newest_first]
        incoming, folder = stage(
            last_per_key(batch, [key], order).withColumn("bucket", partition), "stream-changes"
        )
        if store.exists(table):
            stored = in_partitions(store.read(table), "bucket", incoming)
            merged, merged_dir = stage(
                last_per_key(stored.unionByName(incoming), [key], order), "stream-merged"
            )
            store.replace_partitions(table, merged, "bucket")
            delete_path(store.spark, merged_dir)
        else:
            store.replace_partitions(table, incoming, "bucket")
        delete_path(store.spark, folder)

    return handle
