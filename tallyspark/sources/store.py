"""Parquet tables below one root folder: full replace, append, upsert, prerequisites."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyspark.session import fresh_dir
from tallyspark.sources.published import PERIOD, Published


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a result to the shared folder and read it back, which cuts its lineage.

    Returns the frame and the folder, for delete_path once nothing reads it any more.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Partition values up to this number are put into a plan as literals, which prune by themselves.
LITERAL_PARTITIONS = 2000


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def in_partitions(df: DataFrame, partition: str, touched: DataFrame | Sequence) -> DataFrame:
    """Rows of ``df`` in the partitions that ``touched`` names, the NULL partition included.

    ``touched`` is a list of values, or a frame that has the partition column. Few values
    become literals; many are joined, so that neither plan nor driver grows with them.
    """
    if isinstance(touched, DataFrame):
        values = touched.select(partition).distinct()
        few = values.limit(LITERAL_PARTITIONS + 1).collect()
        if len(few) > LITERAL_PARTITIONS:
            return df.join(values.alias("touched"), same_keys(df, values, [partition]), "left_semi")
        touched = [r[0] for r in few]
    known = [v for v in touched if v is not None]
    chosen = F.col(partition).isin(known) if known else F.lit(False)
    if len(known) < len(touched):
        chosen = F.coalesce(chosen, F.lit(False)) | F.col(partition).isNull()
    return df.filter(chosen)


class Store:
    """Named tables as parquet folders. Spark enforces no keys on them; the loaders check."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def require(self, *names: str) -> None:
        missing = [n for n in names if not self.exists(n)]
        if missing:
            raise RuntimeError(f"not loaded yet: {', '.join(missing)}")

    def published(self, name: str) -> Published:
        return Published(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        """A table, or the newest version of one that is published by version."""
        published = self.published(name)
        return published.read().drop(PERIOD) if published.exists() else self.spark.read.parquet(self.path(name))

    def publish(
        self, name: str, df: DataFrame, by: str | None = None, replaced: Iterable | None = None, append: bool = False
    ) -> int:
        """Publish partitions by one rename, see ``Published.publish``."""
        return self.published(name).publish(df, by, replaced, append)

    def register(self, *names: str) -> None:
        """Make tables available to spark.sql under their names."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
        return self.read(name)

    def take(self, name: str, staged: DataFrame, folder: str) -> DataFrame:
        """As ``replace`` by a staged frame, by renaming its folder; its rows are copied only where that cannot be done."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (folder, self.path(name)))
        fs = target.getFileSystem(conf)
        if not fs.getUri().equals(source.getFileSystem(conf).getUri()):
            return self.replace(name, staged)
        fs.mkdirs(target.getParent())
        delete_path(self.spark, self.path(name))
        if not fs.rename(source, target):
            return self.replace(name, staged)
        self.spark.catalog.refreshByPath(self.path(name))
        return self.read(name)

    def replace_partitions(self, name: str, df: DataFrame, partition: str) -> DataFrame:
        """Replace the partitions that occur in ``df``, leave the others alone.

        ``df`` must not read the table itself; stage it first if it does. Rebalancing gives
        a small partition one file and splits a large one over several writers.
        """
        (
            df.hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(self.path(name))
        )
        return self.read(name)

    def upsert(
        self,
        name: str,
        incoming: DataFrame,
        keys: Sequence[str],
        partition: str = "reference_date",
        touched: Sequence | None = None,
    ) -> None:
        """Insert or replace by key, touching only the partitions that ``incoming`` has.

        ``incoming`` holds each key once. Rows of a touched partition that are not sent
        again stay. Repeating the call gives the same table, so a job that died halfway
        is simply run again. One writer at a time. ``touched`` are the partition values of
        ``incoming``, where the caller knows them and can save the job that finds them.
        NULL is a value like any other, as a key and as a partition.
        """
        if not self.exists(name):
            self.replace_partitions(name, incoming, partition)
            return
        stored = in_partitions(self.read(name), partition, incoming if touched is None else touched)
        sent = incoming.select(*[F.col(k).alias(k) for k in keys])
        kept = stored.join(sent, same_keys(stored, sent, keys), "left_anti")
        merged, staged = stage(incoming.unionByName(kept), f"upsert-{name}")
        self.replace_partitions(name, merged, partition)
        delete_path(self.spark, staged)
