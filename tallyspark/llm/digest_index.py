"""Exact duplicates through a persistent index of text digests, bucketed and sorted by digest."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import fresh_dir
from tallyspark.sources.store import delete_path, path_exists

from .common import written

#: Characters that do not count when texts are compared: space, and tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
#: Rows a bucket is laid out for; at about 60 bytes each a bucket is sorted in memory.
BUCKET_ROWS = 2_000_000
#: A group of at least this part of all rows is heavy, so there are at most as many heavy groups.
HEAVY_PART = 1000


def digested(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, row, digest, n_chars), written once: SHA-256 of the text without blanks, code points of the whole text.

    A null text is the empty one. `row` numbers the rows, so that repeated rows can be told apart.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    bare = F.translate(text, BLANKS, "")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(bare.cast("binary"), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("n_chars"),
    )
    return written(rows, "digested")


class DigestIndex:
    """Digests of all texts seen so far, as a table in `path`: partitioned by batch, bucketed and sorted by digest.

    A batch is reduced to one row per digest in the map tasks, laid out in the index's own buckets, and then meets the
    index in sort-merge joins for which neither side moves again: the anti-join finds new digests, which are appended
    as `first`; known ones are appended as further sightings. Each batch is one partition, so a batch that died is
    simply added again, and what it wrote before is replaced. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        about = spark.read.parquet(f"{self.path}/about").first()
        self.buckets, self.id_type = about["buckets"], about["id_type"]
        self.table = "digests_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]
        best = f"struct<less: bigint, no_id: boolean, id: {self.id_type}, batch: string, row: bigint>"
        spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        spark.sql(
            f"CREATE TABLE {self.table} (digest binary, first boolean, rows bigint, best {best}, batch string) USING parquet "
            f"PARTITIONED BY (batch) {self._clustered()} LOCATION '{self.path}/digests'"
        )
        if path_exists(spark, f"{self.path}/digests"):
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def _clustered(self) -> str:
        return f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"

    @classmethod
    def create(cls, spark: SparkSession, path: str, expected_rows: int, id_type: str = "bigint") -> DigestIndex:
        """A new, empty index, laid out for so many rows; more rows make larger buckets, see `compacted`."""
        buckets = max(8, 1 << max(0, -(-expected_rows // BUCKET_ROWS) - 1).bit_length())
        about = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(id_type).alias("id_type"))
        about.write.parquet(f"{path.rstrip('/')}/about")
        return cls(spark, path)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _laid_out(self, fresh: DataFrame) -> tuple[DataFrame, str]:
        """The frame as a table in the index's buckets, and the name of the table."""
        path = fresh_dir(self.spark, "digest-batch")
        name = "batch_" + path.rsplit("-", 1)[1]
        dealt = fresh.repartition(self.buckets, "digest")
        dealt.write.bucketBy(self.buckets, "digest").sortBy("digest").option("path", path).saveAsTable(name)
        return self.spark.table(name), name

    def add(self, rows: DataFrame, batch: str) -> None:
        """Add a batch of `digested` rows: its new digests by anti-join, its known ones as sightings."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"a batch is named by letters, digits, _ and -, not {batch!r}")
        best = F.struct(
            (-F.col("n_chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", F.lit(batch).alias("batch"), "row"
        )
        fresh = rows.groupBy("digest").agg(F.count("*").alias("rows"), F.min(best).alias("best"))
        sent, name = self._laid_out(fresh)
        known = self.rows().where(F.col("first") & (F.col("batch") != batch)).select("digest").hint("merge")
        new = sent.join(known, "digest", "left_anti").withColumn("first", F.lit(True))
        again = sent.join(known, "digest", "left_semi").withColumn("first", F.lit(False))
        out = new.unionByName(again).select("digest", "first", "rows", "best", F.lit(batch).alias("batch"))
        self._drop(batch)
        out.write.insertInto(self.table)
        self.spark.sql(f"DROP TABLE {name}")

    def _drop(self, batch: str) -> None:
        """Take away what a run of this batch that died may have left."""
        delete_path(self.spark, f"{self.path}/digests/batch={batch}")
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (batch = '{batch}')")

    def groups(self) -> DataFrame:
        """(digest, best, group_size) over all batches; the index's buckets spare the exchange."""
        return self.rows().groupBy("digest").agg(F.min("best").alias("best"), F.sum("rows").alias("group_size"))

    def compacted(self, path: str) -> DigestIndex:
        """A new index with one row per digest, in buckets for the present number of rows."""
        other = DigestIndex.create(self.spark, path, self.rows().where("first").count(), self.id_type)
        one = self.groups().select("digest", F.lit(True).alias("first"), F.col("group_size").alias("rows"), "best", F.lit("base").alias("batch"))
        dealt = one.repartition(other.buckets, "digest").sortWithinPartitions("digest")
        dealt.write.insertInto(other.table)
        return other

    def label(self, rows: DataFrame, batch: Column) -> DataFrame:
        """Rows of added batches with digest, keep_id, group_size and kept; `batch` is the one a row came with.

        Rows of heavy groups, of which there are at most `HEAVY_PART`, take their group from a broadcast and do not
        move. All others are joined on the digest in the index's buckets, each group being less than a thousandth.
        """
        groups = self.groups()
        total = self.rows().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        # At most HEAVY_PART rows, as group sizes add up to the total.
        heavy = F.broadcast(written(groups.where(F.col("group_size") * HEAVY_PART >= total), "heavy"))
        tagged = rows.select("id", "row", "digest", batch.alias("batch"))
        found = tagged.join(heavy, "digest").unionByName(
            tagged.join(heavy.select("digest"), "digest", "left_anti").join(groups.hint("merge"), "digest")
        )
        own = (F.col("best.batch") == F.col("batch")) & (F.col("best.row") == F.col("row"))
        return found.select("id", "row", "digest", F.col("best.id").alias("keep_id"), "group_size", own.alias("kept"))


def exact_duplicates(
    docs: DataFrame, index: DigestIndex | None = None, batch: Column | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every document, after adding the documents to the index.

    Texts are equal if they are identical without `BLANKS`. Of equal texts the row with the most code points in the
    original text stays, then that of the smallest id; a null id is the last, and of rows that are wholly alike one
    stays. Earlier batches of the index count: the row that stays may be one of theirs, and `group_size` counts theirs.
    `batch` names the batch of a row (at most a few; each is added on its own, in order of name), by default one.

    A null text is the empty one, and equal to texts of blanks only. Texts of any length are hashed whole. Columns other
    than id and text are not read, so their names do not matter. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    label = F.lit("all") if batch is None else F.coalesce(batch.cast("string"), F.lit("none"))
    named = docs.select(
        F.struct(F.col(f"`{id_column}`").alias("id"), label.alias("batch")).alias("key"), F.col(f"`{text_column}`").alias("text")
    )
    rows = digested(named, "key").select(F.col("id.batch").alias("_batch"), F.col("id.id").alias("id"), "row", "digest", "n_chars")
    if index is None:
        index = DigestIndex.create(spark, fresh_dir(spark, "digest-index"), rows.count(), rows.schema["id"].dataType.simpleString())
    for (name,) in sorted(rows.select("_batch").distinct().collect()):
        index.add(rows.where(F.col("_batch") == name), name)
    labelled = index.label(rows, F.col("_batch"))
    return labelled.select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
