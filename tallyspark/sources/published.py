"""Tables whose partitions are written aside and become visible by one rename."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: A partition column that is derived from another one; readers of a store do not see it.
PERIOD = "period"
#: Name of the folders of publications, which no column of a table may have.
PUBLICATION = "_publication"


def partition_text(value) -> str:
    """A partition value as it stands in a folder name."""
    if value is None:
        return NULL_PARTITION
    return value.isoformat() if isinstance(value, datetime.date) else str(value)


class Published:
    """A parquet table below ``path`` with one version per publication.

    The files of a publication go to a folder of their own; a manifest then says which folders make up each partition.
    It is written aside and renamed to its number, and only then do readers see the new version. A writer that dies
    before leaves the last version as it was; one that dies after has published. Files of partitions that are not
    replaced are never touched, so they keep their names, and a frame that was read keeps reading its version while a
    new one is written from it. One writer at a time; a second one that reaches the same number fails at the rename.

    A manifest has one entry per partition and publication that added to it. Partition columns are calendar periods,
    so it stays as small as the calendar.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- files -------------------------------------------------------------------------

    def _fs(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        names = (n.removesuffix(".json") for n in self._names("manifest") if n.endswith(".json"))
        return sorted(int(n) for n in names if n.isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default the newest one."""
        if version is None:
            version = max(self.versions())
        fs, path = self._fs(f"manifest/{version}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        fs, aside = self._fs(f"manifest/_{uuid.uuid4().hex}")
        stream = fs.create(aside)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        _, final = self._fs(f"manifest/{version}.json")
        if fs.exists(final) or not fs.rename(aside, final):
            raise RuntimeError(f"version {version} of {self.path} was published by another writer")

    # --- reading and writing -----------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """A version, by default the newest one; filters on the partition column choose folders."""
        manifest = self.manifest(version)
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [f"{self.path}/files/{v}/{part}".rstrip("/") for part, vs in manifest["parts"].items() for v in vs]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/files")
        return reader.parquet(*folders).select(*(F.col(f"`{c}`") for c in schema.names))

    def partitions(self) -> list[str]:
        """Values of the partition column that have rows, as text."""
        return sorted(part.split("=", 1)[1] for part in self.manifest()["parts"] if part) if self.exists() else []

    def publish(
        self, df: DataFrame, by: str | None = None, replaced: Iterable | None = None, append: bool = False
    ) -> int:
        """Put ``df`` in place of the partitions it has and of those in ``replaced``; returns the new version's number.

        With ``append`` its rows are added to its partitions. Without ``by`` it takes the place of the whole table.
        A partition in ``replaced`` that ``df`` does not have is gone afterwards.
        """
        versions = self.versions()
        number = max(versions, default=0) + 1
        parts = self.manifest()["parts"] if versions and by else {}
        folder = f"{PUBLICATION}={number}-{uuid.uuid4().hex[:8]}"
        if by:
            df.hint("rebalance", by).write.option("compression", "zstd").partitionBy(by).parquet(f"{self.path}/files/{folder}")
        else:
            df.write.option("compression", "zstd").parquet(f"{self.path}/files/{folder}")
        for value in replaced or ():
            parts.pop(f"{by}={partition_text(value)}", None)
        found = [n for n in self._names(f"files/{folder}") if by and n.startswith(f"{by}=")] if by else [""]
        for part in found:
            parts[part] = [*(parts.get(part, []) if append else []), folder]
        self._commit(number, {"version": number, "by": by, "schema": json.loads(df.schema.json()), "parts": parts})
        return number

    def vacuum(self, keep: int = 2) -> int:
        """Delete folders that none of the newest ``keep`` versions has, and older manifests; returns their number."""
        versions = self.versions()
        used = {(v, p) for n in versions[-keep:] for p, vs in self.manifest(n)["parts"].items() for v in vs}
        gone = 0
        for folder in self._names("files"):
            has = self._names(f"files/{folder}")
            if not any(v == folder for v, _ in used):
                dead = [f"files/{folder}"]
            else:
                dead = [f"files/{folder}/{p}" for p in has if "=" in p and (folder, p) not in used]
            for name in dead:
                fs, path = self._fs(name)
                gone += bool(fs.delete(path, True))
        for n in versions[:-keep]:
            fs, path = self._fs(f"manifest/{n}.json")
            fs.delete(path, False)
        return gone
