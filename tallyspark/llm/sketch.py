"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import beside, schema_with, slices, written
from .histogram import range_of, split_points

#: Cells of each of the three tables of a fingerprint; a failed comparison is tried again with four times as many.
CELLS = 8
GROWTH = 4
#: A paragraph (a line) is cut at the ends of sentences, a sentence into stretches of so many characters.
STRETCH = 32
#: The beginning of a text is also cut into short stretches, so that a text of a few words has several.
HEAD_CHARS = 64
HEAD_STRETCH = 4

_PIECES = re.compile(rf"[^.!?\n]{{1,{STRETCH}}}[.!?\n]*|[.!?\n]+")
_digest = xxhash.xxh64_intdigest


def digests(text: str) -> np.ndarray:
    """One digest for each piece of the paragraphs; the n-th repeat of a piece has a digest of its own."""
    seen: dict[str, int] = {}
    out = []
    head = [text[i : i + HEAD_STRETCH] for i in range(0, min(len(text), HEAD_CHARS), HEAD_STRETCH)]
    for piece in head + _PIECES.findall(text):
        nth = seen.get(piece, 0)
        seen[piece] = nth + 1
        out.append(_digest(piece.encode("utf-8", "surrogatepass"), nth))
    return np.array(out, np.uint64)


def _mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketch:
    """Sketches of many texts side by side: per cell a count, the XOR of its digests and the XOR of their checks."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * 3 * cells, np.int64)
        self.key = np.zeros(n * 3 * cells, np.uint64)
        self.check = np.zeros(n * 3 * cells, np.uint32)

    def places(self, owner: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(self.cells)
        return [(owner * 3 + t) * self.cells + (_mixed(keys, 3 * self.cells + t) % size).astype(np.int64) for t in range(3)]

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        checks = checked(keys)
        for at in self.places(owner, keys):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, keys)
            np.bitwise_xor.at(self.check, at, checks)

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(self.n, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """Digests recovered for each text, and whether that was all of them. Uses the sketch up.

        A cell with a count of one and a fitting check holds a single digest, which is taken out of its three cells;
        that may leave others single. All texts are peeled at the same time.
        """
        recovered = np.zeros(self.n, np.int64)
        while True:
            pure = np.flatnonzero(np.abs(self.count) == 1)
            pure = pure[self.check[pure] == checked(self.key[pure])]
            if not len(pure):
                break
            owner, table, keys, sign = pure // (3 * self.cells), pure // self.cells % 3, self.key[pure], self.count[pure]
            places = self.places(owner, keys)
            # A digest may be single in several of its cells: the first one counts.
            first = np.ones(len(pure), bool)
            for t in range(2):
                at = places[t]
                again = (np.abs(self.count[at]) == 1) & (self.key[at] == keys) & (self.check[at] == checked(keys))
                first &= ~(again & (table > t))
            # A cell outside the digest's own three can only look single by a wrong check.
            first &= np.choose(table, places) == pure
            if not first.any():
                break
            owner, keys, sign = owner[first], keys[first], sign[first]
            self.add(owner, keys, -sign)
            recovered += np.bincount(owner, minlength=self.n)
        rest = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return recovered, ~rest.reshape(self.n, -1).any(1)

    def texts(self, sizes: np.ndarray) -> list[str]:
        """Each sketch as text: the number of digests, then counts, digests and checks of its cells, in base 64."""
        width = 3 * self.cells
        head, counts = sizes.astype("<u4"), self.count.astype("<i4").reshape(-1, width)
        keys, checks = self.key.astype("<u8").reshape(-1, width), self.check.astype("<u4").reshape(-1, width)
        return [
            base64.b64encode(head[i].tobytes() + counts[i].tobytes() + keys[i].tobytes() + checks[i].tobytes()).decode()
            for i in range(self.n)
        ]


def checked(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 77) >> np.uint64(32)).astype(np.uint32)


def sketches(parts: list[np.ndarray], cells: int = CELLS) -> Sketch:
    out = Sketch(len(parts), cells)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    out.add(owner, np.concatenate(parts) if parts else np.empty(0, np.uint64))
    return out


def likeness(left: list[np.ndarray], right: list[np.ndarray], a: Sketch, b: Sketch) -> np.ndarray:
    """Shared digests by all digests of each two texts, from the differences that peeling recovers.

    `a` and `b` are their fingerprints. Pairs that do not peel wholly are tried again with larger sketches until they do.
    Two texts without digests are alike (1).
    """
    sizes = np.array([len(x) + len(y) for x, y in zip(left, right)], np.int64)
    differing, open_, cells = np.zeros(len(left), np.int64), np.arange(len(left)), CELLS
    while len(open_):
        recovered, whole = a.minus(b).peel()
        differing[open_[whole]] = recovered[whole]
        open_ = open_[~whole]
        cells *= GROWTH
        a, b = sketches([left[i] for i in open_], cells), sketches([right[i] for i in open_], cells)
    return np.where(sizes == 0, 1.0, (sizes - differing) / np.maximum(sizes + differing, 1))


def order_keys(id_column: str, text_column: str) -> dict[str, Column]:
    """Non-negative long columns that ascend as the id descends; null ids come last, equal ids go by a hash of the text."""
    key = F.col(id_column).cast("long")
    return {
        "_k1": F.coalesce(F.lit((1 << 31) - 1) - F.shiftright(key, 32), F.lit(1 << 33)),
        "_k2": F.coalesce(F.lit(0xFFFFFFFF) - key.bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(0)),
        "_k3": F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))), 2),
    }


def _heads(spark: SparkSession, firsts: list[tuple[int, tuple]]) -> DataFrame:
    """(part, keys of the document that follows the part's last one), a row per part that has documents."""
    rows = [(part, *firsts[(i + 1) % len(firsts)][1]) for i, (part, _) in enumerate(firsts)]
    return spark.createDataFrame(rows, "_part int, _k1 long, _k2 long, _k3 long")


def followed(docs: DataFrame, keep: list[str], id_column: str, text_column: str, part_bytes: int) -> tuple[DataFrame, list[str], int]:
    """Documents in parts of descending id, each part closed by a copy of the document that comes after it (`_ahead` 1).

    Exact byte counts give the boundaries of the parts, so the texts move once and no part is larger than the others.
    Only the first key of each part comes to the driver.
    """
    keys = order_keys(id_column, text_column)
    names = list(keys)
    keyed = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_column}`").alias("_text"), *(c.alias(k) for k, c in keys.items()))
    narrow = written(keyed.select(*names, (F.coalesce(F.octet_length("_text"), F.lit(0)) + 64).cast("long").alias("_w")), "order")
    total = narrow.agg(F.sum("_w")).first()[0] or 0
    wanted = max(-(-total // part_bytes), 4 * docs.sparkSession.sparkContext.defaultParallelism)
    splitters, _, _ = split_points(narrow, names, "_w", int(min(wanted, 4096)), tolerance=0.25)
    part = range_of(names, splitters).cast("int")
    firsts = narrow.groupBy(part.alias("_part")).agg(F.min(F.struct(*names)).alias("f")).orderBy("_part").collect()
    placed = keyed.withColumn("_part", part).withColumn("_ahead", F.lit(0))
    if not firsts:
        return placed, names, 1
    heads = _heads(docs.sparkSession, [(r["_part"], tuple(r["f"])) for r in firsts])
    ahead = keyed.join(F.broadcast(heads), names).dropDuplicates(["_part"]).withColumn("_ahead", F.lit(1))
    return placed.unionByName(ahead), names, len(splitters) + 1


def fingerprints(
    docs: DataFrame, keep: list[str] | None = None, id_column: str = "doc_id", text_column: str = "text", part_bytes: int = 16 << 20
) -> DataFrame:
    """The kept columns (default: all but the text) with the fingerprint of each text and of its edited version.

    The edited text is the text whose last floor(n_chars / 3) code points give way to the first as many (or all) of the
    next document by descending id; after the last comes the first again. Result columns: n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next, the likeness to the edited text and to the next document
    (shared by all paragraph digests, 0 to 1).

    A null text is an empty one; two empty texts are alike (1). Null ids come last and equal ids go by a hash of the
    text, so that the order is the same in every run; rows equal in both are interchangeable. A single document follows
    itself. Columns named like a result column or an inner one are left out of the default.
    """
    new = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    inner = ("_text", "_part", "_ahead", *order_keys(id_column, text_column))
    keep = [c for c in docs.columns if c not in new and c not in inner and c != text_column] if keep is None else keep
    rows, names, parts = followed(docs, keep, id_column, text_column, part_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[pa.RecordBatch, str, np.ndarray] | None = None
        for part, texts in slices(batches, "_text"):
            prints = [digests(t) for t in texts]
            if last:
                part = pa.Table.from_batches([last[0], part]).combine_chunks().to_batches()[0]
                texts, prints = [last[1], *texts], [last[2], *prints]
            last = part.slice(part.num_rows - 1), texts[-1], prints[-1]
            own = np.flatnonzero(part.column("_ahead").to_numpy()[:-1] == 0)
            if not len(own):
                continue
            edited = []
            for i in own.tolist():
                n = len(texts[i]) // 3
                edited.append(texts[i][: len(texts[i]) - n] + texts[i + 1][:n])
            mine, changed, after = [prints[i] for i in own], [digests(t) for t in edited], [prints[i + 1] for i in own]
            a, b, c = sketches(mine), sketches(changed), sketches(after)
            yield beside(
                part.take(pa.array(own)), keep,
                n_chars=pa.array([len(texts[i]) for i in own], pa.int64()),
                edited_sha256=pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                fingerprint=pa.array(a.texts(np.array([len(x) for x in mine]))),
                edited_fingerprint=pa.array(b.texts(np.array([len(x) for x in changed]))),
                near_edited=pa.array(likeness(mine, changed, a, b)),
                near_next=pa.array(likeness(mine, after, a, c)),
            )

    sorted_rows = rows.repartitionById(parts, F.col("_part")).sortWithinPartitions("_part", "_ahead", *names, "_text")
    ddl = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_rows.mapInArrow(run, schema_with(rows, keep, ddl))
