"""Best-fit-decreasing packing of token sequences into windows of a fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import beside, schema_with, slices, with_text, written

#: Id that ends every document.
END = 0

#: Counts of lengths per task that are sent to every executor at most (about 20 MB).
BROADCAST_ROWS = 1_000_000

PIECE = "start long, length int, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def _tokenizer(path: str, ranks: str | None):
    """Texts to arrays of ids, by the tokenizers library or by the same vocabulary's ranks."""

    @lru_cache(maxsize=1)
    def exact():
        """Loaded when it is first needed: with ranks that is rarely, and it takes 30 MB in each worker."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def slow(text: str) -> np.ndarray:
        return np.array(exact().encode(text, add_special_tokens=False).ids, "<u4")

    if ranks is None:
        return slow

    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # its pattern engine gives up on some very long runs of white space
            return slow(text)

    return ids


def cut(
    docs: DataFrame, text_column: str, path: str, ranks: str | None, capacity: int, keep: list[str], with_ids: bool
) -> DataFrame:
    """Pieces of at most `capacity` ids, with their task (`_part`) and their number there among equal lengths (`_nth`)."""
    extra = ", ids binary" if with_ids else ""
    chosen, name = with_text(docs, keep, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = _tokenizer(path, ranks), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for part, texts in slices(batches, name):
            row, start, length, crc, whole, nth, raw = [], [], [], [], [], [], []
            for i, text in enumerate(texts):
                ids = np.append(encode(text), np.uint32(END)).astype("<u4", copy=False)
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    packed = piece.tobytes()
                    row.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(packed))
                    whole.append(len(ids))
                    nth.append(seen[len(piece)])
                    seen[len(piece)] += 1
                    if with_ids:
                        raw.append(packed)
            columns = {
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int32()),
                "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(whole, pa.int64()),
            }
            columns |= {"ids": pa.array(raw, pa.binary())} if with_ids else {}
            columns |= {"_part": pa.array([task] * len(row), pa.int32()), "_nth": pa.array(nth, pa.int64())}
            yield beside(part.take(pa.array(row, pa.int64())), keep, **columns)

    return chosen.mapInArrow(run, schema_with(docs, keep, f"{PIECE}{extra}, _part int, _nth long"))


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: how many leaves below a node have open windows."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.node = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, remaining: int, first: int, count: int) -> None:
        if not count:
            return
        self.runs[remaining].append((first, count))
        if len(self.runs[remaining]) == 1:
            self._change(remaining, 1)

    def take(self, remaining: int) -> tuple[int, int]:
        run = self.runs[remaining].pop()
        if not self.runs[remaining]:
            self._change(remaining, -1)
        return run

    def _change(self, remaining: int, by: int) -> None:
        at = self.size + remaining
        while at:
            self.node[at] += by
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """Least remaining capacity of an open window that is at least `length`."""
        at = self.size + length
        if self.node[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.node[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.node[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Where best-fit decreasing puts the items of each length, and the number of windows.

    Items of one length differ only in their number, and windows of one history only in theirs, so both are handled in
    runs: with r the tightest remaining capacity, a window of r takes r // length items one after the other before
    another window becomes tighter. The steps depend on the lengths that occur, not on how many items there are.
    Rows of the result: length, first item, items, first window, items per window, offset of the first in its window.
    """
    tree, placed, windows = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, n = 0, counts[length]
        while done < n:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, per = capacity, capacity // length
                first, count = windows, -(-(n - done) // per)
                windows += count
            else:
                (first, count), per = tree.take(remaining), remaining // length
            full = min(count, (n - done) // per)
            if full:
                placed.append((length, done, full * per, first, per, capacity - remaining))
                tree.add(remaining - per * length, first, full)
                done += full * per
            rest = min(n - done, per) if full < count else 0
            if rest:
                placed.append((length, done, rest, first + full, per, capacity - remaining))
                tree.add(remaining - rest * length, first + full, 1)
                done += rest
            left = full + (rest > 0)
            tree.add(remaining, first + left, count - left)
    return np.array(placed, np.int64).reshape(-1, 6), windows


def pack(
    docs: DataFrame,
    path: str,
    ranks: str | None = None,
    capacity: int = 1024,
    keep: list[str] | None = None,
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of the tokenised documents with the window (sequence_id) and the offset that best-fit decreasing gives them.

    `path` is a tokenizer file that every executor can open; `ranks`, where given, is a rank file of the same vocabulary
    and yields the same ids faster. A document is its ids (no special tokens) and a final 0; a null or empty text is the
    final 0 alone. Documents over the capacity are cut into full windows and a rest. A window is filled without gaps
    from offset 0. Repeated rows are packed as often as they occur; equal lengths are told apart by their place in the
    written table of pieces. Kept columns (default: all but the text) named like a result column are left out.

    Only the number of pieces of each length, at most `capacity` numbers, comes to the driver. Their placement is a
    table that is as small whatever the number of documents; the pieces themselves never move but to be numbered.
    """
    spark = docs.sparkSession
    own = ["start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset", "_part", "_nth", "_text"]
    keep = [c for c in docs.columns if c not in own and c != text_column] if keep is None else keep
    pieces = written(cut(docs, text_column, path, ranks, capacity, keep, with_ids), "pieces", codec="zstd")

    by_part = written(pieces.groupBy("_part", "length").agg(F.count("*").alias("_n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    placed, _ = best_fit_decreasing(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("_part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # A row per task and length that occurs there: where these are few, the pieces need not move to meet them.
    if by_part.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    ranked = pieces.join(offsets, ["_part", "length"]).withColumn("_rank", F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_before")

    lookup = spark.sparkContext.broadcast(placed)  # bounded by the capacity, see best_fit_decreasing
    names = [*keep, *(f.name for f in T.StructType.fromDDL(PIECE).fields), *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = lookup.value
        starts = rows[:, 0] << 44 | rows[:, 1]
        order = np.argsort(starts)
        rows, starts = rows[order], starts[order]
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            rank = batch.column("_rank").to_numpy()
            found = rows[np.searchsorted(starts, length << 44 | rank, "right") - 1]
            nth = rank - found[:, 1]
            yield beside(
                batch,
                names,
                sequence_id=pa.array(found[:, 3] + nth // found[:, 4]),
                offset=pa.array(found[:, 5] + nth % found[:, 4] * length),
            )

    return ranked.mapInArrow(place, schema_with(ranked, names, "sequence_id long, offset long"))


def windows(pieces: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id, n_tokens, their ids without padding (little-endian, four bytes each), and
    `pieces`, all other columns of each piece in order of offset.

    `pieces` is the result of `pack` with ids; each of them moves once, to its window. A task puts windows together
    batch by batch: pieces in order of window and offset lie one after the other, so a window's ids are a stretch of
    the batch's bytes. A window holds at most its capacity, however many documents are alike. No pieces, no windows.
    """
    told = [c for c in pieces.columns if c not in ("ids", "sequence_id", "ids_crc32")]
    inner = T.StructType([pieces.schema[c] for c in told])
    schema = T.StructType.fromDDL("sequence_id long, n_tokens int, ids binary").add("pieces", T.ArrayType(inner, False))

    def whole(part: pa.RecordBatch) -> pa.RecordBatch:
        number, length = part.column("sequence_id").to_numpy(), part.column("length").to_numpy().astype(np.int64)
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        tokens = np.add.reduceat(length, starts)
        ids = part.column("ids")
        begin, *_ = np.frombuffer(ids.buffers()[1], np.int32, 1, 4 * ids.offset)
        ends = begin + 4 * np.r_[0, np.cumsum(tokens)]
        stretches = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), ids.buffers()[2]])
        items = pa.StructArray.from_arrays([part.column(c) for c in told], names=told)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(number)].astype(np.int32)), items)
        columns = [pa.array(number[starts], pa.int64()), pa.array(tokens.astype(np.int32)), stretches, lists]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            number = batch.column("sequence_id").to_numpy()
            last = int(np.searchsorted(number, number[-1]))  # the last window may go on in the next batch
            if last:
                yield whole(batch.slice(0, last))
            rest = batch.slice(last)
        if rest is not None:
            yield whole(rest)

    moved = pieces.drop("ids_crc32").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return moved.mapInArrow(assemble, schema)
