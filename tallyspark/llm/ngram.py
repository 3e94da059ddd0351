"""Language-model scores by word pairs in Elias-Fano tries."""

from __future__ import annotations

import math
import tempfile
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, with_text, written

#: Weight of the word alone against its context, in observations (Dirichlet prior).
PRIOR = 40.0
#: Steps in which a decade of a pair's count is told apart, always rounded down, so that the probabilities of all
#: successors never add up to more than one. 16 bits reach beyond 2^63; one code stands for a pair that never occurred.
STEPS, ABSENT = 3000, 65535
#: Characters of a chunk of documents, whose distinct words and pairs are asked for once.
CHUNK_CHARS = 8_000_000
#: Distinct words, and running words, that a shard is meant to hold of all chunks.
SHARD_WORDS, SHARD_TOKENS = 1_000_000, 1_500_000

# Neither can be a word, as words hold no white space.
END, START = b"\n", b"\n\n"
CONTEXT_BITS, SUCCESSOR_BITS = 48, 40


# Whole numbers in few bytes


def packed(values: np.ndarray) -> bytes:
    """Byte planes of the least width, compressed."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


# Elias-Fano

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _r, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _SELECT[_b, _r] = _p


class EliasFano:
    """An ascending sequence: low bits as they are, high bits in unary, with a count of ones before each 64-bit word."""

    def __init__(self, low: np.ndarray, high: np.ndarray, before: np.ndarray, bits: int):
        self.low, self.high, self.before, self.bits = low, high, before, bits

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        width = (bits + 7) // 8
        low = (values & np.uint64((1 << bits) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width].copy()
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        length = (int(at[-1]) + 2 if n else 1) + 64
        unary = np.zeros(-(-length // 64) * 64, np.uint8)
        unary[at] = 1
        high = np.packbits(unary, bitorder="little")
        ones = _ONES[high].reshape(-1, 8).sum(1, dtype=np.int64)
        return cls(low, high, np.concatenate(([0], np.cumsum(ones))), bits)

    def _place(self, nth: np.ndarray, zeros: bool) -> np.ndarray:
        """Position of the nth one or zero in the unary part."""
        before = 64 * np.arange(len(self.before)) - self.before if zeros else self.before
        word = np.searchsorted(before, nth, "right") - 1
        word = np.minimum(word, len(before) - 2)
        rest = nth - before[word]
        octets = self.high.reshape(-1, 8)[word]
        if zeros:
            octets = ~octets
        counts = np.cumsum(_ONES[octets], 1, dtype=np.int64)
        byte = (counts <= rest[:, None]).sum(1)
        byte = np.minimum(byte, 7)
        line = np.arange(len(byte))
        rest = rest - counts[line, byte] + _ONES[octets[line, byte]]
        return word * 64 + byte * 8 + _SELECT[octets[line, byte], rest]

    def lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.low.shape[1]] = self.low[at]
        return out.view("<u8").reshape(-1)

    def get(self, at: np.ndarray) -> np.ndarray:
        upper = (self._place(at, False) - at).astype(np.uint64)
        return upper << np.uint64(self.bits) | self.lows(at)

    def find(self, values: np.ndarray, lo: np.ndarray | None = None, hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Place of the successor of each value within lo..hi, and whether it is the value itself.

        The unary part gives the run of elements with the same high bits; their low bits are searched by halving.
        """
        n = len(self.low)
        upper = (values >> np.uint64(self.bits)).astype(np.int64)
        most = 64 * (len(self.before) - 1) - int(self.before[-1])  # zeros there are
        known = upper < most - 1
        capped = np.where(known, upper, 0)
        begin = np.where(capped > 0, self._place(np.maximum(capped - 1, 0), True) + 1 - capped, 0)
        end = self._place(capped, True) - capped
        begin, end = np.where(known, begin, n), np.where(known, end, n)
        if lo is not None:
            begin, end = np.maximum(begin, lo), np.minimum(end, hi)
        stop = end.copy()
        wanted = values & np.uint64((1 << self.bits) - 1)
        open_ = np.flatnonzero(begin < end)
        while len(open_):
            middle = (begin[open_] + end[open_]) // 2
            less = self.lows(middle) < wanted[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[begin[open_] < end[open_]]
        inside = begin < stop
        hit = np.zeros(len(values), bool)
        some = np.flatnonzero(inside)
        hit[some] = self.lows(begin[some]) == wanted[some]
        return begin, hit


class Trie:
    """Contexts, pointers to their successors, successors relative to their context, and a code for each.

    Successor s of the context of number i is the element i * 2^40 + s, so that one ascending sequence holds the sorted
    successors of all contexts, and a search stays within the range that the pointers give.
    """

    ARRAYS = ("low", "high", "before")
    LEVELS = ("contexts", "pointers", "successors")

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @classmethod
    def build(cls, context: np.ndarray, successor: np.ndarray, codes: np.ndarray) -> Trie:
        """From pairs in ascending order without repeats."""
        starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.empty(0, np.int64)
        number = np.repeat(np.arange(len(starts), dtype=np.uint64), np.diff(np.r_[starts, len(context)]))
        return cls(
            EliasFano.of(context[starts]),
            EliasFano.of(np.r_[starts, len(context)].astype(np.uint64)),
            EliasFano.of(number << np.uint64(SUCCESSOR_BITS) | successor),
            codes.astype(np.uint16),
        )

    def save(self, folder: str) -> None:
        np.save(f"{folder}/codes.npy", self.codes)
        for name in self.LEVELS:
            level = getattr(self, name)
            for part in self.ARRAYS:
                np.save(f"{folder}/{name}.{part}.npy", getattr(level, part))
            Path(f"{folder}/{name}.bits").write_text(str(level.bits))

    @classmethod
    def open(cls, folder: str) -> Trie:
        """The saved trie, its levels mapped into memory."""
        load = lambda name: np.load(f"{folder}/{name}.npy", mmap_mode="r")
        levels = [
            EliasFano(*(load(f"{name}.{part}") for part in cls.ARRAYS), int(Path(f"{folder}/{name}.bits").read_text()))
            for name in cls.LEVELS
        ]
        return cls(*levels, load("codes"))

    def lookup(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes of pairs that are in order of their contexts."""
        if not len(self.codes) or not len(context):
            return np.full(len(context), ABSENT, np.uint16)
        starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        size = np.diff(np.r_[starts, len(context)])
        at, hit = self.contexts.find(context[starts])
        at = np.where(hit, at, 0)
        lo, hi = self.pointers.get(at).astype(np.int64), self.pointers.get(at + 1).astype(np.int64)
        hi = np.where(hit, hi, lo)
        each = lambda x: np.repeat(x, size)
        values = each(at.astype(np.uint64)) << np.uint64(SUCCESSOR_BITS) | successor
        place, found = self.successors.find(values, each(lo), each(hi))
        return np.where(found, self.codes[np.where(found, place, 0)], ABSENT).astype(np.uint16)


# Chunks of documents


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words in lower case (A-Z alone), split at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _chunks(docs: DataFrame, held: str, id_column: str, text_column: str) -> DataFrame:
    """A row for each chunk: ids, which are held out, tokens per document, distinct tokens with counts, and the sequence.

    Tokens are numbered by falling count within the chunk, so that most numbers are small. `seq` and `rest` hold the
    numbers below 255, and those from there on.
    """
    frame, name = with_text(docs, [id_column, held], text_column)
    kind = T.StructType.fromDDL(
        "chunk long, n_tokens long, n_words long, n_train long, held binary, lengths binary, vocab binary, counts binary, seq binary, rest binary"
    )
    schema = T.StructType([*kind.fields, T.StructField("ids", T.ArrayType(docs.schema[id_column].dataType))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        id_type = None

        def fresh() -> tuple[defaultdict, list, list, list, list]:
            index: defaultdict = defaultdict()
            index.default_factory = index.__len__
            index[END]
            return index, [], [], [], []

        def told() -> pa.RecordBatch:
            token = np.concatenate(parts)
            lengths = np.array([len(p) for p in parts], np.int64)
            train = np.repeat(np.array(out) == 0, lengths)
            total, learnt = np.bincount(token, minlength=len(index)), np.bincount(token[train], minlength=len(index))
            order = np.argsort(-total, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            token = rank[token]
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), np.uint64, len(index))
            binary = {
                "held": np.array(out, np.uint8).tobytes(), "lengths": packed(lengths), "vocab": hashes[order].tobytes(),
                "counts": packed(learnt[order]), "seq": packed(np.minimum(token, 255)), "rest": packed(token[token >= 255]),
            }
            longs = {"chunk": task << 32 | number, "n_tokens": len(token), "n_words": len(index), "n_train": int(train.sum())}
            columns = [pa.array([v], pa.int64()) for v in longs.values()] + [pa.array([v], pa.binary()) for v in binary.values()]
            columns.append(pa.array([ids], pa.list_(id_type)))
            return pa.RecordBatch.from_arrays(columns, names=[*longs, *binary, "ids"])

        index, parts, out, ids, chars = *fresh()[:4], 0
        for part, texts in slices(batches, name):
            id_type = part.schema.field(id_column).type
            for text, key, is_out in zip(texts, part.column(id_column).to_pylist(), part.column(held).to_pylist()):
                words = words_of(text)
                words.append(END)
                parts.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                out.append(int(bool(is_out)))
                ids.append(key)
                chars += len(text)
                if chars >= CHUNK_CHARS:
                    yield told()
                    index, parts, out, ids, chars, number = *fresh()[:4], 0, number + 1
        if parts:
            yield told()

    return frame.mapInArrow(run, schema)


class Chunk:
    """A chunk row read back: tokens numbered by the order of their hashes, and its distinct pairs by shard."""

    def __init__(self, row: dict):
        hashes = np.frombuffer(row["vocab"], np.uint64)
        order = np.argsort(hashes)
        self.vocab, self.counts = hashes[order], unpacked(row["counts"]).astype(np.int64)[order] if row.get("counts") else None
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        token = unpacked(row["seq"]).astype(np.int64)
        token[token == 255] = unpacked(row["rest"]).astype(np.int64)  # these are written in full
        self.token = rank[token]
        self.lengths = unpacked(row["lengths"]).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)

    def pairs(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs in order of shard and context: shard, context hash, successor in it, count; pair of each token."""
        before = np.roll(self.token, 1)
        n = len(self.vocab)
        before[self.starts] = n
        distinct, of = np.unique(before * (n + 1) + self.token, return_inverse=True)
        train = ~np.repeat(self.held, self.lengths)
        count = np.bincount(of[train], minlength=len(distinct))
        known = np.r_[self.vocab, np.uint64(xxhash.xxh64_intdigest(START))]
        context, word = known[distinct // (n + 1)], known[distinct % (n + 1)]
        both = _mixed(context + _mixed(word))
        shard = (both % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return shard[order], (context >> np.uint64(64 - CONTEXT_BITS))[order], (both >> np.uint64(64 - SUCCESSOR_BITS))[order], count[order], rank[of]


def _bounds(sorted_values: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(sorted_values, np.arange(n + 1))


def _word_counts(chunks: DataFrame, shards: int) -> DataFrame:
    """(chunk, kind 0, shard, data, known): counts over all chunks of each chunk's words, in order of their hashes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.frombuffer(row["vocab"], np.uint64)
                order = np.argsort(hashes)
                hashes, counts = hashes[order], unpacked(row["counts"])[order]
                cuts = np.searchsorted(hashes, np.array([(i << 64) // shards for i in range(1, shards)], np.uint64))
                cuts = [0, *cuts.tolist(), len(hashes)]
                some = [i for i in range(shards) if cuts[i + 1] > cuts[i]]
                blobs = [(hashes[cuts[i] : cuts[i + 1]].tobytes(), packed(counts[cuts[i] : cuts[i + 1]])) for i in some]
                columns = [pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(some, pa.int32())]
                columns += [pa.array([b[k] for b in blobs], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "shard", "hashes", "counts"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        hashes = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        counts = np.concatenate([unpacked(x) for x in table["counts"].to_pylist()])
        distinct, of = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, of, counts.astype(np.int64))
        ends = np.cumsum([len(h) for h in hashes])
        told = [packed(total[of[a:b]]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        n = len(told)
        return pa.table({
            "chunk": table["chunk"], "kind": pa.array([0] * n, pa.int32()), "shard": table["shard"],
            "data": pa.array(told, pa.binary()), "known": pa.array([int((total > 0).sum())] * n, pa.int64()),
        })

    dealt = chunks.select("chunk", "vocab", "counts").mapInArrow(deal, "chunk long, shard int, hashes binary, counts binary")
    return dealt.groupBy("shard").applyInArrow(add, "chunk long, kind int, shard int, data binary, known long")


def _pair_codes(chunks: DataFrame, shards: int) -> DataFrame:
    """(chunk, kind 1, shard, data, known 0): codes of each chunk's pairs, from the shard's trie."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, context, successor, count, _ = Chunk(row).pairs(shards)
                cuts = _bounds(shard, shards).tolist()
                some = [i for i in range(shards) if cuts[i + 1] > cuts[i]]
                parts = [slice(cuts[i], cuts[i + 1]) for i in some]
                columns = [pa.array([row["chunk"]] * len(some), pa.int64()), pa.array(some, pa.int32())]
                columns.append(pa.array([packed(np.diff(context[p], prepend=np.uint64(0))) for p in parts], pa.binary()))
                columns.append(pa.array([packed(successor[p]) for p in parts], pa.binary()))
                columns.append(pa.array([packed(count[p]) for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "shard", "context", "successor", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        contexts = [np.cumsum(unpacked(x), dtype=np.uint64) for x in table["context"].to_pylist()]
        successors = [unpacked(x) for x in table["successor"].to_pylist()]
        context, successor = np.concatenate(contexts), np.concatenate(successors)
        count = np.concatenate([unpacked(x) for x in table["counts"].to_pylist()]).astype(np.int64)
        seen = np.flatnonzero(count)
        order = seen[np.lexsort((successor[seen], context[seen]))]
        context, successor, count = context[order], successor[order], count[order]
        fresh = np.r_[True, (context[1:] != context[:-1]) | (successor[1:] != successor[:-1])] if len(order) else np.empty(0, bool)
        first = np.flatnonzero(fresh)
        total = np.add.reduceat(count, first) if len(first) else count
        codes = np.floor(np.log10(total) * STEPS)
        with tempfile.TemporaryDirectory() as folder:
            Trie.build(context[first], successor[first], codes).save(folder)
            trie = Trie.open(folder)
            told = [packed(trie.lookup(c, s)) for c, s in zip(contexts, successors)]
            del trie
        n = len(told)
        return pa.table({
            "chunk": table["chunk"], "kind": pa.array([1] * n, pa.int32()), "shard": table["shard"],
            "data": pa.array(told, pa.binary()), "known": pa.array([0] * n, pa.int64()),
        })

    needed = chunks.select("chunk", "vocab", "held", "lengths", "seq", "rest")
    dealt = needed.mapInArrow(deal, "chunk long, shard int, context binary, successor binary, counts binary")
    return dealt.groupBy("shard").applyInArrow(answer, "chunk long, kind int, shard int, data binary, known long")


def ngram_scores(docs: DataFrame, held: str = "held_out", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Scores of all texts by a model of words and word pairs learnt from the rows that are not held out.

    `held` names a boolean column (null: not held out). Result: id, held_out, n_tokens, n_known, train_tokens, base_score
    (words alone, add-one) and score, the log10 probability of the text under
    p(word | context) = (c(context, word) + PRIOR * p(word)) / (c(context) + PRIOR), where p(word) is the add-one
    probability, the context is the word before or the start of the text, and c(context, word) is quantised, rounded down.

    Pairs are dealt to shards by a hash of the whole pair, so no frequent word or pair makes a shard large. A shard is
    an Elias-Fano trie in a temporary file that its task maps into memory, asks for the pairs of every chunk, and drops.
    Nothing that grows with the corpus reaches the driver. A successor is told apart by 40 bits within its context.

    A null or empty text is its end token alone. Repeated rows count as often as they occur; null ids are allowed.
    """
    spark = docs.sparkSession
    marked = docs.select(F.col(f"`{id_column}`"), F.coalesce(F.col(f"`{held}`"), F.lit(False)).alias("_held"), F.col(f"`{text_column}`"))
    chunks = written(_chunks(marked, "_held", id_column, text_column), "chunks")
    size = chunks.agg(F.sum("n_train").alias("n"), F.sum("n_words").alias("w"), F.sum("n_tokens").alias("t")).first()
    n, least = int(size["n"] or 0), 2 * spark.sparkContext.defaultParallelism
    word_shards = max(least, math.ceil((size["w"] or 0) / SHARD_WORDS))
    pair_shards = max(least, math.ceil((size["t"] or 0) / SHARD_TOKENS))
    words = written(_word_counts(chunks, word_shards), "words")
    distinct = words.groupBy("shard").agg(F.max("known").alias("k")).agg(F.sum("k")).first()[0] or 0
    codes = _pair_codes(chunks, pair_shards)
    floor = float(n + distinct + 1)

    kind = T.StructType.fromDDL("n_tokens long, n_known long, train_tokens long, base_score double, score double")
    schema = T.StructType(
        [T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("held_out", T.BooleanType()), *kind.fields]
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        chunk = Chunk(row)
        answers = right.sort_by([("kind", "ascending"), ("shard", "ascending")]).select(["kind", "data"]).to_pylist()
        count = np.concatenate([unpacked(a["data"]) for a in answers if a["kind"] == 0]).astype(np.float64)
        code = np.concatenate([unpacked(a["data"]) for a in answers if a["kind"] == 1])
        *_, pair = chunk.pairs(pair_shards)
        alone = (count + 1) / floor
        ends = count[np.searchsorted(chunk.vocab, np.uint64(xxhash.xxh64_intdigest(END)))]
        before = np.roll(chunk.token, 1)
        context = count[before]
        context[chunk.starts] = ends  # as many texts began as ended
        own = code[pair]
        seen = np.where(own == ABSENT, 0.0, 10.0 ** (own / STEPS))
        p = (seen + PRIOR * alone[chunk.token]) / (context + PRIOR)
        total = lambda x: np.add.reduceat(x, chunk.starts)
        return pa.table({
            id_column: left["ids"].combine_chunks().flatten(), "held_out": pa.array(chunk.held), "n_tokens": pa.array(chunk.lengths),
            "n_known": pa.array(total((count > 0)[chunk.token].astype(np.int64))), "train_tokens": pa.array(np.full(len(chunk.held), n)),
            "base_score": pa.array(total(np.log10(alone)[chunk.token])), "score": pa.array(total(np.log10(p))),
        })

    needed = chunks.select("chunk", "vocab", "held", "lengths", "seq", "rest", "ids")
    return needed.groupBy("chunk").cogroup(words.union(codes).groupBy("chunk")).applyInArrow(score, schema)
