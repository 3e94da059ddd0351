"""Byte-level BPE over rank files: segment tree of pair ranks, encoding and decoding."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import beside, schema_with, slices

#: Words of up to this many bytes are merged many at a time, longer ones one by one.
BATCH_BYTES = 256
#: A worker forgets the words it knows beyond this many.
KNOWN_WORDS = 1 << 18

_SHIFT = 32
_NONE = 1 << 62

# Letters, digits and white space of Latin-1, for the faster split of texts that hold nothing else.
_LETTER = "".join(chr(c) for c in range(256) if regex.match(r"\p{L}", chr(c)))
_DIGIT = "".join(chr(c) for c in range(256) if regex.match(r"\p{N}", chr(c)))
_SPACE = "".join(chr(c) for c in range(256) if regex.match(r"\p{White_Space}", chr(c)))


def latin_pattern(pattern: str) -> re.Pattern:
    """The pattern for Latin-1 texts, its Unicode classes written out as characters."""
    classes = {r"\p{L}": _LETTER, r"\p{N}": _DIGIT, r"\s": _SPACE}
    plain = {k: "".join(re.escape(c) for c in v) for k, v in classes.items()}
    plain[r"\S"] = "^" + plain[r"\s"]
    out, in_class, i = [], False, 0
    while i < len(pattern):
        name = next((k for k in plain if pattern.startswith(k, i)), None)
        if name:
            out.append(plain[name] if in_class else f"[{plain[name]}]")
            i += len(name)
            continue
        in_class = pattern[i] == "[" or (in_class and pattern[i] != "]")
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


class Vocabulary:
    """Ranks of byte strings, with the tables that merging needs."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            entries = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in entries}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 24 | right] = rank
        self.pair_rank = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        # White space as Unicode has it, without the information separators.
        self.any_text = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.latin_text = latin_pattern(pattern)
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.any_text.findall(text)
        return self.latin_text.findall(text)

    def lookup(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tree leaves of pairs: rank above position, or nothing."""
        keys = left << 24 | right
        found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[found] == keys, self.pair_ranks[found] << _SHIFT | at, _NONE)

    def merge_batch(self, words: list[bytes], size: int) -> list[bytes]:
        """Packed ids of words of at most `size` bytes (a power of two).

        Every word has a segment tree over its byte positions; a leaf holds the rank of the pair that starts there, and
        a node the least rank below it, leftmost first. A step takes the root of each unfinished tree, joins that pair
        and updates three leaves: the joined one, the one that vanished and the live neighbour before.
        """
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        place = np.arange(size)
        token = self.byte_ids[np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)]
        after = np.repeat((place + 1)[None, :], n, 0)
        before = np.repeat((place - 1)[None, :], n, 0)
        alive = place[None, :] < length[:, None]
        tree = np.full((n, 2 * size), _NONE, np.int64)
        row, at = np.nonzero(place[None, :] + 1 < length[:, None])
        tree[row, size + at] = self.lookup(token[row, at], token[row, at + 1], at)
        half = size
        while half > 1:
            half //= 2
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while live.size:
            root = tree[live, 1]
            at, rank = root & ((1 << _SHIFT) - 1), root >> _SHIFT
            gone = after[live, at]
            follows = after[live, gone]
            token[live, at] = rank
            after[live, at] = follows
            alive[live, gone] = False
            has = follows < length[live]
            before[live[has], follows[has]] = at[has]
            previous = before[live, at]
            tree[live, size + gone] = _NONE
            tree[live, size + at] = np.where(
                has, self.lookup(rank, token[live, np.minimum(follows, size - 1)], at), _NONE
            )
            led = previous >= 0
            some = live[led]
            tree[some, size + previous[led]] = self.lookup(token[some, previous[led]], rank[led], previous[led])
            nodes = [size + at, size + gone, size + np.maximum(previous, 0)]
            for _ in range(size.bit_length() - 1):
                nodes = [node >> 1 for node in nodes]
                for node in nodes:
                    tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
            live = live[tree[live, 1] < _NONE]
        packed = token[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.sum(1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long word, with plain lists."""
        n = len(word)
        size = 1 << max(1, (n - 1).bit_length())
        token = [int(self.byte_ids[b]) for b in word]
        after, before, pairs = list(range(1, n + 1)), list(range(-1, n - 1)), self.pair_rank
        tree = [_NONE] * (2 * size)

        def leaf(at: int) -> int:
            follows = after[at]
            rank = pairs.get(token[at] << 24 | token[follows]) if follows < n else None
            return _NONE if rank is None else rank << _SHIFT | at

        for at in range(n - 1):
            tree[size + at] = leaf(at)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        alive = bytearray(b"\1") * n
        while tree[1] < _NONE:
            at, rank = tree[1] & ((1 << _SHIFT) - 1), tree[1] >> _SHIFT
            gone = after[at]
            token[at], after[at], alive[gone] = rank, after[gone], 0
            if after[at] < n:
                before[after[at]] = at
            tree[size + gone] = _NONE
            tree[size + at] = leaf(at)
            if before[at] >= 0:
                tree[size + before[at]] = leaf(before[at])
            for node in (size + at, size + gone, size + max(before[at], 0)):
                node >>= 1
                while node:
                    tree[node] = min(tree[2 * node], tree[2 * node + 1])
                    node >>= 1
        return np.array([t for t, a in zip(token, alive) if a], "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Adds the ids of words to those known."""
        known, sizes = self.known, {}
        for word in words:
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                known[word] = rank.to_bytes(4, "little")
            elif len(raw) > BATCH_BYTES:
                known[word] = self.merge_long(raw)
            else:
                sizes.setdefault(1 << max(2, (len(raw) - 1).bit_length()), []).append((word, raw))
        for size, group in sizes.items():
            step = max(1, (1 << 20) // size)
            for i in range(0, len(group), step):
                part = group[i : i + step]
                known.update(zip([w for w, _ in part], self.merge_batch([r for _, r in part], size)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (unsigned 32 bit, little endian) of each text."""
        split = [self.split(text) for text in texts]
        new = set().union(*split) - self.known.keys() if split else set()
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {}
            new = set().union(*split)
        self.learn(list(new))
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, text_column: str = "text") -> DataFrame:
    """The kept columns (default: all but the text) with n_tokens and ids.

    `path` is a rank file that every executor can open, `pattern` splits a text before merging. `ids` packs the ids as
    unsigned 32-bit little-endian integers. No special tokens. A null or empty text has no ids; rows are kept as often
    as they occur, and columns of the input named n_tokens or ids are left out of the default. Texts are encoded whole;
    a word without a break, of any length, costs a logarithmic update per merge.
    """
    new = "n_tokens long, ids binary"
    keep = [c for c in docs.columns if c not in (text_column, "n_tokens", "ids")] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for part, texts in slices(batches, text_column):
            ids = words.encode(texts)
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield beside(part, keep, n_tokens=counts, ids=pa.array(ids, pa.binary()))

    columns = list(dict.fromkeys([*keep, text_column]))
    return docs.select(*(f"`{c}`" for c in columns)).mapInArrow(run, schema_with(docs, keep, new))


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all but the ids) with the bytes that the ids stand for; null ids give no bytes."""
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [words.decode(x or b"") for x in part.column("ids").to_pylist()]
                yield beside(part, keep, decoded=pa.array(texts, pa.binary()))

    columns = list(dict.fromkeys([*keep, "ids"]))
    return encoded.select(*(f"`{c}`" for c in columns)).mapInArrow(run, schema_with(encoded, keep, "decoded binary"))
