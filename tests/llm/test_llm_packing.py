import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyspark.llm.common import written
from tallyspark.llm.packing import best_fit_decreasing, pack, windows

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def one_by_one(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing, an item at a time."""
    windows: list[list[int]] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [w for w in windows if capacity - sum(w) >= length]
            if fits:
                max(fits, key=sum).append(length)
            else:
                windows.append([length])
    return windows


def unfolded(placed: np.ndarray, windows: int, counts: dict[int, int]) -> list[list[int]]:
    out, seen = [[] for _ in range(windows)], defaultdict(set)
    for length, item, items, first, per, offset in placed.tolist():
        for k in range(items):
            assert item + k not in seen[length]
            seen[length].add(item + k)
            out[first + k // per].append((offset + k % per * length, length))
    assert {k: len(v) for k, v in seen.items()} == {k: v for k, v in counts.items() if v}
    for window in out:
        at = 0
        for offset, length in sorted(window):
            assert offset == at
            at += length
    return [[length for _, length in w] for w in out]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 12), max_size=10), st.integers(24, 40))
def test_runs_fill_windows_as_single_items_do(counts, capacity):
    placed, windows = best_fit_decreasing(counts, capacity)
    got = unfolded(placed, windows, counts)
    # Windows of equal room are interchangeable, so it is their fill that must agree.
    assert sorted(map(sum, got)) == sorted(map(sum, one_by_one(counts, capacity)))


def test_many_items_take_few_steps():
    rnd = random.Random(1)
    counts = {n: rnd.randint(1, 10**9) for n in range(1, 1025)}
    placed, windows = best_fit_decreasing(counts, 1024)
    assert len(placed) < 20_000
    assert int(placed[:, 2].sum()) == sum(counts.values())
    assert windows * 1024 * 0.98 < sum(k * v for k, v in counts.items())


def test_pieces_hold_every_id_once(docs, clashing, no_docs):
    exact = Tokenizer.from_file(PATH)
    exact.encode_special_tokens = True
    for ranks in (RANKS, None):
        rows = pack(docs, PATH, ranks, 256, keep=["doc_id", "text"]).collect()
        whole = defaultdict(list)
        for r in rows:
            ids = np.array(exact.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
            piece = ids[r["start"] : r["start"] + r["length"]]
            assert bytes(r["ids"]) == piece.tobytes() and zlib.crc32(piece.tobytes()) == r["ids_crc32"]
            assert r["doc_tokens"] == len(ids)
            whole[r["sequence_id"]].append((r["offset"], r["length"]))
        for pieces in whole.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 256
        assert sorted(whole) == list(range(len(whole)))
        assert sum(r["start"] == 0 for r in rows) == docs.count()
    assert pack(clashing, PATH, RANKS, 256).where("start = 0").count() == docs.count()
    assert pack(no_docs, PATH, RANKS, 256).collect() == []


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_windows_hold_the_ids_of_their_pieces(spark, docs, clashing, no_docs, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        for frame in (docs, docs.union(docs).union(docs)):
            pieces = written(pack(frame, PATH, RANKS, 256, keep=["doc_id"]), "test")
            want = defaultdict(list)
            for r in pieces.collect():
                want[r["sequence_id"]].append((r["offset"], r["doc_id"], r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])))
            rows = windows(pieces).collect()
            assert len(rows) == len(want)
            for r in rows:
                told = sorted(want[r["sequence_id"]], key=lambda x: x[0])
                assert bytes(r["ids"]) == b"".join(x[-1] for x in told) and len(r["ids"]) == 4 * r["n_tokens"] <= 1024
                assert [(p["offset"], p["doc_id"], p["start"], p["length"], p["doc_tokens"]) for p in r["pieces"]] == [x[:-1] for x in told]
        assert windows(pack(clashing, PATH, RANKS, 256)).agg(F.sum(F.size("pieces"))).first()[0] >= docs.count()
        assert windows(pack(no_docs, PATH, RANKS, 256)).collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
