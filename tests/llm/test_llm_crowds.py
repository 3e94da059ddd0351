"""Near-duplicates where one trie node is crowded by texts that are alike, but not alike enough."""

import random

import numpy as np
import pytest

from tallyspark.llm import simhash


def template_texts(n, alike=12):
    """Texts on one template, of resemblance about 0.77 to each other, and near copies of the first ones."""
    rnd = random.Random(4)
    template = [f"t{i}" for i in range(100)]
    texts = [" ".join(template + [f"u{k}x{rnd.random()}" for _ in range(15)]) for k in range(n)]
    return texts + [f"{t} more" for t in texts[:alike]]


@pytest.fixture
def tables(monkeypatch):
    """Rows of each table that is written."""
    rows, write = {}, simhash.written

    def counted(df, label):
        out = write(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "written", counted)
    return rows


def test_crowds_tell_no_pairs(spark, tables):
    n = 900
    texts = template_texts(n)
    frame = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, id long, text string")
    got = {r["row"]: r["group_row"] for r in simhash.near_duplicates(frame, seeds=2).collect()}
    # What is still apart after the nearest pairs was a table of all pairs.
    assert max(k for label, k in tables.items() if label in ("rest", "links")) < 4 * n, tables
    assert [got[i] for i in range(n)] == list(range(n))


@pytest.mark.parametrize("block,chunk", [(1000, 20_000), (7, 20_000), (7, 11)])
def test_crowds_in_blocks_equal_all_pairs(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(simhash, "NEAR_ROWS", chunk)
    texts = template_texts(60)
    frame = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, id long, text string")
    got = {r["row"]: r["group_row"] for r in simhash.near_duplicates(frame).collect()}
    assert got == {i: i if i < 60 else i - 60 for i in range(72)}


def test_overlaps_count_common_elements():
    rnd = np.random.default_rng(2)
    some = [np.unique(np.r_[rnd.integers(0, 3000, rnd.integers(0, 90)), np.arange(rnd.integers(0, 40))]).astype("<u4") for _ in range(90)]
    got = simhash.overlaps(some[:40], some[40:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in some[40:]] for a in some[:40]]
    assert simhash.overlaps(some[:1], [np.empty(0, "<u4")]).tolist() == [[0]]


def test_unlike_texts_of_one_block_are_no_candidates(spark):
    # All in one node of the trie: of 80,000 pairs about a hundred passed the test of a single further fingerprint.
    rnd = np.random.default_rng(7)
    n = 400
    v, after, later = rnd.integers(-(1 << 63), (1 << 63) - 1, (3, n))
    v = v & ((1 << 48) - 1)
    rows = [(0, int(v[i]), int(after[i]), int(later[i]), i) for i in range(n)]
    rows.append((0, int(v[0]) ^ 7, int(after[0]) ^ 7, int(later[0]) ^ 7, n))
    units = spark.createDataFrame(rows, "unit long, v long, next long, later long, node long")
    pairs = {(r["a"], r["b"]) for r in simhash._unit_pairs(units, simhash.CANDIDATE_BITS).where("b >= 0").collect()}
    assert (0, n) in pairs and len(pairs) < 20, len(pairs)


def test_crowds_are_dealt_out_once(spark, monkeypatch):
    dealt, bands = [], simhash._bands
    monkeypatch.setattr(simhash, "_bands", lambda *a: dealt.append(1) or bands(*a))
    texts = template_texts(60)
    frame = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, id long, text string")
    got = {r["row"]: r["group_row"] for r in simhash.near_duplicates(frame).collect()}
    assert got == {i: i if i < 60 else i - 60 for i in range(72)}
    assert len(dealt) == 1
