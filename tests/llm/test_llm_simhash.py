import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import simhash
from tallyspark.llm.components import components


def plain_groups(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_fingerprint_by_hand():
    text = "One two  THREE\nfour é"
    shingles = ["one two three", "two three four", "three four é"]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    assert simhash.shingle_hashes(text, 3).tolist() == hashes
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 3)
    assert simhash.simhash(simhash.shingle_hashes(text, 3)) % (1 << 64) == want
    assert simhash.simhash(simhash.shingle_hashes(" \n", 3)) == 0
    assert simhash.shingle_hashes("Two words", 3).tolist() == [xxhash.xxh64_intdigest(b"two words", 42)]


@pytest.mark.parametrize("unit_rows", [500, 3])
@pytest.mark.parametrize("budget", [0, 1, 3])
def test_links_equal_all_pairs(spark, monkeypatch, unit_rows, budget):
    # Small units force the division of crowded nodes, down to the last bits.
    monkeypatch.setattr(simhash, "UNIT_ROWS", unit_rows)
    rnd = random.Random(unit_rows + budget)
    values = {0, -1}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(25):
            v = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 5)):
                v ^= 1 << bit
            values.add(v - (1 << 64) if v >= 1 << 63 else v)
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash.trie_links(frame, budget).collect()
    want = plain_groups(values, lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= budget)
    got = {k: k for k in values}
    for r in components(spark.createDataFrame(links or [(0, 0)], "a long, b long")).collect():
        got[r["node"]] = r["root"]
    assert got == want


def test_trie_pairs_finds_each_pair_once():
    rnd = np.random.default_rng(3)
    value = np.sort(rnd.integers(0, 1 << 20, 400).astype(np.uint64) << np.uint64(44))
    x, y = simhash.trie_pairs(value, np.array([[0, 400, 0, 400, 0, 0]]), 3)
    found = {(int(a), int(b)) for a, b in zip(x, y)}
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if int(value[i] ^ value[j]).bit_count() <= 3}
    assert found == want and len(x) == len(found)


def test_awkward_rows(docs, clashing, no_docs):
    rows = simhash.simhash_groups(docs, keep=["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    prints = {(r["text"] or ""): r["fp"] for r in rows}
    for text, fp in prints.items():
        assert fp == simhash.simhash(simhash.shingle_hashes(text, 3))
    groups = plain_groups(sorted(set(prints.values())), lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 3)
    for r in rows:
        mine = [x["doc_id"] for x in rows if groups[x["fp"]] == groups[r["fp"]] and x["doc_id"] is not None]
        assert r["component_id"] == min(mine, default=None)
    assert simhash.simhash_groups(clashing).count() == docs.count()
    assert simhash.simhash_groups(no_docs).collect() == []


def near_texts():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randint(30, 120))]
        for _ in range(rnd.randint(1, 5)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            texts.append(" ".join(copy))
    crowd = [rnd.choice(words) for _ in range(100)]
    for _ in range(60):
        copy = list(crowd)
        copy[rnd.randrange(100)] = rnd.choice(words)
        texts.append(" ".join(copy))
    return texts + texts[:5] + ["", "one two", "ONE  two", None, " "]


@pytest.mark.parametrize("run_rows", [512, 8])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, run_rows):
    monkeypatch.setattr(simhash, "RUN_ROWS", run_rows)
    texts = near_texts()
    frame = spark.createDataFrame([(i, 1000 - i, t) for i, t in enumerate(texts)], "row long, id long, text string")
    got = {r["row"]: r["group_row"] for r in simhash.near_duplicates(frame).collect()}
    sets = [frozenset(simhash.shingle_hashes(t or "", 5).tolist()) for t in texts]

    def alike(a, b):
        x, y = sets[a], sets[b]
        return x == y or (x and y and len(x & y) >= 0.8 * len(x | y))

    want = plain_groups(range(len(texts)), alike)
    members = {}
    for k, v in want.items():
        members.setdefault(v, []).append(k)
    # The least id is that of the last row.
    assert got == {k: max(members[want[k]]) for k in want}


def test_near_duplicates_of_nothing_and_of_null_ids(spark):
    empty = spark.createDataFrame([], "row long, id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    rows = spark.createDataFrame([(0, None, "a b c d e f"), (1, 5, "a b c d e f"), (2, None, "z")], "row long, id long, text string")
    assert {r["row"]: r["group_row"] for r in simhash.near_duplicates(rows).collect()} == {0: 1, 1: 1, 2: 2}


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    hub = [(100, i) for i in range(101, 140)]
    rows = spark.createDataFrame(chain + hub + [(100, 100), (7, 7)], "x long, y long")
    got = {r["node"]: r["root"] for r in components(rows).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 140))
    assert components(rows.where("x < 0")).collect() == []
    null = rows.select(F.lit(None).cast("long").alias("x"), "y")
    assert components(null).collect() == []
