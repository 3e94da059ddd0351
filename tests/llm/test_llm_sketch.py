import hashlib
import random

import numpy as np
import pytest

from tallyspark.llm import sketch


def alike(a, b):
    x, y = set(sketch.digests(a).tolist()), set(sketch.digests(b).tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


def check(rows, source):
    order = sorted(source, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0)))
    assert len(rows) == len(source)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for k, row in enumerate(order):
        if len(by[row["doc_id"]]) > 1 or len(by[order[(k + 1) % len(order)]["doc_id"]]) > 1:
            continue
        text, after, got = row["text"] or "", order[(k + 1) % len(order)]["text"] or "", by[row["doc_id"]][0]
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        assert got["n_chars"] == len(text) and got["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got["near_edited"] == pytest.approx(alike(text, edited)) and got["near_next"] == pytest.approx(alike(text, after))


def test_awkward_rows(docs, clashing, no_docs):
    rows = sketch.fingerprints(docs, keep=["doc_id", "text"], part_bytes=4000).collect()
    check(rows, docs.collect())
    prints = {}
    for r in rows:
        prints.setdefault(r["text"] or "", set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert sketch.fingerprints(clashing).count() == docs.count()
    assert sketch.fingerprints(no_docs).collect() == []


def test_one_document_follows_itself(spark):
    one = spark.createDataFrame([(3, "one line.\nand another line of it.")], "doc_id long, text string")
    row = sketch.fingerprints(one).first()
    check([row], one.collect())
    assert row["near_next"] == 1.0


def test_many_parts_have_the_right_neighbours(spark):
    rnd = random.Random(2)
    rows = [(i * 7 - 500, " ".join(rnd.choice("aa bb cc dd ee. ff\n".split(" ")) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(sketch.fingerprints(frame, part_bytes=500).collect(), frame.collect())


def test_peeling_recovers_differences_or_grows():
    rnd = np.random.default_rng(5)
    left, right, want = [], [], []
    for n, shared in ((0, 0), (1, 0), (0, 5), (3, 10), (200, 50), (5000, 5000)):
        keys = rnd.integers(0, 1 << 63, 2 * n + shared).astype(np.uint64)
        left.append(keys[: n + shared])
        right.append(keys[n:])
        want.append(shared / (2 * n + shared) if n + shared else 1.0)
    got = sketch.likeness(left, right, sketch.sketches(left), sketch.sketches(right))
    assert got == pytest.approx(want)


def test_sketches_subtract_and_repeat_counts():
    a, b = sketch.digests("one.\ntwo.\ntwo.\n"), sketch.digests("two.\none.\ntwo.\n")
    assert len(set(a.tolist())) == len(a)
    recovered, whole = sketch.sketches([a]).minus(sketch.sketches([a])).peel()
    assert recovered.tolist() == [0] and whole.tolist() == [True]
    assert len(set(a.tolist()) ^ set(b.tolist())) < len(a) + len(b)
    assert sketch.sketches([a]).texts(np.array([len(a)])) == sketch.sketches([a[::-1]]).texts(np.array([len(a)]))
