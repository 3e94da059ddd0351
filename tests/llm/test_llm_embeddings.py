import math

import numpy as np
import pytest

from tallyspark.llm import embeddings


def plain(rows, threshold):
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                linked[i, j] = rows[i][1] == rows[j][1] or x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold
    root = list(range(n))
    for _ in range(n):
        for i, j in zip(*np.nonzero(linked)):
            root[i] = root[j] = min(root[i], root[j])
    return linked.sum(1), root, good


def result(spark, rows, kind, threshold=0.95):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    return embeddings.embedding_groups(frame, threshold).collect()


@pytest.mark.parametrize("kind,threshold", [("double", 0.95), ("float", 0.8), ("float", 0.0)])
def test_links_equal_all_pairs(spark, monkeypatch, kind, threshold):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 40)
    monkeypatch.setattr(embeddings, "TILE", 16)
    rnd = np.random.default_rng(4)
    rows, centres = [], rnd.normal(size=(12, 16))
    for i in range(120):
        v = centres[i % 12] + rnd.normal(scale=rnd.choice([0.05, 0.2, 0.5]), size=16)
        if i % 7 == 0:
            v *= 1e-3 if i % 2 else 1e6
        if i % 11 == 0:
            v[3:] *= 1e-4  # one part outweighs the others, so rounding takes much of the rest
        rows.append((i * 3, np.float32(v).astype(float).tolist()))
    count, root, _ = plain(rows, threshold)
    got = {r["vec_id"]: r for r in result(spark, rows, kind, threshold)}
    for k, (i, _) in enumerate(rows):
        assert got[i]["n_links"] == count[k]
        assert got[i]["component_id"] == rows[root[k]][0] and got[i]["kept"] == (root[k] == k)


def test_bounds_hold():
    rnd = np.random.default_rng(2)
    for _ in range(300):
        x, y = rnd.normal(size=(2, 24)) * 10.0 ** rnd.integers(-3, 3, size=(2, 24))
        (q, s, e), (r, t, f) = embeddings.quantise(x), embeddings.quantise(y)
        cosine = x @ y / (np.linalg.norm(x) * np.linalg.norm(y))
        assert abs(cosine - s * t * float(q.astype(int) @ r.astype(int))) <= e + f + e * f + embeddings.SLACK


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [1.0, None]), (8, [nan, 1.0]),
        (9, [inf, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 1e-9]), (11, [-0.0, 1.0]), (12, [0.0, 1.0]), (2, [1.0, 0.0]),
        (13, [1e-200, 0.0]), (14, [1e300, 1e300]), (None, None), (15, [-1.0, 0.0]),
    ]
    got = result(spark, rows, "double")
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append(r)
    for i in (4, 5, 6, 7, 8, 9, 10, 14, 15):
        assert (by[i][0]["n_links"], by[i][0]["component_id"], by[i][0]["kept"]) == (0, i, True)
    for i in (1, 2, 3, 13):
        assert all(r["n_links"] == 5 and r["component_id"] == 1 for r in by[i])
    assert by[11][0]["n_links"] == by[12][0]["n_links"] == 1 and by[12][0]["component_id"] == 11
    assert sorted((r["n_links"], r["component_id"]) for r in by[None] if r["component_id"]) == [(5, 1)]


def test_empty_table(spark):
    assert result(spark, [], "float") == []
    assert len(result(spark, [(1, None)], "float")) == 1
