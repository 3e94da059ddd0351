import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import whitening


def turned(values, seed=0):
    rnd = np.random.default_rng(seed)
    q = np.linalg.qr(rnd.normal(size=(len(values), len(values))))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize(
    "values",
    [np.arange(30, 0, -1.0), np.r_[[5.0] * 8, [3.0] * 8, np.linspace(1, 1 + 1e-9, 16), np.geomspace(1e-3, 1e-9, 32)], np.ones(20),
     np.r_[1e6, 1e-2 + np.arange(40) * 1e-8], np.r_[1.0, np.zeros(9)], np.array([4.0]), np.zeros(3), np.r_[1 + 1e-7, 1.0, 1 - 1e-7]],
)
def test_eigenvectors_to_double_precision(values):
    a = turned(values)
    w, v = whitening.eigen(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(w - np.sort(values)[::-1]).max() <= 3e-15 * max(size, np.abs(values).max())
    assert np.abs(v.T @ v - np.eye(len(a))).max() < 3e-15
    assert np.abs(a @ v - v * w).max() <= 5e-15 * max(size, np.abs(values).max())


def test_refinement_squares_the_error():
    a = turned(np.arange(1.0, 21)).astype(whitening.HIGH) / 20
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(whitening.HIGH)
    errors = []
    for _ in range(3):
        x, _, wrong, clusters = whitening.refined(a, x)
        errors.append(wrong)
    assert not clusters and errors[1] < 1e3 * errors[0] ** 2 and errors[2] < 1e-15


def plain(rows, dimension):
    good = [(i, [math.floor(64 * np.float64(c)) + 1000000 for c in v]) for i, v in rows
            if v is not None and len(v) == dimension and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    w, v = np.linalg.eigh(covariance)
    w, v = w[::-1], v[:, ::-1]
    out = {}
    for i, x in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        out.setdefault(i, []).append((deviation, np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)]) @ v / np.sqrt(np.abs(w))))
    return n, w / w.sum(), out


def test_equals_plain(spark):
    rnd = np.random.default_rng(5)
    mix = rnd.normal(size=(12, 12))
    rows = [(i, (mix @ rnd.normal(size=12)).astype(np.float32).astype(float).tolist()) for i in range(150)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1]), (None, rows[4][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit(1), "_vector": F.lit(2)}).repartition(3)
    got = whitening.whiten(frame, 8).collect()
    n, explained, want = plain(rows, 12)
    assert len(got) == 8 * len(rows) and {r["n"] for r in got} == {n} == {150}
    assert {r["component"] for r in got} == set(range(1, 9))
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    signs = {c: np.sign(by[7, c][0]["whitened"] * want[7][0][1][c - 1]) for c in range(1, 9)}
    for (i, c), found in by.items():
        assert len(found) == len(want[i])
        for r, (deviation, white) in zip(found, want[i]):
            assert int(r["deviation"]) == deviation
            assert abs(r["whitened"] * signs[c] - white[c - 1]) < 1e-10
            assert abs(r["explained"] - explained[c - 1]) < 1e-12 and r["identity_error"] < 1e-10
            assert r["x"] == 1 and r["_vector"] == 2


def test_awkward_vectors(spark):
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [1.0, None], [nan, 1.0], [inf, 1.0], [1e300, 1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v) for i, v in enumerate(bad)] + [(10, [0.0, 0.0]), (11, [1.0, 0.0]), (12, [-0.0, 2.0]), (13, [1.0, 1.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"] for r in got} == {10, 11, 12, 13} and {r["component"] for r in got} == {1, 2}
    big = spark.createDataFrame([(i, [float(i * i) * 1e9, float(-i)]) for i in range(40)], "vec_id long, embedding array<double>")
    n, _, want = plain([(r["vec_id"], r["embedding"]) for r in big.collect()], 2)
    assert {(r["vec_id"], int(r["deviation"])) for r in whitening.whiten(big).collect()} == {(i, v[0][0]) for i, v in want.items()}


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    with pytest.raises(ValueError, match="named like results"):
        whitening.whiten(spark.createDataFrame([], schema + ", n long"))
