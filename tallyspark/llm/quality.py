"""Text quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, schema_with, slices, with_text
from .labelled import MAX_ROWS, training_sample

FEATURES = (
    "log_words", "word_bytes", "upper", "exclaim", "bars", "symbols", "digits", "repeats", "distinct", "ends", "same_lines", "stops",
    "letters", "brackets",
)

_CLASS = np.zeros(256, np.int64)
for _name, _chars in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"|", b"#$%&*+=<>@^_~`\\/", b"0123456789", b".?:;", b"abcdefghijklmnopqrstuvwxyz", b"()[]{}"), 1
):
    for _c in _chars:
        _CLASS[_c] = _name
_CLASS[128:] = 7  # parts of letters beyond ASCII


def features(text: str) -> list[float]:
    """Shares and sizes of the whole text; an empty text has zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, count, 9)
    size = len(raw)
    lines = [line for line in raw.split(b"\n") if line]
    solid = sum(map(len, words))
    return [
        math.log1p(n),
        solid / n,
        kinds[1] / size,
        kinds[2] / n,
        kinds[3] / n,
        kinds[4] / n,
        kinds[5] / size,
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        kinds[6] / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(1 for line in lines if line[-1:] in b".!?") / max(1, len(lines)),
        kinds[7] / size,
        kinds[8] / n,
    ]


@dataclass
class AdditiveModel:
    """Bin edges and a table of log odds per feature, and a table per pair of features on coarser bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, f], "right")]
        for (f, g), values in zip(self.pairs, self.pair_tables):
            total += values[np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Boundaries between bins of about equal counts, halfway between two values that occur."""
    seen = np.unique(values)
    if len(seen) < 2:
        return np.empty(0)
    cuts = np.unique(np.searchsorted(seen, np.quantile(values, np.arange(1, bins) / bins), "left"))
    cuts = np.unique(np.concatenate([cuts[cuts < len(seen) - 1], [0]]))
    return (seen[cuts] + seen[cuts + 1]) / 2


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """Newton step per bin of the best tree of so many leaves over ordered bins, grown by the best gain."""
    parts = [(0, len(g))]
    gc, hc = np.concatenate(([0.0], np.cumsum(g))), np.concatenate(([0.0], np.cumsum(h)))

    def worth(a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        return (gc[b] - gc[a]) ** 2 / (hc[b] - hc[a] + l2)

    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = worth(a, cut) + worth(cut, b) - worth(a, b)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), (a, b), int(cut[at]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (gc[b] - gc[a]) / (hc[b] - hc[a] + l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the best tree with one cut on each of two features."""
    n, m = g.shape
    total = lambda a: np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    gc, hc = total(g), total(h)
    best, out = 0.0, np.zeros_like(g)
    for i in range(1, n):
        for j in range(1, m):
            areas = ((0, i, 0, j), (0, i, j, m), (i, n, 0, j), (i, n, j, m))
            steps, gain = [], 0.0
            for a, b, c, d in areas:
                gs = gc[b, d] - gc[a, d] - gc[b, c] + gc[a, c]
                hs = hc[b, d] - hc[a, d] - hc[b, c] + hc[a, c]
                steps.append(gs / (hs + l2))
                gain += gs * gs / (hs + l2)
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for (a, b, c, d), step in zip(areas, steps):
                    out[a:b, c:d] = step
    return best, out


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 25, pairs: int = 4, bins: int = 32, rate: float = 0.1, l2: float = 2.0
) -> AdditiveModel:
    """Boosts shallow trees on one feature after the other, round by round, then on the pairs that explain most of the rest.

    The trees of a feature add up to its lookup table. Without rows, or with one class alone, the model is a constant.
    """
    n, k = x.shape
    positive = float(y.sum())
    intercept = math.log((positive + 0.5) / (n - positive + 0.5))
    edges = [_edges(x[:, f], bins) if n else np.empty(0) for f in range(k)]
    coarse = [_edges(x[:, f], 8) if n else np.empty(0) for f in range(k)]
    model = AdditiveModel(intercept, edges, [np.zeros(len(e) + 1) for e in edges], coarse, [], [])
    if not 0 < positive < n:
        return model
    at = [np.searchsorted(edges[f], x[:, f], "right") for f in range(k)]
    logit = np.full(n, intercept)
    for _ in range(rounds):
        for f in range(k):
            p = 1 / (1 + np.exp(-logit))
            size = len(edges[f]) + 1
            if size > 1:
                step = rate * _shallow_tree(np.bincount(at[f], y - p, size), np.bincount(at[f], p * (1 - p), size), 3, l2)
                model.tables[f] += step
                logit += step[at[f]]
    low = [np.searchsorted(coarse[f], x[:, f], "right") for f in range(k)]

    def grids(f: int, g: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse[f]) + 1, len(coarse[g]) + 1)
        cell = low[f] * shape[1] + low[g]
        p = 1 / (1 + np.exp(-logit))
        size = shape[0] * shape[1]
        return cell, np.bincount(cell, y - p, size).reshape(shape), np.bincount(cell, p * (1 - p), size).reshape(shape)

    gains = [(_quadrants(*grids(f, g)[1:], l2)[0], f, g) for f in range(k) for g in range(f + 1, k)]
    model.pairs = [(f, g) for gain, f, g in sorted(gains, reverse=True)[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1)) for f, g in model.pairs]
    for _ in range(pair_rounds):
        for values, (f, g) in zip(model.pair_tables, model.pairs):
            cell, gs, hs = grids(f, g)
            step = rate * _quadrants(gs, hs, l2)[1]
            values += step
            logit += step.reshape(-1)[cell]
    return model


def with_features(docs: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    chosen, name = with_text(docs, keep, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, name):
            x = np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))
            yield beside(part, keep, x=pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float64())))

    return chosen.mapInArrow(run, schema_with(docs, keep, "x array<double>"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """The model of `labels.quality`, fitted on features of at most `max_rows` labelled rows outside the held-out fold."""
    rows = with_features(training_sample(docs, labels, "quality", max_rows), ["label"]).collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["label"] for r in rows], np.float64))


def score(
    docs: DataFrame, model: AdditiveModel, keep: list[str] | None = None, text_column: str = "text", column: str = "score"
) -> DataFrame:
    """The kept columns (default: all) with a score, the probability of good quality, from the whole text alone.

    A null text is scored like an empty one. A column of the input named like the score is left out of the default.
    """
    keep = [c for c in docs.columns if c != column] if keep is None else keep
    chosen, name = with_text(docs, keep, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, name):
            x = np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))
            yield beside(part, keep, **{column: pa.array(model.score(x))})

    return chosen.mapInArrow(run, schema_with(docs, keep, f"`{column}` double"))
