"""Exact key boundaries by repeated histograms: no sample, no sort, and a bounded result per round."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Splitter:
    """First key of the right side, with what lies before it."""

    key: tuple[int, ...]
    weight_below: int
    rows_below: int


@dataclass
class _Interval:
    """Part of the key space in which boundaries are still sought: equal to `prefix`, then lo..hi in the next column."""

    prefix: tuple[int, ...]
    lo: int
    hi: int
    weight_below: int
    rows_below: int
    targets: list[int] = field(default_factory=list)


def _inside(keys: list[str], it: _Interval) -> Column:
    column = len(it.prefix)
    same = F.lit(True)
    for name, value in zip(keys, it.prefix):
        same = same & (F.col(name) == F.lit(value))
    return same & F.col(keys[column]).between(F.lit(it.lo), F.lit(it.hi))


def split_points(
    rows: DataFrame, keys: list[str], weight: str, parts: int, tolerance: float = 1e-4, probes: int = 1024
) -> tuple[list[Splitter], int, int]:
    """Boundaries that cut the rows, ordered by non-negative long `keys`, into parts of equal weight.

    Every round counts, over all rows, the weight in the cells between candidate boundaries and keeps the cell that
    holds a target. A boundary is final when it misses its target by at most `tolerance` of a part, or when the cell is
    one single key (then the nearer of its two sides is taken). At most (parts - 1) * probes counts come to the
    driver in a round, whatever the number of rows. Returns the boundaries, the whole weight and the number of rows.
    """
    first, *_ = keys
    total = rows.agg(F.sum(weight).alias("w"), F.count("*").alias("n"), F.min(first).alias("lo"), F.max(first).alias("hi")).first()
    if not total["n"]:
        return [], 0, 0
    weight_all, rows_all = int(total["w"]), int(total["n"])
    slack = tolerance * weight_all / parts
    targets = {i: weight_all * i / parts for i in range(1, parts)}
    found: dict[int, Splitter] = {}
    open_ = [_Interval((), int(total["lo"]), int(total["hi"]), 0, 0, list(targets))] if parts > 1 else []
    while open_:
        per = max(16, probes // len(open_)) if len(open_) > probes else probes
        widths = [max(1, -(-(it.hi - it.lo + 1) // per)) for it in open_]
        where, cell = F.lit(False), None
        values = F.lit(None)
        for i, (it, width) in enumerate(zip(open_, widths)):
            column = F.col(keys[len(it.prefix)])
            at = F.struct(
                F.lit(i).alias("i"), F.expr(f"(`{keys[len(it.prefix)]}` - {it.lo}L) div {width}L").alias("c"), column.alias("v")
            )
            inside = _inside(keys, it)
            where = where | inside
            cell = F.when(inside, at) if cell is None else cell.when(inside, at)
        counted = (
            rows.where(where)
            .select(cell.alias("cell"), F.col(weight).alias("w"))
            .groupBy(F.col("cell.i").alias("i"), F.col("cell.c").alias("c"))
            .agg(F.sum("w").alias("w"), F.count("*").alias("n"), F.min("cell.v").alias("lo"), F.max("cell.v").alias("hi"))
            .collect()
        )
        cells: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r["i"], r["c"])):
            cells.setdefault(row["i"], []).append(row)
        following: dict[tuple, _Interval] = {}
        for i, it in enumerate(open_):
            for target in it.targets:
                weight_below, rows_below = it.weight_below, it.rows_below
                for row in cells[i]:
                    if weight_below + row["w"] >= targets[target]:
                        break
                    weight_below, rows_below = weight_below + int(row["w"]), rows_below + int(row["n"])
                lo, hi, inner = int(row["lo"]), int(row["hi"]), len(it.prefix) + 1 < len(keys)
                before, after = targets[target] - weight_below, weight_below + int(row["w"]) - targets[target]
                if min(before, after) <= slack or (lo == hi and not inner):
                    zeros = (0,) * (len(keys) - len(it.prefix) - 1)
                    if before <= after:
                        found[target] = Splitter((*it.prefix, lo, *zeros), weight_below, rows_below)
                    else:
                        found[target] = Splitter((*it.prefix, hi + 1, *zeros), weight_below + int(row["w"]), rows_below + int(row["n"]))
                    continue
                key = (*it.prefix, lo, hi)
                if key not in following:
                    # A cell of one value is refined by the next key column, whose whole range is open.
                    step = (*it.prefix, lo) if lo == hi else it.prefix
                    bounds = (0, (1 << 63) - 1) if lo == hi else (lo, hi)
                    following[key] = _Interval(step, *bounds, weight_below, rows_below)
                following[key].targets.append(target)
        open_ = list(following.values())
    return [found[i] for i in sorted(found)], weight_all, rows_all


def range_of(keys: list[str], splitters: list[Splitter]) -> Column:
    """Number of boundaries at or before the row's key, by a balanced tree of comparisons."""

    def at_or_after(key: tuple[int, ...]) -> Column:
        result = F.lit(True)
        for name, value in reversed(list(zip(keys, key))):
            result = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & result)
        return result

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(at_or_after(splitters[mid].key), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(splitters))
