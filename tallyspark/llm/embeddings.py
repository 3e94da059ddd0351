"""Near-duplicate embeddings by int8 tile products with error bounds."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .simhash import spanning

#: Vectors of a block at most; a task compares two blocks.
BLOCK_ROWS = 32768
#: Side of one product inside a task.
TILE = 1024
#: Room for rounding in the bounds themselves, far above what double precision can lose.
SLACK = 1e-9

_NEW = "key binary, q binary, scale double, error double, exact binary"


def quantise(vector: np.ndarray) -> tuple[np.ndarray, float, float]:
    """int8 values, their scale, and the length of what rounding took from the unit vector."""
    unit = vector / np.linalg.norm(vector)
    scale = float(np.abs(unit).max()) / 127
    q = np.rint(unit / scale).astype(np.int8)
    return q, scale, float(np.linalg.norm(unit - scale * q))


def _quantised(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, key, q, scale, error, exact); all but the id are null for a vector that links with nothing."""
    from pyspark.sql import types as T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for values in batch.column(1):
                x = None
                if values.is_valid and len(values) and values.values.null_count == 0:
                    x = values.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    peak = np.abs(x).max()
                    if not (np.isfinite(x).all() and peak > 0):
                        x = None
                if x is None:
                    for column in out:
                        column.append(None)
                    continue
                # The exponent is taken out, so that squares of very large or small parts neither overflow nor vanish.
                x = np.ldexp(x, -math.frexp(peak)[1])
                raw = x.tobytes()
                q, scale, error = quantise(x)
                for column, value in zip(out, (hashlib.sha256(raw).digest(), q.tobytes(), scale, error, raw)):
                    column.append(value)
            kinds = (pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=["id", "key", "q", "scale", "error", "exact"],
            )

    chosen = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{column}`").alias("v"))
    schema = T.StructType([chosen.schema["id"], *T.StructType.fromDDL(_NEW).fields])
    return chosen.mapInArrow(run, schema)


def _near(a: dict, b: dict, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs with a cosine of at least the threshold, tile by tile.

    With u = s q + e, the product of two unit vectors differs from s s' (q . q') by at most |e| + |e'| + |e| |e'|. The
    integer products are exact in single precision, as no sum of theirs reaches 2^24 (in double precision beyond 1040
    parts). Only pairs that the bound leaves open are computed from the vectors themselves, in double precision.
    """
    kind = np.float32 if 127 * 127 * a["q"].shape[1] < 1 << 24 else np.float64
    for i in range(0, len(a["node"]), TILE):
        left = {k: v[i : i + TILE] for k, v in a.items()}
        ql = left["q"].astype(kind)
        for j in range(i if same else 0, len(b["node"]), TILE):
            right = {k: v[j : j + TILE] for k, v in b.items()}
            product = ql @ right["q"].astype(kind).T
            # One bound for the tile first: rows are ordered by scale, so scales in a tile hardly differ.
            el, er = left["error"].max(), right["error"].max()
            least = (threshold - el - er - el * er - SLACK) / (left["scale"].max() * right["scale"].max())
            x, y = np.nonzero(product >= least) if least > 0 else np.indices(product.shape).reshape(2, -1)
            bound = left["error"][x] + right["error"][y] + left["error"][x] * right["error"][y]
            open_ = left["scale"][x] * right["scale"][y] * product[x, y] + bound + SLACK >= threshold
            if same and i == j:
                open_ &= x < y
            x, y = x[open_], y[open_]
            for at in range(0, len(x), 1 << 15):
                p, r = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
                cosine = np.einsum("ij,ij->i", left["exact"][p], right["exact"][r]) / (left["norm"][p] * right["norm"][r])
                found = cosine >= threshold
                yield i + p[found], j + r[found]


def _cell(rows: pa.Table, threshold: float) -> pa.Table:
    """Two blocks, to (node, links there, least node that the links there lead to)."""
    nodes, links, roots = [], [], []
    lengths = np.array([len(x) for x in rows["q"].to_pylist()])
    for d in np.unique(lengths):  # vectors of different lengths have no cosine
        part = rows.filter(pa.array(lengths == d))
        part = part.take(np.argsort(part["scale"].to_numpy(), kind="stable"))
        exact = np.frombuffer(b"".join(part["exact"].to_pylist()), np.float64).reshape(-1, d)
        data = {
            "node": part["node"].to_numpy(), "size": part["size"].to_numpy(), "scale": part["scale"].to_numpy(),
            "error": part["error"].to_numpy(), "q": np.frombuffer(b"".join(part["q"].to_pylist()), np.int8).reshape(-1, d),
            "exact": exact, "norm": np.sqrt(np.einsum("ij,ij->i", exact, exact)),
        }
        second = part["second"].to_numpy(zero_copy_only=False).astype(bool)
        own = part["own"][0].as_py()
        at = [np.arange(len(second))] * 2 if own else [np.flatnonzero(~second), np.flatnonzero(second)]
        a, b = ({k: v[p] for k, v in data.items()} for p in at)
        count, x, y = np.zeros(len(second), np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for p, r in _near(a, b, own, threshold):
            p, r = at[0][p], at[1][r]
            count += np.bincount(p, data["size"][r], len(count)).astype(np.int64)
            count += np.bincount(r, data["size"][p], len(count)).astype(np.int64)
            # Links are folded to a spanning forest as they come, so their number never matters.
            root = spanning(len(count), np.concatenate([*x, p]), np.concatenate([*y, r]))
            moved = np.flatnonzero(root != np.arange(len(root)))
            x, y = [moved], [root[moved]]
        root = np.arange(len(count))
        root[x[0]] = y[0]
        some = count > 0
        nodes.append(data["node"][some])
        links.append(count[some])
        roots.append(data["node"][root[some]])
    return pa.table({"node": np.concatenate(nodes), "links": np.concatenate(links), "root": np.concatenate(roots)})


def embedding_groups(
    vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept): links to other vectors with a cosine of at least `threshold`.

    All vectors are compared with all, block by block: a task holds two blocks of bounded size, multiplies them as int8
    tiles and computes in full precision what the error bounds leave open. It returns a count and one link per vector,
    never its pairs. Equal vectors are one node with a size, so copies cost one row. The work is quadratic in the number
    of different vectors by the contract of the comparison; blocks only bound what a task holds.

    A vector that is null, empty, zero, or holds a null or a non-finite part links with nothing. Vectors of different
    lengths do not link. A null id is counted like any other but never names a component; a component of null ids alone
    is null and its rows are kept. Repeated rows count as other vectors.
    """
    spark = vectors.sparkSession
    rows = written(_quantised(vectors, id_column, column), "quantised")
    firsts = [F.first(c).alias(c) for c in ("q", "scale", "error", "exact")]
    grouped = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("size"), *firsts)
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    blocks = max(1, -(-n // BLOCK_ROWS), math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks))
    dealt = (
        nodes.select("node", "size", "q", "scale", "error", "exact", block.alias("b"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select(
            F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), (F.col("b") > F.col("other")).alias("second"),
            (F.col("b") == F.col("other")).alias("own"), "node", "size", "q", "scale", "error", "exact",
        )
    )
    found = written(
        dealt.groupBy("i", "j").applyInArrow(lambda t: _cell(t, threshold), "node long, links long, root long"), "found"
    )
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.select("key", "node", "least", "size").join(counts, "node", "left").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = placed.join(least, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"
    )
    joined = rows.select("id", "key").join(labels, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
