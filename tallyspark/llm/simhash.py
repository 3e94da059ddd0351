"""SimHash fingerprints and their self-join by a binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.sources.store import stage

from .common import beside, schema_with, scratch, slices, with_text, written
from .components import components

#: Work units with more fingerprints than this are divided further.
UNIT_ROWS = 500
#: Bits by which a divided unit goes deeper.
STEP_BITS = 4
#: Rows that a task joins at a time, if its units allow.
CHUNK_ROWS = 100_000

_digest = xxhash.xxh64_intdigest


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of all runs of so many words, repeats included; of the whole sequence if it is shorter."""
    tokens = text.encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([_digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(tokens) - words] + 1)).tolist()
    return np.fromiter((_digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())), np.uint64, len(starts))


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes, as a signed 64-bit number; zero without hashes."""
    n = len(hashes)
    if not n:
        return 0
    bits = np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    majority = bits.sum(0, dtype=np.int64) * 2 > n
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, keep: list[str] | None = None, text_column: str = "text") -> DataFrame:
    """The kept columns (default: all) with `fp`, the SimHash of the text as a long. A null text is an empty one."""
    keep = [c for c in docs.columns if c != "fp"] if keep is None else keep
    chosen, name = with_text(docs, keep, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, name):
            yield beside(part, keep, fp=pa.array([simhash(shingle_hashes(t, words)) for t in texts], pa.int64()))

    return chosen.mapInArrow(run, schema_with(docs, keep, "fp long"))


# The trie join inside a task


def trie_pairs(value: np.ndarray, first: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs within the budget, for many pairs of tries at once.

    `value` holds the fingerprints, sorted in each node. `first` has a row for each pair of root nodes: low and high end
    of the one, low and high end of the other, differing bits so far, depth; a node joined with itself stands on both
    sides. Node pairs go down together one bit at a time: children that take the same turn keep their differing bits,
    children that part get one more, and pairs over the budget are dropped. Small pairs are compared directly.
    """
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    stack = [first]
    while stack:
        now = stack.pop()
        while len(now):
            if len(now) > 1 << 20:
                stack.append(now[1 << 20 :])
                now = now[: 1 << 20]
            a0, a1, b0, b1, used, depth = now.T
            many = (a1 - a0) * (b1 - b0)
            small = (many <= 64) | (depth >= 64)
            some = now[small]
            for i in range(0, len(some), 1 << 16):
                part = some[i : i + (1 << 16)]
                sizes = (part[:, 1] - part[:, 0]) * (part[:, 3] - part[:, 2])
                which = np.repeat(np.arange(len(part)), sizes)
                nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                wide = (part[:, 3] - part[:, 2])[which]
                x, y = part[which, 0] + nth // wide, part[which, 2] + nth % wide
                near = np.bitwise_count(value[x] ^ value[y]) <= budget
                near &= (part[which, 0] != part[which, 2]) | (x < y)
                left.append(x[near])
                right.append(y[near])
            now = now[~small]
            if not len(now):
                break
            level = int(now[0, 5])
            deeper = now[now[:, 5] != level]
            if len(deeper):
                stack.append(deeper)
                now = now[now[:, 5] == level]
            ones = np.concatenate(([0], np.cumsum((value >> np.uint64(63 - level)) & np.uint64(1)).astype(np.int64)))
            a0, a1, b0, b1, used, depth = now.T
            am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
            own, on = a0 == b0, depth + 1
            children = [
                np.stack([a0, am, b0, bm, used, on], 1),
                np.stack([am, a1, bm, b1, used, on], 1),
                np.stack([a0, am, bm, b1, used + 1, on], 1),
                np.stack([am, a1, b0, bm, used + 1, on], 1)[~own],
            ]
            now = np.concatenate(children)
            now = now[(now[:, 4] <= budget) & (now[:, 1] > now[:, 0]) & (now[:, 3] > now[:, 2])]
    return np.concatenate(left), np.concatenate(right)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the least item that links lead to."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root != root[root]).any():
            root = root[root]


def _join_units(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit, to links that connect the same fingerprints as all pairs within the budget do."""
    names = ["rot", "node_a", "node_b", "depth", "used", "side", "v"]

    def links(rows: np.ndarray) -> pa.RecordBatch:
        value = rows[:, 6].astype(np.int64).view(np.uint64)
        order = np.lexsort((value, rows[:, 5], rows[:, 4], rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))
        rows, value = rows[order], value[order]
        fresh = np.r_[True, (rows[1:, :5] != rows[:-1, :5]).any(1)]
        starts = np.flatnonzero(fresh)
        ends = np.r_[starts[1:], len(rows)]
        ones = np.r_[0, np.cumsum(rows[:, 5])]
        middle = ends - (ones[ends] - ones[starts])
        cross = rows[starts, 1] != rows[starts, 2]
        pairs = np.stack(
            [starts, np.where(cross, middle, ends), np.where(cross, middle, starts), ends, rows[starts, 4], rows[starts, 3]], 1
        )
        pairs = pairs[(pairs[:, 1] > pairs[:, 0]) & (pairs[:, 3] > pairs[:, 2])]
        root = spanning(len(value), *trie_pairs(value, pairs, budget))
        moved = np.flatnonzero(root != np.arange(len(value)))
        turn = (rows[moved, 0] * 16).astype(np.uint64)

        def back(at: np.ndarray) -> np.ndarray:
            v = value[at]
            return np.where(turn == 0, v, v >> turn | v << (np.uint64(64) - turn) % np.uint64(64)).view(np.int64)

        return pa.RecordBatch.from_arrays([pa.array(back(moved)), pa.array(back(root[moved]))], names=["a", "b"])

    held: list[np.ndarray] = []
    count = 0
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], 1)
        if not len(rows):
            continue
        held.append(rows)
        count += len(rows)
        if count >= CHUNK_ROWS:
            rows = np.concatenate(held)
            cut = np.flatnonzero((rows[1:, :5] != rows[:-1, :5]).any(1))
            if len(cut):
                yield links(rows[: cut[-1] + 1])
                rows = rows[cut[-1] + 1 :]
            held, count = [rows], len(rows)
    if count:
        yield links(np.concatenate(held))


def _units(values: DataFrame, budget: int) -> DataFrame:
    """Fingerprints dealt to pairs of trie nodes, so that every pair within the budget meets in a unit of bounded size.

    With at most three differing bits, one of four blocks of sixteen bits is equal. Each fingerprint is therefore put
    into four tries, one for each block turned to the front, whose nodes at depth 16 are joined with themselves. Nodes
    with many fingerprints are divided: their children, `STEP_BITS` deeper, are paired within what is left of the budget.
    """
    unit = ["rot", "node_a", "node_b", "depth", "used"]
    turned = [F.col("fp")] + [
        F.shiftleft("fp", 16 * r).bitwiseOR(F.shiftrightunsigned("fp", 64 - 16 * r)) for r in range(1, 4)
    ]
    top = F.lit(-1 << 48)
    rows = (
        values.select(F.posexplode(F.array(*turned)).alias("rot", "v"))
        .select("rot", F.col("v").bitwiseAND(top).alias("node_a"), F.col("v").bitwiseAND(top).alias("node_b"),
                F.lit(16).alias("depth"), F.lit(0).alias("used"), F.lit(0).alias("side"), "v")
    )
    rows = written(rows, "units")
    masks = [m for m in range(1 << STEP_BITS) if bin(m).count("1") <= budget]
    ready = []
    for depth in range(16, 64, STEP_BITS):
        sizes = rows.groupBy(*unit).agg(
            F.count("*").alias("n"), F.sum("side").alias("ones")
        ).where("node_a = node_b or (ones > 0 and ones < n)").where("n > 1")
        sizes = written(sizes.select(*unit, (F.col("n") > UNIT_ROWS).alias("large")), "sizes")
        sized = rows.join(sizes, unit)
        ready.append(sized.where("not large").drop("large"))
        if sizes.where("large").isEmpty():
            break
        shift = 64 - depth - STEP_BITS
        child = F.shiftrightunsigned("v", shift).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
        split = sized.where("large").select(
            *unit, "side", "v", child.alias("x"), F.explode(F.array(*(F.lit(m).cast("long") for m in masks))).alias("m")
        )
        other = F.col("x").bitwiseXOR(F.col("m"))
        alone = F.col("node_a") == F.col("node_b")
        low, high = F.least(F.col("x"), other), F.greatest(F.col("x"), other)
        to_a = F.when(alone, low).when(F.col("side") == 0, F.col("x")).otherwise(other)
        to_b = F.when(alone, high).when(F.col("side") == 0, other).otherwise(F.col("x"))
        rows = written(
            split.where(F.col("used") + F.bit_count("m") <= budget).select(
                "rot",
                F.col("node_a").bitwiseOR(F.shiftleft(to_a, shift)).alias("node_a"),
                F.col("node_b").bitwiseOR(F.shiftleft(to_b, shift)).alias("node_b"),
                F.lit(depth + STEP_BITS).alias("depth"),
                (F.col("used") + F.bit_count("m")).cast("int").alias("used"),
                F.when(alone, (F.col("x") > other).cast("int")).otherwise(F.col("side")).alias("side"),
                "v",
            ),
            "units",
        )
    else:
        ready.append(rows)
    dealt = ready[0]
    for more in ready[1:]:
        dealt = dealt.union(more)
    return dealt


def trie_links(values: DataFrame, budget: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that connect whatever pairs of at most `budget` (0 to 3) bits do."""
    if not 0 <= budget <= 3:
        raise ValueError("the blocks turned to the front are exact for a budget of at most 3 bits")
    dealt = _units(values, budget)
    unit = ["rot", "node_a", "node_b", "depth", "used"]
    grouped = dealt.repartition(*unit).sortWithinPartitions(*unit)
    return grouped.mapInArrow(lambda batches: _join_units(batches, budget), "a long, b long")


def simhash_groups(
    docs: DataFrame, words: int = 3, budget: int = 3, keep: list[str] | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The kept columns (default: all but the text) with `fp` and `component_id`, the least id that links lead to.

    Texts link when their SimHash fingerprints differ in at most `budget` bits. Equal fingerprints are one node, so a
    group of copies of any size costs one row in the join. Null and empty texts have fingerprint zero and are linked
    like any other. Rows with a null id belong to groups but never name one; a group of null ids alone has a null
    component. Rows come out as often as they went in.
    """
    own = ("fp", "component_id")
    keep = [c for c in docs.columns if c not in own and c != text_column] if keep is None else keep
    columns = list(dict.fromkeys([*keep, id_column]))
    marked = written(fingerprints(docs, words, columns, text_column), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min(id_column).alias("_least")), "nodes")
    roots = components(trie_links(nodes.select("fp"), budget))
    linked = nodes.join(roots, nodes["fp"] == roots["node"])
    named = linked.select("node", "root", "_least").union(
        nodes.join(roots.select(F.col("root").alias("fp")).distinct(), "fp").select(F.col("fp"), F.col("fp"), "_least")
    )
    least = named.groupBy("root").agg(F.min("_least").alias("_of"))
    of = named.join(least, "root").select(F.col("node").alias("fp"), "_of")
    labels = nodes.join(of, "fp", "left").select("fp", F.coalesce("_of", "_least").alias("component_id"))
    # Written first, so that the last join has a plain shuffle on either side, which Spark can split at a hot fingerprint.
    return marked.join(written(labels, "labels"), "fp").select(*(F.col(f"`{c}`") for c in keep), "fp", "component_id")


# Near-duplicates of a given resemblance

#: Independent fingerprints per text for a resemblance of 0.8: a pair of just that resemblance meets in one of the
#: 4 * SEEDS blocks of sixteen equal bits with a probability of over 0.99, and more alike ones nearly always.
SEEDS = 16
#: Differing bits allowed to candidates in one fingerprint; texts of resemblance 0.8 differ in about ten of 64.
CANDIDATE_BITS = 16
#: A unit with more fingerprints is joined in runs of this length first, and the rest once links are known.
RUN_ROWS = 512
#: Differing bits of the next two fingerprints beyond which a pair is no candidate. At a resemblance of 0.8 24 of 128 differ
#: at most, give or take 4.4, so the limit is five standard deviations off; of unlike texts one in a thousand passes.
NEXT_BITS = 46
#: Greatest probability that a bit of the fingerprints of two texts of resemblance 0.8 differs, over all sizes of their
#: sets: that of four shingles and the same with a fifth. From 33 shingles on it is 0.156.
BIT_DIFFERS = 0.1875
#: Standard deviations that all fingerprints together may exceed this by: a pair of resemblance 0.8 does so with a
#: probability below 1e-12 (Chernoff bound for 16 fingerprints), unlike texts differ in half of all bits.
DEVIATIONS = 8
#: Pairs that a small unit tells at once, per fingerprint.
TOLD_PAIRS = 4
#: Texts with at most so many shingles also meet by their rare shingles, which misses no pair: few shingles give few
#: distinct majorities, and a pair meets in a block with a probability of only 0.9 to 0.99.
SHORT_SHINGLES = 32
#: Rows that a task looks for nearest pairs in at a time.
NEAR_ROWS = 20_000
#: Texts and hashes in one of the two blocks whose sets a task compares at a time.
BLOCK_ROWS = 1000
BLOCK_HASHES = 1_000_000


def seeded_fingerprints(hashes: np.ndarray, seeds: int) -> np.ndarray:
    """SimHash of a set of hashes under several remixings, as signed 64-bit numbers."""
    distinct = np.unique(hashes)
    if not len(distinct):
        return np.zeros(seeds, np.int64)
    out = np.empty(seeds, np.int64)
    for seed in range(seeds):
        x = distinct + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[seed] = simhash(x ^ (x >> np.uint64(31)))
    return out


def _sets(docs: DataFrame, words: int, seeds: int) -> DataFrame:
    """(row, id, sign, prints, hashes): the distinct shingles of each text as sorted 32-bit hashes, and a digest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            sign, prints, packed = [], [], []
            for text in texts:
                hashes = shingle_hashes(text, words)
                short = np.unique(hashes >> np.uint64(32)).astype("<u4")
                sign.append(xxhash.xxh128_digest(np.unique(hashes).tobytes()))
                prints.append(seeded_fingerprints(hashes, seeds).tobytes())
                packed.append(short.tobytes())
            columns = {"sign": sign, "prints": prints, "hashes": packed}
            yield beside(part, ["row", "id"], **{k: pa.array(v, pa.binary()) for k, v in columns.items()})

    return docs.mapInArrow(run, schema_with(docs, ["row", "id"], "sign binary, prints binary, hashes binary"))


def _bands(nodes: DataFrame, seeds: int) -> DataFrame:
    """A row for each fingerprint and block turned to the front: (unit, v, next, later, node).

    The unit is the trie node at depth 16, `next` and `later` are the two fingerprints after this one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                n = part.num_rows
                v = np.frombuffer(b"".join(part.column("prints").to_pylist()), "<u8").reshape(n, seeds)
                turned = [v if r == 0 else (v << np.uint64(16 * r)) | (v >> np.uint64(64 - 16 * r)) for r in range(4)]
                after, later = (np.repeat(np.roll(v, -k, axis=1), 4, axis=1).reshape(-1).view(np.int64) for k in (1, 2))
                v = np.stack(turned, 2).reshape(-1)
                band = np.tile(np.arange(4 * seeds, dtype=np.int64), n)
                unit = (band << 16) | (v >> np.uint64(48)).astype(np.int64)
                node = np.repeat(part.column("node").to_numpy(), 4 * seeds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unit), pa.array(v.view(np.int64)), pa.array(after), pa.array(later), pa.array(node)],
                    names=["unit", "v", "next", "later", "node"],
                )

    return nodes.select("prints", "node").mapInArrow(run, "unit long, v long, next long, later long, node long")


def most_apart(seeds: int) -> int:
    """Differing bits in all fingerprints together beyond which two texts do not resemble each other by 0.8."""
    bits = 64 * seeds
    return int(bits * BIT_DIFFERS + DEVIATIONS * (bits * BIT_DIFFERS * (1 - BIT_DIFFERS)) ** 0.5)


def _prints_of(packed: pa.Array) -> np.ndarray:
    """A row of fingerprints for each value; at least one is needed."""
    return np.frombuffer(b"".join(packed.to_pylist()), "<u8").reshape(len(packed), -1)


def _near_prints(pairs: DataFrame, nodes: DataFrame, seeds: int) -> DataFrame:
    """The pairs (a, b, ...) of different roots whose fingerprints, all together, are near enough for the sets to be compared at all.

    `nodes` are (node, root, prints); both are looked up at once, so that a pair is joined once on either side.
    """
    most, names = most_apart(seeds), pairs.columns
    left = nodes.select(F.col("node").alias("a"), F.col("root").alias("_ra"), F.col("prints").alias("_x"))
    right = nodes.select(F.col("node").alias("b"), F.col("root").alias("_rb"), F.col("prints").alias("_y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = np.bitwise_count(_prints_of(batch.column("_x")) ^ _prints_of(batch.column("_y"))).sum(1, dtype=np.int64)
                yield batch.select(names).filter(pa.array(apart <= most))

    joined = pairs.join(left, "a").join(right, "b").where("_ra != _rb")
    return joined.select(*names, "_x", "_y").mapInArrow(run, pairs.schema)


def _nearest_forest(n: int, a: np.ndarray, b: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of pairs that span what all pairs span, nearest first."""
    root, kept = np.arange(n), []
    for distance in np.unique(bits):
        some = np.flatnonzero(bits == distance)
        while len(some):
            x, y = root[a[some]], root[b[some]]
            apart = x != y
            some, x, y = some[apart], x[apart], y[apart]
            if not len(some):
                break
            # One pair for each upper root at a time, so that no pair closes a ring.
            _, first = np.unique(np.maximum(x, y), return_index=True)
            kept.append(some[first])
            root[np.maximum(x, y)[first]] = np.minimum(x, y)[first]
            while (root != root[root]).any():
                root = root[root]
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def _unit_pairs(units: DataFrame, bits: int) -> DataFrame:
    """Candidate pairs (a, b, bits) of all units, (unit, -1, -1) for units that have more to tell, (unit, node, -2) for ends.

    The pairs of a unit that has more to tell have negative bits (-1 - bits). A unit tells a forest of its nearest pairs,
    or all of them if they are few; a large unit does so for runs in the order of its trie, linked end to end. Rows are
    dealt by ranges, so that several tasks may hold a part of one unit; each tells its first and its last unit as ends.
    Units with more to tell, and ends as (unit, -1, -3), come with the list of their nodes, so that nobody has to look for
    them among all rows. A unit comes once for each part of it; a node may be in two of its lists.
    """

    def runs_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        counts = -(-(ends - starts) // RUN_ROWS)
        of = np.repeat(np.arange(len(starts)), counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        lo = starts[of] + nth * RUN_ROWS
        return np.stack([lo, np.minimum(lo + RUN_ROWS, ends[of]), lo, np.minimum(lo + RUN_ROWS, ends[of]), 0 * lo, 0 * lo + 16], 1)

    def batch_of(unit: np.ndarray, a: np.ndarray, b: np.ndarray, bits: np.ndarray, nodes: pa.Array | None = None) -> pa.RecordBatch:
        nodes = pa.nulls(len(unit), pa.list_(pa.int64())) if nodes is None else nodes
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in (unit, a, b, bits)), nodes], names=["unit", "a", "b", "bits", "nodes"])

    def told(rows: np.ndarray, cut: set[int], ends_of_task: list[int]) -> pa.RecordBatch:
        """`cut` are units of which other rows were or will be told apart from these."""
        value = rows[:, 1].astype(np.int64).view(np.uint64)
        order = np.lexsort((rows[:, 2], value, rows[:, 0]))
        rows, value = rows[order], value[order]
        after, later = rows[:, 3].astype(np.int64), rows[:, 4].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]])
        ends = np.r_[starts[1:], len(rows)]
        many = ends - starts > 1
        starts, ends = starts[many], ends[many]
        firsts = runs_of(starts, ends)
        x, y = trie_pairs(value, firsts, bits)
        near = np.bitwise_count((after[x] ^ after[y]).view(np.uint64)) + np.bitwise_count((later[x] ^ later[y]).view(np.uint64)) <= NEXT_BITS
        x, y = x[near], y[near]
        differ = np.bitwise_count(value[x] ^ value[y]).astype(np.int64)
        unit_of = np.searchsorted(starts, x, "right") - 1
        pairs = np.bincount(unit_of, minlength=len(starts))
        size = ends - starts
        dense = (pairs > TOLD_PAIRS * size) | (size > RUN_ROWS) | np.isin(rows[starts, 0], list(cut))
        inner = np.flatnonzero(dense[unit_of])
        keep = np.r_[np.flatnonzero(~dense[unit_of]), inner[_nearest_forest(len(value), x[inner], y[inner], differ[inner])]]
        joints = firsts[:-1, 1][firsts[:-1, 1] == firsts[1:, 0]] if len(firsts) > 1 else np.empty(0, np.int64)
        joints = joints[rows[joints, 0] == rows[joints - 1, 0]]
        x, y = np.r_[x[keep], joints - 1], np.r_[y[keep], joints]
        more = rows[starts[dense], 0]
        differ = np.bitwise_count(value[x] ^ value[y]).astype(np.int64)
        a, b = np.minimum(rows[x, 2], rows[y, 2]), np.maximum(rows[x, 2], rows[y, 2])
        differ = np.where(np.isin(rows[x, 0], more), -1 - differ, differ)
        member = rows[np.isin(rows[:, 0], np.r_[more, np.array(ends_of_task, np.int64)])]
        units, at = np.unique(member[:, 0], return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[at, len(member)], pa.int32()), pa.array(member[:, 2]))
        nodes = pa.concat_arrays([pa.nulls(len(x), lists.type), lists])
        none = np.full(len(units), -1, np.int64)
        code = np.where(np.isin(units, more), -1, -3)
        return batch_of(np.r_[rows[x, 0], units], np.r_[a, none], np.r_[b, code], np.r_[differ, none], nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, first, cut = [], 0, None, set()
        for batch in batches:
            for start in range(0, batch.num_rows, NEAR_ROWS):
                part = batch.slice(start, NEAR_ROWS)
                held.append(np.stack([part.column(c).to_numpy() for c in ("unit", "v", "node", "next", "later")], 1))
                count += part.num_rows
                first = held[0][0] if first is None else first
                if count >= NEAR_ROWS:
                    rows = np.concatenate(held)
                    last = np.flatnonzero(rows[1:, 0] != rows[:-1, 0])
                    if len(last):
                        yield told(rows[: last[-1] + 1], cut, [int(first[0])])
                        rows, cut = rows[last[-1] + 1 :], set()
                    if len(rows) >= NEAR_ROWS:
                        # One unit fills the chunk: its last row goes on, so that the parts are linked end to end.
                        cut = {int(rows[0, 0])}
                        yield told(rows, cut, [int(first[0])])
                        rows = rows[-1:]
                    held, count = [rows], len(rows)
        if count:
            rows = np.concatenate(held)
            ends = np.stack([first, rows[-1]])
            yield told(rows, cut, ends[:, 0].tolist())
            yield batch_of(ends[:, 0], ends[:, 2], np.full(2, -2), np.full(2, -1))

    dealt = units.repartitionByRange("unit", "v").sortWithinPartitions("unit", "v")
    return dealt.mapInArrow(run, "unit long, a long, b long, bits long, nodes array<long>")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of each set on the left with each on the right.

    Elements that many pairs share are counted by products of 0/1 matrices, the others pair by pair, both in parts.
    """
    n, m = len(left), len(right)
    out = np.zeros(n * m, np.int32)
    _, all_ids = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    cut = sum(map(len, left))
    p = np.repeat(np.arange(n), list(map(len, left)))
    q = np.repeat(np.arange(m), list(map(len, right)))
    x, y = all_ids[:cut], all_ids[cut:]
    kinds = int(all_ids.max(initial=-1)) + 1
    times = np.bincount(x, minlength=kinds) * np.bincount(y, minlength=kinds)
    heavy = np.flatnonzero(times * 64 > n * m)
    place = np.full(kinds, -1)
    for i in range(0, len(heavy), 1024):
        some = heavy[i : i + 1024]
        place[some] = np.arange(len(some))
        a, b = np.zeros((n, len(some)), np.float32), np.zeros((m, len(some)), np.float32)
        on = place[x] >= 0
        a[p[on], place[x[on]]] = 1
        on = place[y] >= 0
        b[q[on], place[y[on]]] = 1
        out += (a @ b.T).astype(np.int32).reshape(-1)
        place[some] = -1
    light = (times > 0) & (times * 64 <= n * m)
    on = light[y]
    order = np.argsort(y[on], kind="stable")
    y, q = y[on][order], q[on][order]
    p, x = p[light[x]], x[light[x]]
    low, high = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    ends = np.cumsum(high - low)
    start = 0
    while start < len(x):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20), "right")))
        sizes = (high - low)[start:stop]
        nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(p[start:stop], sizes) * m + q[np.repeat(low[start:stop], sizes) + nth]
        out += np.bincount(at, minlength=n * m).astype(np.int32)
        start = stop
    return out.reshape(n, m)


def _alike_links(node: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray], alone: bool, similarity: float):
    """Positions of links that span all alike pairs of different roots between the sides, or within if there is one."""
    if len(np.unique(root)) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    left = np.arange(len(node)) if alone else np.flatnonzero(side == 0)
    right = left if alone else np.flatnonzero(side == 1)
    if not (len(left) and len(right)):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    both = overlaps([sets[i] for i in left], [sets[i] for i in right])
    size = np.array(list(map(len, sets)))
    alike = (both >= similarity * (size[left][:, None] + size[right][None, :] - both)) & (both > 0)
    alike &= root[left][:, None] != root[right][None, :]
    a, b = np.nonzero(alike)
    a, b = left[a], right[b]
    names, of = np.unique(root, return_inverse=True)
    kept = _nearest_forest(len(names), of[a], of[b], np.zeros(len(a), np.int64))
    return a[kept], b[kept]


#: What one pair of blocks is known by.
BLOCK_PAIR = ["unit", "kind", "i", "j"]


def _dealt(members: DataFrame, data: str) -> DataFrame:
    """(unit, kind, i, j, side, node, root, data) for `members` (node, root, size, units): units cut into pairs of blocks.

    The rows of a unit outside its largest component are paired with all others, in pairs of blocks of bounded size,
    each a key of its own. A row carries its data along, so that nothing is joined once per unit.
    """
    units = members.select(F.explode("units").alias("unit"), "node", "root", "size", F.col(data).alias("data"))
    by_root = units.groupBy("unit", "root").agg(F.count("*").alias("n"), F.sum("size").alias("s"))
    largest = by_root.groupBy("unit").agg(
        F.max(F.struct("n", "root", "s")).alias("m"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("roots")
    ).where("roots > 1")

    def blocks(n, s):
        return F.greatest(F.ceil(n / F.lit(BLOCK_ROWS)), F.ceil(s / F.lit(BLOCK_HASHES))).cast("int")

    m = F.col("m")
    shape = largest.select(
        "unit", m["root"].alias("main"), blocks(m["n"], m["s"]).alias("km"), blocks(F.col("n") - m["n"], F.col("s") - m["s"]).alias("kr")
    )
    rows = units.join(shape, "unit").withColumn("rest", F.col("root") != F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("kr")).otherwise(F.col("km"))).cast("int")
    rows = rows.withColumn("own", own)

    def key(kind: int, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    def all_of(k: str, make):
        return F.transform(F.sequence(F.lit(0), F.col(k) - 1), make)

    mine = F.col("own")
    rest = F.concat(
        all_of("kr", lambda j: key(0, F.least(mine, j), F.greatest(mine, j), mine > j)), all_of("km", lambda j: key(1, mine, j, F.lit(0)))
    )
    main = all_of("kr", lambda i: key(1, i, mine, F.lit(1)))
    dealt = rows.select("unit", "node", "root", "data", F.explode(F.when(F.col("rest"), rest).otherwise(main)).alias("k"))
    dealt = dealt.select("unit", "k.kind", "k.i", "k.j", "k.side", "node", "root", "data")
    return dealt.repartition(*BLOCK_PAIR).sortWithinPartitions(*BLOCK_PAIR)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each pair of blocks, which lie one after the other."""
    held, known = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in BLOCK_PAIR], 1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
            now = tuple(keys[s].tolist())
            if held and now != known:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            known = now
    if held:
        yield pa.Table.from_batches(held)


def _columns(whole: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Nodes, roots and sides of a pair of blocks, and whether it is one block with itself."""
    node, root, side = (whole.column(c).to_numpy() for c in ("node", "root", "side"))
    kind, i, j = (whole.column(c)[0].as_py() for c in ("kind", "i", "j"))
    return node, root, side, kind == 0 and i == j


def _suspects(members: DataFrame, seeds: int) -> DataFrame:
    """(unit, node) of the rows of `members` (node, root, size, units, prints) that some other root's row may resemble.

    All fingerprints of all rows are compared, so that sets move only where there is something to compare. What is told
    is rows, at most those of the pair of blocks, never pairs.
    """
    most = most_apart(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _block_pairs(batches):
            node, root, side, alone = _columns(whole)
            left = np.arange(len(node)) if alone else np.flatnonzero(side == 0)
            right = left if alone else np.flatnonzero(side == 1)
            if not (len(left) and len(right)):
                continue
            prints = _prints_of(whole.column("data").combine_chunks())
            near = np.zeros(len(node), bool)
            # Parts of the left side, so that a part has about a million pairs.
            step = max(1, (1 << 20) // len(right))
            for at in range(0, len(left), step):
                some = left[at : at + step]
                apart = np.zeros((len(some), len(right)), np.int32)
                for seed in range(prints.shape[1]):
                    apart += np.bitwise_count(prints[some, seed][:, None] ^ prints[right, seed][None, :])
                close = (apart <= most) & (root[some][:, None] != root[right][None, :])
                near[some] |= close.any(1)
                near[right] |= close.any(0)
            told = node[near]
            unit = np.full(len(told), whole.column("unit")[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(told)], names=["unit", "node"])

    return _dealt(members, "prints").mapInArrow(run, "unit long, node long").distinct()


def _met(members: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect what all alike pairs of different roots within the units do.

    `members` are (node, root, size, units, hashes). The sets are compared, and a pair of blocks tells a forest of true
    links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _block_pairs(batches):
            node, root, side, alone = _columns(whole)
            sets = [np.frombuffer(h, "<u4") for h in whole.column("data").to_pylist()]
            x, y = _alike_links(node, root, side, sets, alone, similarity)
            yield pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], names=["a", "b"])

    return _dealt(members, "hashes").mapInArrow(run, "a long, b long")


def _short_units(nodes: DataFrame, hashes: DataFrame, similarity: float) -> DataFrame:
    """(node, units) for texts of few shingles, in which every alike pair of them meets: prefix filtering.

    An alike text shares at least `similarity` of a set's n elements, so it holds one of any n - ceil(similarity n) + 1
    of them. With one order of elements for all, the first so many of both sets have one in common. Rare elements come
    first, so that few texts meet.
    """
    few = hashes.where(F.length("hashes").between(1, 4 * SHORT_SHINGLES))
    short = nodes.where(F.col("size").between(1, SHORT_SHINGLES)).select("node").join(few, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(h, "<u4") for h in batch.column("hashes").to_pylist()]
            node = np.repeat(batch.column("node").to_numpy(), [len(x) for x in sets])
            items = np.concatenate([np.empty(0, "<u4"), *sets]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(items)], names=["node", "item"])

    items = written(short.mapInArrow(run, "node long, item long"), "items")
    times = items.groupBy("item").agg(F.count("*").alias("n"))
    by_node = items.join(times, "item").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("all"))
    n = F.size("all")
    # A hair less, as the comparison of the sets is in floating point as well.
    first = F.slice("all", F.lit(1), n - F.ceil(n * (similarity - 1e-9) - 1e-9).cast("int") + 1)
    met = F.filter(first, lambda x: x["n"] > 1)
    return by_node.select("node", F.transform(met, lambda x: -1 - x["item"]).alias("units")).where(F.size("units") > 0)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose shingle sets resemble each other that much, by the sets themselves.

    The wanted ids are a table, whose size Spark knows: while it is small, the sets stay where they are and only those
    wanted are written, else all are shuffled once.
    """
    wanted = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted")
    known = written(sets.join(wanted, "node", "left_semi"), "known")
    left = known.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = known.select(F.col("node").alias("b"), F.col("hashes").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                p, q = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(both >= similarity * (len(p) + len(q) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, seeds: int = SEEDS) -> DataFrame:
    """(row, id, group_row) for the rows of `docs` (row, id, text): the group's kept row is the one of the least id.

    Texts link when the sets of their runs of `words` words resemble each other (Jaccard) by at least `similarity`, and
    groups are what links connect. Texts of equal sets are one node. Candidates come from SimHash: pairs that share a
    block of sixteen bits in one of several fingerprints are found below that trie node, within a budget of differing
    bits, and then compared exactly. A crowded node first tells its nearest pairs; once these are joined to groups, all
    its pairs that are still in different groups are compared, block by block. Pairs of texts with at most `SHORT_SHINGLES`
    distinct shingles are found exactly, by rare shingles. Texts without words are alike.

    The result is a table of its own; what was written on the way to it is deleted.
    """
    with scratch(docs.sparkSession):
        return stage(_grouped(docs, words, similarity, seeds), "groups")[0]


def _grouped(docs: DataFrame, words: int, similarity: float, seeds: int) -> DataFrame:
    sets = written(_sets(docs, words, seeds), "sets")
    order = F.struct(F.col("id").isNull(), "id", "row")
    grouped = sets.groupBy("sign").agg(F.min(order).alias("first"), F.first("prints").alias("prints"), F.first(F.length("hashes") / 4).alias("size"))
    nodes = written(grouped.select("sign", F.col("first.row").alias("node"), "first", "prints", F.col("size").cast("long").alias("size")), "nodes")
    hashes = sets.select(F.col("row").alias("node"), "hashes")

    found = written(_unit_pairs(_bands(nodes, seeds), CANDIDATE_BITS), "candidates")
    bits = F.when(F.col("bits") < 0, -1 - F.col("bits")).otherwise(F.col("bits"))
    # Parts of a unit in several tasks are linked by their ends at first, then as a crowded unit.
    parted = found.where("b = -2").groupBy("unit").agg(F.collect_set("a").alias("ends")).where("size(ends) > 1 ")
    joints = parted.select(F.array_min("ends").alias("a"), F.explode("ends").alias("b"), F.lit(-1 - CANDIDATE_BITS).cast("long").alias("bits")).where("a < b")
    pairs = found.where("b >= 0").select("a", "b", "bits").union(joints).groupBy("a", "b").agg(
        F.min(bits).alias("bits"), F.count("*").alias("n"), F.max("bits").alias("open")
    )
    pairs = written(pairs, "pairs")
    # The nearest partner of each text first: that joins large groups with few comparisons.
    best = pairs.groupBy(F.col("b").alias("node")).agg(F.max(F.struct("n", F.negative("bits"), F.negative("a"))).alias("m"))
    chosen = best.select(F.negative(F.col("m").getField("col3")).alias("a"), F.col("node").alias("b"))
    tried = written(chosen, "tried")
    alone = nodes.withColumn("root", F.col("node"))
    links = written(_verified(written(_near_prints(tried, alone, seeds), "near"), hashes, similarity), "links")

    def rooted(links: DataFrame) -> DataFrame:
        roots = components(links)
        joined = nodes.select("sign", "node", "first").join(roots, "node", "left")
        return written(joined.withColumn("root", F.coalesce("root", "node")), "rooted")

    def labelled(now: DataFrame) -> DataFrame:
        return now.select("node", "root").join(nodes.select("node", "size", "prints"), "node")

    now = rooted(links)
    # Crowded nodes are asked again below, so only what the others told is looked at here.
    rest = pairs.where("open >= 0").select("a", "b").join(tried, ["a", "b"], "left_anti")
    rest = written(_near_prints(rest, labelled(now), seeds), "rest")
    links = links.union(written(_verified(rest, hashes, similarity), "links"))
    crowded = found.where("b = -1").select("unit").union(parted.select("unit")).distinct()
    now = rooted(links)
    label = labelled(now)
    members = written(_short_units(nodes, hashes, similarity), "few")
    if not crowded.isEmpty():
        units = found.where("nodes is not null").join(crowded, "unit", "left_semi").select("unit", F.explode("nodes").alias("node"))
        crowds = written(units.groupBy("node").agg(F.collect_set("unit").alias("units")).join(label, "node"), "crowds")
        near = _suspects(crowds, seeds).groupBy("node").agg(F.collect_list("unit").alias("units"))
        # A node is in at most one unit per block of each fingerprint, so its list is bounded.
        members = members.union(written(near.select("node", "units"), "near"))
    members = members.groupBy("node").agg(F.flatten(F.collect_list("units")).alias("units"))
    members = written(members.join(label.drop("prints"), "node"), "asked")
    members = written(hashes.join(members, "node"), "members")
    links = links.union(written(_met(members, similarity), "links"))
    now = rooted(links)
    heads = now.groupBy("root").agg(F.min("first").alias("head"))
    labels = written(now.select("sign", "root").join(heads, "root").select("sign", F.col("head.row").alias("group_row")), "labels")
    return sets.select("row", "id", "sign").join(labels, "sign").select("row", "id", "group_row")
