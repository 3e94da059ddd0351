"""Near-duplicates of few words, where fingerprints alone miss one pair in ten."""

import random

from tallyspark.llm import simhash


def test_short_near_copies_all_meet(spark):
    rnd = random.Random(11)
    pairs = []
    for k in range(400):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(8 if k % 2 else 19)]
        # 4 of 5 shingles, or 12 of 15 with a change at the end.
        pairs.append((base, base + ["more"]) if k % 2 else (base[:16], base))
    texts = [" ".join(t) for p in pairs for t in p]
    frame = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, id long, text string")
    got = {r["row"]: r["group_row"] for r in simhash.near_duplicates(frame).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_short_texts_on_a_common_line(spark):
    rnd = random.Random(12)
    line = [f"c{i}" for i in range(12)]
    texts = [" ".join(line + [f"u{rnd.random()}" for _ in range(rnd.randint(0, 4))]) for _ in range(60)]
    texts += [" ".join(f"d{rnd.randrange(3)}" for _ in range(rnd.randint(1, 12))) for _ in range(60)]
    frame = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, id long, text string")
    got = {r["row"]: r["group_row"] for r in simhash.near_duplicates(frame).collect()}
    sets = [frozenset(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    want = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if len(x & y) >= 0.8 * len(x | y) and want[b] > want[a]:
                    want[b], changed = want[a], True
    assert got == dict(enumerate(want))
