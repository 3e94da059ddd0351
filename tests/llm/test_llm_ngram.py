import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import ngram


@pytest.mark.parametrize("n,top", [(1, 1), (1, 10), (1000, 2000), (5000, 1 << 40), (3000, 3000), (20000, 1 << 60)])
def test_elias_fano(n, top):
    rnd = np.random.default_rng(n)
    values = np.unique(rnd.integers(0, top, n).astype(np.uint64))
    coded = ngram.EliasFano.of(values)
    assert (coded.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, rnd.integers(0, top, 500).astype(np.uint64), np.array([0, top, 2 * top], np.uint64)])
    place, hit = coded.find(asked)
    assert (hit == np.isin(asked, values)).all()
    assert (place[hit] == np.searchsorted(values, asked[hit])).all()


def test_trie_from_mapped_files(tmp_path):
    rnd = np.random.default_rng(1)
    pairs = np.unique(np.stack([rnd.integers(0, 50, 3000) * 7919, rnd.integers(0, 1 << 40, 3000)], 1), axis=0).astype(np.uint64)
    codes = rnd.integers(0, ngram.ABSENT, len(pairs)).astype(np.uint16)
    ngram.Trie.build(pairs[:, 0], pairs[:, 1], codes).save(str(tmp_path))
    trie = ngram.Trie.open(str(tmp_path))
    assert isinstance(trie.codes, np.memmap) and (trie.lookup(pairs[:, 0], pairs[:, 1]) == codes).all()
    assert (trie.lookup(pairs[:, 0], pairs[:, 1] ^ np.uint64(1)) == ngram.ABSENT).mean() > 0.99
    assert (trie.lookup(pairs[:, 0] + np.uint64(1), pairs[:, 1]) == ngram.ABSENT).all()
    empty = ngram.Trie.build(pairs[:0, 0], pairs[:0, 1], codes[:0])
    assert (empty.lookup(pairs[:, 0], pairs[:, 1]) == ngram.ABSENT).all()


def test_packed_numbers():
    for values in ([], [0], [255, 256, 1 << 40], list(range(1000))):
        assert ngram.unpacked(ngram.packed(np.array(values, np.uint64))).tolist() == values


def check(frame):
    rows = [(r["doc_id"], r["text"] or "", bool(r["held_out"])) for r in frame.collect()]
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t.translate(upper)) + ["\n"] for _, t, _ in rows]
    train = [t for t, (_, _, held) in zip(tokens, rows) if not held]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["start", *t], t))
    n, floor = sum(count.values()), sum(count.values()) + len(count) + 1
    want = []
    for (i, _, held), t in zip(rows, tokens):
        base = sum(math.log10((count[w] + 1) / floor) for w in t)
        score = 0.0
        for a, w in zip(["\n", *t], t):
            k = pairs[("start" if a == "\n" else a, w)]
            k = 10 ** (math.floor(np.log10(k) * ngram.STEPS) / ngram.STEPS) if k else 0
            score += math.log10((k + ngram.PRIOR * (count[w] + 1) / floor) / (count[a] + ngram.PRIOR))
        want.append((str(i), held, len(t), sum(count[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    got = [
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
        for r in ngram.ngram_scores(frame).collect()
    ]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("chars", [8_000_000, 300])
def test_scores_equal_plain_counts(docs, monkeypatch, chars):
    monkeypatch.setattr(ngram, "CHUNK_CHARS", chars)
    monkeypatch.setattr(ngram, "SHARD_TOKENS", 1000)
    check(docs.withColumn("held_out", F.col("doc_id") % 4 == 2))


def test_nothing_learnt_and_nothing_there(docs, no_docs, clashing):
    check(docs.withColumn("held_out", F.lit(True)))
    assert ngram.ngram_scores(no_docs.withColumn("held_out", F.lit(False))).collect() == []
    assert ngram.ngram_scores(clashing.withColumn("held_out", F.lit(None).cast("boolean"))).count() == docs.count()


def test_probabilities_of_all_successors_add_up_to_at_most_one(spark):
    rnd = np.random.default_rng(3)
    texts = [" ".join("abcde"[k] for k in rnd.choice(5, n, p=[0.6, 0.2, 0.1, 0.05, 0.05])) for n in rnd.integers(0, 400, 60)]
    rows = [(i, t, False) for i, t in enumerate(texts)] + [(1000, "", True)]
    rows += [(1001 + i, c, True) for i, c in enumerate("abcdez")]
    rows += [(2000 + 10 * i + j, f"{a} {b}", True) for i, a in enumerate("abcdez") for j, b in enumerate("abcdez")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    score = {r["doc_id"]: r["score"] for r in ngram.ngram_scores(frame).collect()}
    assert max(score.values()) <= 0
    whole = {i: 10 ** score[i] for i in score if i >= 1000}
    # All texts of up to two words from a vocabulary of six are different events.
    assert sum(whole.values()) <= 1


@pytest.mark.parametrize("total", [1, 2, 10, 999, 10**6, 38 * 10**9, 4 * 10**10, 2**62, 2**63 - 1])
def test_counts_are_rounded_down_and_never_saturate(total):
    code = math.floor(np.log10(total) * ngram.STEPS)
    assert 0 <= code < ngram.ABSENT
    assert total / 1.001 <= 10.0 ** (code / ngram.STEPS) <= total * (1 + 1e-12)
