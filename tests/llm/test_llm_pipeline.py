import random

import pytest

import corpus_pipeline as pipeline
from tallyspark.llm import quality, simhash, toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(3)
    fresh = lambda n: " ".join("".join(rnd.choice("abdegiklmnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    docs, labels = [], []
    for i in range(300):
        text = fresh(rnd.randint(30, 90)) + "."
        toxic, good = int(i % 6 == 1), int(i % 5 != 2)
        if toxic:
            text = f"you idiot, {text} what a pathetic loser."
        if not good:
            text = " | ".join(text.split())
        docs.append((i, text, "en", "src0", len(text)))
        labels.append((i, good, toxic))
    clean = [d for d, (_, g, t) in zip(docs, labels) if g and not t]
    copies = [(1000 + k, d[1], "en", "src1", d[4]) for k, d in enumerate(clean[:10])]
    near = [(2000 + k, d[1].replace(d[1].split()[5], "changed", 1), "en", None, d[4]) for k, d in enumerate(clean[10:20])]
    extra = [(3000, f"Write to me@example.org or {fresh(40)}.", None, None, None), (3001, None, None, None, None), (3002, "", "en", "s", 0)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs + copies + near + extra, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def plain_kept(docs, folder, spark):
    """The four filters and the mask, row by row."""
    tables = [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]
    good, bad = quality.train(*tables), toxicity.train(*tables)
    bad.lexicon.ready()
    rows = [r for r in docs if good.score(__import__("numpy").array([quality.features(r["text"] or "")]))[0] >= 0.3]
    rows = [r for r in rows if bad.score([r["text"] or ""])[0] < 0.5]
    kept, sets = [], []
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        s = set(simhash.shingle_hashes(r["text"] or "", 5).tolist())
        if not any(s == o or len(s & o) >= 0.8 * len(s | o) for o in sets):
            kept.append(r["doc_id"])
        sets.append(s)
    return kept


def test_stages_follow_each_other(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "toxicity", "simhash_near_dedup", "pii", "packing"]
    now = docs
    for _, stage in pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns
    kept = {r["doc_id"]: r for r in now.collect()}
    assert sorted(kept) == plain_kept(docs.collect(), folder, spark)
    assert kept[3000]["text"].startswith("Write to [EMAIL] or ") and kept[3000]["n_chars"] == len(kept[3000]["text"])
    assert not any(1000 <= i < 2000 for i in kept) and sum(2000 <= i < 3000 for i in kept) < 10
    pieces = pipeline.run(spark, folder)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(kept)
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()


def test_stages_take_empty_and_awkward_tables(spark, folder, docs, no_docs, clashing):
    for name, stage in pipeline.STAGES:
        assert stage(spark, no_docs, folder).collect() == []
        out = stage(spark, clashing, folder)
        rows = out.collect()
        assert rows
        if name != "packing":
            assert out.columns == clashing.columns and rows[0]["score"] == "own score"


def test_kept_texts_stay_where_they_are(spark, monkeypatch):
    rnd = random.Random(8)
    docs = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(12)), "en", None, 90) for i in range(6000)]
    docs += [(10_000 + i, docs[i][1], "en", None, 90) for i in range(0, 6000, 3)] + [(None, None, None, None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # The words of 64 rows are below this, the numbers of the kept rows above it.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        kept = pipeline.simhash_near_dedup(spark, frame, "")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        ids = [r["doc_id"] for r in kept.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(ids, key=lambda i: -1 if i is None else i) == [None, *range(6000)]
