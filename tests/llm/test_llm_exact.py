import hashlib

import pytest
from pyspark.sql import functions as F

from tallyspark.llm.digest_index import DigestIndex, digested, exact_duplicates
from tallyspark.session import fresh_dir


def plain(rows):
    """(doc_id, keep_id, group_size, sha) of every row, kept ids by group."""
    def key(text):
        return hashlib.sha256("".join(c for c in text or "" if c not in " \t\n\x0b\f\r").encode()).hexdigest()

    groups = {}
    for i, text in rows:
        groups.setdefault(key(text), []).append((-len(text or ""), i is None, i if i is not None else 0, i))
    return sorted(((i, min(groups[key(t)])[3], len(groups[key(t)]), key(t)) for i, t in rows), key=repr)


def check(frame, rows):
    got = frame.collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == plain(rows)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_equals_plain(spark, docs):
    check(exact_duplicates(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_batches_give_what_one_load_gives(spark, docs, clashing):
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 100).withColumn("text", F.concat(F.lit(" "), "text")))
    rows = [(r["doc_id"], r["text"]) for r in many.collect()]
    check(exact_duplicates(many, batch=F.pmod(F.coalesce("doc_id", F.lit(1)), F.lit(3))), rows)
    check(exact_duplicates(clashing), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark, no_docs):
    assert exact_duplicates(no_docs).collect() == []


def test_text_ids(spark):
    rows = [("b", "x y"), ("a", "xy "), (None, "xy  "), ("c", "z")]
    check(exact_duplicates(spark.createDataFrame(rows, "doc_id string, text string")), rows)


def frame(spark, *rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_index_persists_and_only_grows(spark):
    path = fresh_dir(spark, "index")
    first = frame(spark, (5, "a b"), (6, "c"), (7, "c"))
    exact_duplicates(first, DigestIndex.create(spark, path, 3), F.lit("monday"))
    before = {f for f in spark.read.parquet(f"{path}/digests").inputFiles()}
    again = DigestIndex(spark, path)  # as another session would open it
    got = exact_duplicates(frame(spark, (1, "a  b"), (8, "c"), (9, "d")), again, F.lit("tuesday")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(1, 1, 2, True), (8, 6, 3, False), (9, 9, 1, True)}
    assert before <= set(spark.read.parquet(f"{path}/digests").inputFiles())
    firsts = {(r["batch"], r["n"]) for r in again.rows().where("first").groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert firsts == {("monday", 2), ("tuesday", 1)}
    state = sorted(map(repr, again.groups().collect()))
    again.add(digested(frame(spark, (1, "a  b"), (8, "c"), (9, "d"))), "tuesday")  # a batch that is added again changes nothing
    assert [(r.group_size) for r in again.groups().orderBy("digest").collect()] == [r.group_size for r in DigestIndex(spark, path).groups().orderBy("digest").collect()]
    assert len(state) == again.groups().count()
    small = again.compacted(fresh_dir(spark, "index"))
    assert {(bytes(r.digest), r.best.id, r.group_size) for r in small.groups().collect()} == {(bytes(r.digest), r.best.id, r.group_size) for r in again.groups().collect()}


def test_the_index_does_not_move(spark):
    """Both sides of the anti-join lie in the same buckets, and groups are summed where they lie."""
    index = DigestIndex.create(spark, fresh_dir(spark, "index"), 10)
    index.add(digested(frame(spark, (1, "a"), (2, "b"))), "x")
    assert "Exchange" not in index.groups()._jdf.queryExecution().executedPlan().toString()
    sent, name = index._laid_out(index.rows().select("digest"))
    anti = sent.join(index.rows().select("digest").hint("merge"), "digest", "left_anti")
    plan = anti._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("rows,buckets", [(0, 8), (1, 8), (20_000_000, 16), (20_000_000_000, 16384)])
def test_buckets_grow_with_rows(spark, rows, buckets):
    assert DigestIndex.create(spark, fresh_dir(spark, "index"), rows).buckets == buckets


def test_hot_group(spark):
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(600)]
    check(exact_duplicates(frame(spark, *rows).repartition(6)), rows)
