import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import infill


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(frame, rows):
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    moved = infill.infill(frame, keep=["doc_id"])
    back = infill.restore(moved, keep=columns)
    got = sorted(((r["doc_id"], *(r[c] for c in columns[1:]), r["restored"]) for r in back.collect()), key=repr)
    assert got == sorted(((i, *plain(i, t), t or "") for i, t in rows), key=repr)


def test_equals_plain(spark, docs):
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_many_forms_and_marks(spark, monkeypatch):
    rnd = random.Random(3)
    alphabet = ["<", ">", "P", "S", "M", "<P", "S>", "é", "日", "🙂", "a", " ", "\n"]
    rows = [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30)))) for i in range(400)]
    rows += [(1000 + i, "x" + m + "y") for i, m in enumerate(("<P>", "<S>", "<M>"))]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), rows)


def test_clashing_and_empty(spark, clashing, docs, no_docs):
    check(clashing, [(r["doc_id"], r["text"]) for r in docs.collect()])
    check(no_docs, [])
    assert "_text" in infill.infill(clashing, keep=["_text", "doc_id"]).columns
    with pytest.raises(ValueError, match="named like results"):
        infill.infill(docs.withColumn("form", F.lit(1)), keep=["form"])


@pytest.mark.parametrize("step", [1, 2, 3, 7, 64])
def test_steps_do_not_matter(monkeypatch, step):
    monkeypatch.setattr(infill, "STEP", step)
    rnd = random.Random(step)
    texts = ["".join(rnd.choice("aé日🙂<P") for _ in range(rnd.randint(0, 12))) for _ in range(60)] + ["", ""]
    texts = [t.replace("<P>", "") for t in texts]
    kind = np.array([rnd.randint(0, 2) if t else 0 for t in texts])
    cuts = [sorted((rnd.randint(0, len(t)), rnd.randint(0, len(t)))) for t in texts]
    prefix, middle = np.array([a for a, _ in cuts]), np.array([b - a for a, b in cuts])
    array = pa.array(["skipped", *texts]).slice(1)
    out = infill.rearranged(array, kind, prefix, middle)
    for text, k, (a, b), got in zip(texts, kind, cuts, out.to_pylist()):
        p, m, s = text[:a], text[a:b], text[b:]
        assert got == (text, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}")[k]
    assert infill.restored(out, kind).to_pylist() == texts


def test_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(infill, "SLICE_CHARS", 10)
    batch = pa.RecordBatch.from_pydict({"t": ["", "abc", "defg", "x" * 30, "", "hi", "y" * 10, ""]})
    got = [p.column("t").to_pylist() for p in infill.parts(iter([batch]), "t")]
    assert got == [["", "abc", "defg"], ["x" * 30], ["", "hi"], ["y" * 10, ""]]
    assert list(infill.parts(iter([batch.slice(0, 0)]), "t")) == []


def test_broken_outputs_are_refused(spark):
    bad = spark.createDataFrame([("no marks here", "psm")], "output string, form string")
    with pytest.raises(Exception, match="just once"):
        infill.restore(bad, keep=[]).collect()
    odd = spark.createDataFrame([(None, "plain"), ("<P>", None)], "output string, form string")
    assert [r[0] for r in infill.restore(odd, keep=[]).collect()] == ["", "<P>"]
