import random
import zlib

import numpy as np
import pytest

from tallyspark.llm import quality, toxicity
from tallyspark.llm.labelled import held_out, training_sample



def area(score, label):
    good, bad = score[label == 1], score[label == 0]
    return np.mean([(g > bad).mean() + 0.5 * (g == bad).mean() for g in good])


def words(rnd, n):
    return [rnd.choice("alpha beta gamma delta river stone house garden winter summer".split()) + str(rnd.randint(0, 99)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    """Good and bad texts, toxic and clean ones, with an insult that only the labels reveal."""
    rnd = random.Random(7)
    docs, labels = [], []
    for i in range(600):
        w = words(rnd, rnd.randint(5, 80))
        toxic, good = int(rnd.random() < 0.25), int(rnd.random() < 0.8)
        if toxic:
            for _ in range(rnd.randint(1, 3)):
                w.insert(rnd.randrange(len(w)), rnd.choice(["idiot", "scum", "blorfo" + rnd.choice("abcdefgh")]))
        text = " ".join(w) + "."
        if not good:
            text = rnd.choice([" | ".join(w), " ".join(x + "!!" for x in w).upper(), " ".join(x for x in w for _ in range(4))])
        docs.append((i, text))
        labels.append((i, good, toxic))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels}


def test_fold_and_sample(corpus, spark):
    docs, labels, _ = corpus
    for r in docs.select("doc_id", held_out().alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    learnt = training_sample(docs.select("doc_id", docs["doc_id"].cast("string").alias("text")), labels, "toxic").collect()
    assert learnt and all(zlib.crc32(r["text"].encode()) % 5 for r in learnt)
    assert training_sample(docs, labels, "toxic", 10).count() == 10
    holes = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, toxic int")
    assert training_sample(docs, holes, "toxic").count() == 1


def test_held_out_accuracy(corpus):
    docs, labels, truth = corpus
    for module, k, least in ((quality, 0, 0.97), (toxicity, 1, 0.97)):
        scored = module.score(docs, module.train(docs, labels), keep=["doc_id"])
        rows = [(r["score"], truth[r["doc_id"]][k]) for r in scored.select("doc_id", "score", held_out().alias("h")).where("h").collect()]
        score, label = np.array([s for s, _ in rows]), np.array([y for _, y in rows])
        assert area(score, label) > least and ((score >= 0.5) == label).mean() > 0.93


def test_awkward_rows_and_no_labels(corpus, docs, clashing, no_docs, spark):
    some, labels, _ = corpus
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        for known in (labels, nothing):
            model = module.train(some, known)
            rows = module.score(docs, model).collect()
            assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
            assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
        assert module.score(clashing, model).count() == docs.count()
        assert module.score(clashing, model, column="_kept").select("score", "_kept").first()["score"] == "own score"
        assert module.score(no_docs, model).collect() == []


def test_lookup_tables_add_up():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 4))
    logit = np.where(x[:, 0] > 0.5, 2.0, -1.0) + 2.5 * np.sign(x[:, 1] * x[:, 2])
    y = (rnd.random(3000) < 1 / (1 + np.exp(-logit))).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert (1, 2) in model.pairs  # only the pair explains this part
    assert area(model.score(x[2000:]), y[2000:]) > 0.85
    by_hand = model.intercept
    for f in range(4):
        by_hand += model.tables[f][int((model.edges[f] <= x[5, f]).sum())]
    for (f, g), values in zip(model.pairs, model.pair_tables):
        by_hand += values[int((model.coarse[f] <= x[5, f]).sum()), int((model.coarse[g] <= x[5, g]).sum())]
    assert model.logit(x[5:6])[0] == pytest.approx(by_hand)


def test_degenerate_fits():
    assert 0 < quality.fit(np.zeros((5, 3)), np.ones(5)).score(np.zeros((1, 3)))[0] < 1
    assert quality.fit(np.empty((0, 3)), np.empty(0)).score(np.zeros((1, 3)))[0] == 0.5
    assert len(quality.features("")) == len(quality.features("A b.")) == len(quality.FEATURES)


def weight(text):
    lexicon = toxicity.base_lexicon()
    lexicon.ready()
    return [round(w, 3) for *_, w in toxicity.clause_weights(text, lexicon)]


def test_grammar_scores_clauses():
    aimed, loose = weight("You are an idiot."), weight("An idiot walks by.")
    assert aimed > loose > weight("He said idiot.")[:1] or aimed > loose
    assert weight("you are not an idiot") < aimed
    assert weight("he said you are an idiot") < aimed
    assert weight("idiot you are") == aimed
    assert weight("we will kill time") == [] and weight("I will kill you") != []
    assert weight("Not now. You idiot!") == aimed  # a negation ends with its clause
    assert weight("not that this is, an idiot") == loose or weight("not that this is, an idiot") == aimed
    assert weight("idiotic, foolish") != [] and weight("anidiot") == []
    assert weight("") == weight("all is well.") == []
    assert len(weight("you fool\nyou scum! you trash")) == 3


def test_clause_positions():
    lexicon = toxicity.base_lexicon()
    lexicon.ready()
    text = "Fine. Ünd you are SCUM!! ok"
    (start, end, _), = toxicity.clause_weights(text, lexicon)
    assert text[start:end] == " Ünd you are SCUM"


def test_long_text_without_clauses():
    lexicon = toxicity.base_lexicon()
    lexicon.ready()
    assert len(toxicity.clause_weights("you idiot " * 20000, lexicon)) == 1
    assert len(toxicity.clause_weights("you idiot. " * 20000, lexicon)) == 20000


def test_only_families_become_beginnings():
    counts = {f"blorfo{c}": (6, 0) for c in "abcdefgh"} | {"blor*": (48, 0), "trash": (40, 0), "tras*": (40, 0), "table": (30, 200)}
    units = dict(toxicity.learned(counts, 100, 900))
    assert "blor*" in units and "trash" in units and "tras*" not in units and "table" not in units
    assert "bloarfoa" not in units
