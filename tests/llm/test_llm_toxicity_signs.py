"""Words and clauses also end at signs outside ASCII."""

import sys

import pytest

from tallyspark.llm import toxicity


def clauses(text):
    lexicon = toxicity.base_lexicon()
    lexicon.ready()
    return [(text[s:e], round(w, 3)) for s, e, w in toxicity.clause_weights(text, lexicon)]


@pytest.mark.parametrize("text", ["¡Idiota!", "«idiot»", "“moron", "scum”", "you scum ", "—idiot—", "„Abschaum“", "‘trash’", "all scum…"])
def test_insults_beside_signs(text):
    assert len(clauses(text)) == 1


def test_a_longer_lower_case_keeps_clauses():
    text = "He said it in İstanbul. You idiot! İİİ. All is fine. Scum"
    plain = text.replace("İ", "I")
    assert [(c.replace("İ", "I"), w) for c, w in clauses(text)] == clauses(plain)
    assert [c for c, _ in clauses(text)] == [" You idiot", " Scum"]


def test_sentence_signs_of_other_scripts_end_clauses():
    assert len(clauses("you fool… you scum！you trash。you idiot")) == 4


def test_positions_stay():
    every = "".join(chr(c) for c in range(sys.maxunicode + 1))
    assert len(toxicity.spaced(every)) == len(every)
    assert toxicity.spaced("İmbécile Ünd²!") == "imbécile ünd² "
