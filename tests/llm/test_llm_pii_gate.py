"""Disguises are lifted wherever they stand, whatever else is in the document."""

import random

import pytest

from tallyspark.llm import pii


@pytest.mark.parametrize(
    "source,kind",
    [("192.168.0.one", "ip"), ("192.168.one.5", "ip"), ("un.2.3.4", "ip"), ("4111 1111 1111 111 one", "card"), ("4111-1111-1111-111-one", "card"),
     ("plus 49 30 1234567", "phone"), ("+1 974 555 six", "phone"), ("john [at] example.com", "email")],
)
def test_found_with_and_without_other_disguises(source, kind):
    for text in (f"see {source} there", f"see {source} there, a dot b", f"see {source}; ａ"):
        base, extra = pii.all_spans(text)
        assert [text[s:e] for s, e in extra[kind]] == [source]
        assert pii.masked(text).startswith(f"see [{kind.upper()}]")


def test_blanks_and_brackets_in_a_row():
    text = "a  [at]   [at] b (dot)   (dot) c"
    assert pii.transduce(text)[0] == "a@@b..c"
    pii.all_spans("one " + " " * 200000 + "( " * 50000 + "x" + " " * 200000)


def test_addresses_left_out_on_purpose():
    assert pii.masked("look at example.com") == "look at example.com"


def test_gate_loses_nothing(monkeypatch):
    rnd = random.Random(8)
    kits = ["one un fünf Zéro SİX two".split(), list("0123456789") + ["1111", "192", "168"], [".", " ", "-", ". ", " - ", ""], ["@", "+", "(", ")", "[at]", " at ", " dot ", "(.)", " plus "], ["a", "x.com", "“", "_", "é"]]
    texts = []
    for _ in range(6000):
        some = [rnd.choice(rnd.choices(kits, (3, 3, 5, 1, 1))[0]) for _ in range(rnd.randint(1, 30))]
        texts += ["".join(some), "one.".join(rnd.choice(["7", "255.", "nine", " ", "2."]) for _ in range(5))]
        card = [str(rnd.randrange(10)) for _ in range(15)]
        card += [d for d in "0123456789" if pii._luhn("".join(card) + d)]
        spelled = {d: w for w, d in pii.DIGIT_WORDS.items()}
        k = rnd.randrange(16)
        texts.append(" ".join([*card[:k], spelled[card[k]], *card[k + 1 :]]))
    found = [pii.all_spans(t) for t in texts]
    monkeypatch.setattr(pii, "disguised", lambda text: True)
    for text, had in zip(texts, found):
        assert pii.all_spans(text) == had, text
    assert sum(any(x.values()) for _, x in found) > 6000
