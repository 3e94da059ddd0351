import random
import re

import pytest

from tallyspark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        found = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append(m.span())
        out[kind] = found
    return out


def test_base_spans_equal_the_patterns():
    rnd = random.Random(1)
    kits = ["a@.b", "1 2.", "0-+ ()", "12..3", "a_@é. 1", "0045 ", "9.1.2"]
    for _ in range(20000):
        text = "".join(rnd.choice(rnd.choice(kits)) for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize(
    "text,kind,source",
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("john.d at mail7 dot example dot com, ok", "email", "john.d at mail7 dot example dot com"),
        ("ein j.d at host punkt de bitte", "email", "j.d at host punkt de"),
        ("x j＠ex.com x", "email", "j＠ex.com"),
        ("é jоhn@ехample.com", "email", "jоhn@ехample.com"),
        ("c(at)d.org", "email", "c(at)d.org"),
        ("call plus one (five five five) 555 seven seven one three !", "phone", "plus one (five five five) 555 seven seven one three"),
        ("+1 five five five 555 0271", "phone", "+1 five five five 555 0271"),
        ("ip 97 dot 51 dot 17 dot 173.", "ip", "97 dot 51 dot 17 dot 173"),
        ("97[.]51[.]17[.]173", "ip", "97[.]51[.]17[.]173"),
        ("eins neun zwei punkt eins sechs acht punkt null punkt eins", "ip", "eins neun zwei punkt eins sechs acht punkt null punkt eins"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("four 111 1111 1111 1111", "card", "four 111 1111 1111 1111"),
    ],
)
def test_disguises_map_back_to_their_source(text, kind, source):
    base, extra = pii.all_spans(text)
    assert not any(base.values())
    assert [text[s:e] for s, e in extra[kind]] == [source]
    assert sum(map(len, extra.values())) == 1


@pytest.mark.parametrize(
    "text",
    ["", "we met at noon point un deux", "one two three", "look at the dot on the i", "un deux trois quatre", "at 3 dot", "a [at] b", "Привет мир, all",
     "version 1 dot 2 dot 3", "four one one one 1111 1111 1111 1112"],
)
def test_clean_texts_stay(text):
    assert not any(pii.all_spans(text)[1].values())
    assert pii.masked(text) == text


def test_base_spans_win_and_masks_cover_both():
    text = "a@b.com and c(at)d.org, +1 (974) 555-3436"
    base, extra = pii.all_spans(text)
    assert [text[s:e] for s, e in base["email"]] == ["a@b.com"] and [text[s:e] for s, e in extra["email"]] == ["c(at)d.org"]
    assert pii.masked(text) == "[EMAIL] and [EMAIL], [PHONE]"


def test_long_runs_take_linear_time():
    for text in ("1" * 200000, "a." * 100000, "1." * 70000, "a@" * 70000, "+1" * 70000, "one " * 20000, "( " * 70000, " " * 100000 + "at "):
        pii.all_spans(text)


def test_awkward_rows(docs, clashing, no_docs, spark):
    rows = pii.find(docs, keep=["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        base, extra = pii.all_spans(r["text"] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(base[k]) for k in pii.KINDS]
    assert pii.find(clashing).count() == docs.count() and pii.find(no_docs).collect() == []
    masked = pii.mask(docs)
    assert masked.schema == docs.schema or masked.columns == docs.columns
    assert {r["doc_id"] for r in masked.where("text is null").collect()} == {5, None}
    one = spark.createDataFrame([(1, "to a@b.com", 99)], "doc_id long, text string, n_chars int")
    assert tuple(pii.mask(one).first()) == (1, "to [EMAIL]", 10)
