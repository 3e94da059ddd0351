"""Personal data in texts, also where it is disguised: transducers that keep source offsets."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, schema_with, slices, with_text

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int]

# Detection in plain text

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> list[Span]:
    """Linear in the text: each @ is extended to both sides, a local part never reaches into the match before."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return found


def _ips(text: str) -> list[Span]:
    found, at = [], 0
    # A match can only begin where a run of digits begins, so a long run is read once.
    for m in re.finditer(r"(?<![0-9])[0-9]++(?=\.[0-9])", text):
        if m.start() < at:
            continue
        whole = _IP.match(text, m.start())
        if whole:
            at = whole.end()
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in whole[0].split(".")):
                found.append(whole.span())
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _cards(text: str) -> list[Span]:
    found = []
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(m.span())
    return found


def _phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in code points, leftmost and without overlaps within a kind."""
    return {kind: find(text) for kind, find in _FINDERS.items()}


# Disguises. Words for digits and signs in English, German, French and Spanish.

DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
DOT_WORDS = ("dot", "punkt", "point", "punto")
AT_WORDS = ("at", "arroba", "arobase")
#: Words that stand bare, without brackets, only count in pairs of one language.
PAIRS = (("at", "dot"), ("at", "punkt"), ("arroba", "punto"), ("arobase", "point"))
#: Domains that end an address told in bare words.
DOMAINS = "com org net edu gov mil info biz io co eu uk us ca au at de ch fr be es it nl pt mx ar br cl in cn jp kr ru pl se no dk fi cz ie nz za app dev ai".split()
#: Letters of other scripts that look like the Latin letter.
LOOKALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "｡": ".", "·": ".", "∙": ".",
}

_INVISIBLE = frozenset("\u00ad\u200b\u200c\u200d\u2060\ufeff")


def _plain(char: str) -> str | None:
    """What a character stands for: a Latin letter, a sign, a digit, nothing, or None for itself."""
    if char in _INVISIBLE:
        return ""
    if char in LOOKALIKES:
        return LOOKALIKES[char]
    digit = unicodedata.decimal(char, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", char)
    return folded if len(folded) == 1 and folded.isascii() else None


def _signs(words: tuple[str, ...], sign: str) -> str:
    # Blanks before a bracket are only read from where they begin, so that long runs take linear time.
    return rf"(?:(?<!\s)\s+)?[\[({{<]\s*(?:{'|'.join(words)}|{re.escape(sign)})\s*[\])}}>]\s*"


_NUMBER = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_DOT_IN = _signs(DOT_WORDS, ".")
_AT_IN = _signs(AT_WORDS, "@")
_DOT_BARE = rf"(?<=[A-Za-z0-9])\s+(?:{'|'.join(DOT_WORDS)})\s+(?=[A-Za-z0-9])"
_LABEL = "[A-Za-z0-9-]{1,63}"
#: The at word alone counts only before names with disguised dots that end in a common domain.
_AT_BARE = "|".join(
    rf"(?<=[A-Za-z0-9])\s+{at}\s+(?={_LABEL}(?:(?:{_DOT_IN}|\s+{dot}\s+){_LABEL}){{0,4}}?(?:{_DOT_IN}|\s+{dot}\s+)(?:{'|'.join(DOMAINS)})\b)"
    for at, dot in PAIRS
)
# Between two spelled digits a blank or hyphen belongs to the reading, not to the number.
_DIGIT = rf"\b(?P<digit>{_NUMBER})\b(?:[ -](?=(?:{_NUMBER})\b))?"
_PLUS = rf"\bplus\s+(?=[0-9]|(?:{_NUMBER})\b)"
_REWRITE = re.compile(
    rf"(?P<at>{_AT_IN}|{_AT_BARE})|(?P<dot>{_DOT_IN}|{_DOT_BARE})|(?P<plus>{_PLUS})|{_DIGIT}", re.IGNORECASE
)

# ASCII and the letters of the four languages cannot be disguises.
_STRANGE = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿœŒŸ]")


def _strange(text: str) -> bool:
    """Whether any character of the text stands for another one or for nothing."""
    return not text.isascii() and any(_plain(c) is not None for c in set(_STRANGE.findall(text)))


_OPEN = re.compile(rf"[\[({{<]\s*(?:{'|'.join((*AT_WORDS, *DOT_WORDS))}|[@.])\s*[\])}}>]")
_DOT_WORD = re.compile(rf"\s(?:{'|'.join(DOT_WORDS)})\s")
_PLUS_WORD = re.compile(_PLUS)
_WORDS = re.compile(r"\w+")
_NEAR = re.compile(rf"\b(?:{_NUMBER})[ .-](?:[0-9]|(?:{_NUMBER})\b)|[0-9][ .-](?:{_NUMBER})\b")


def _lower(text: str) -> str:
    """Lower case as IGNORECASE takes it, where the Turkish letters match i as well."""
    return text.lower() if text.isascii() else text.replace("İ", "i").replace("ı", "i").lower()


def disguised(text: str) -> bool:
    """False only if the transducers cannot add a span; cheaper than running them.

    The at word alone needs a disguised dot. A spelled digit matters in a card or ip only beside a digit or another
    spelled digit, with at most one blank, hyphen or dot between, and else in texts with a plus or an at sign.
    """
    if _strange(text):
        return True
    low = _lower(text)
    if any(w in low for w in DOT_WORDS) and _DOT_WORD.search(low):
        return True
    if ("[" in low or "(" in low or "{" in low or "<" in low) and _OPEN.search(low):
        return True
    if "plus" in low and _PLUS_WORD.search(low):
        return True
    if DIGIT_WORDS.keys().isdisjoint(_WORDS.findall(low)):
        return False
    return "+" in low or "@" in low or _NEAR.search(low) is not None


def transduce(text: str) -> tuple[str, list[int], list[int], list[int]]:
    """The text without disguises, and for each of its characters where its source begins and ends and if it is new.

    First each character is replaced by what it looks like, then words and bracketed signs by what they stand for. Both
    steps write down the source range of every character they emit, so that the composition maps spans back.
    """
    chars, begin, end, new = [], [], [], []
    if not _strange(text):
        chars, begin, end, new = [text], list(range(len(text))), list(range(1, len(text) + 1)), [0] * len(text)
    for i, c in enumerate("" if chars else text):
        plain = None if c.isascii() else _plain(c)
        if plain == "":
            if end:
                end[-1] = i + 1
                new[-1] = 1
            continue
        chars.append(plain or c)
        begin.append(i)
        end.append(i + 1)
        new.append(int(plain is not None))
    middle = "".join(chars)
    out, begins, ends, news, at = [], [], [], [], 0
    for m in _REWRITE.finditer(middle):
        a, b = m.span()
        sign = "@" if m["at"] else "." if m["dot"] else "+" if m["plus"] else DIGIT_WORDS[_lower(m["digit"])]
        out += [middle[at:a], sign]
        begins += begin[at:a]
        ends += end[at:a]
        news += new[at:a]
        # Blanks around a word are no part of its digit.
        last = m.end("digit") if m["digit"] else b
        begins.append(begin[a])
        ends.append(end[last - 1])
        news.append(1)
        at = b
    out.append(middle[at:])
    return "".join(out), begins + begin[at:], ends + end[at:], news + new[at:]


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and those that only show once disguises are lifted; the latter never overlap a base span of their kind."""
    base = base_spans(text)
    extra: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if disguised(text):
        plain, begin, end, new = transduce(text)
        changed = [0]
        for x in new:
            changed.append(changed[-1] + x)
        for kind in KINDS:
            taken = base[kind]
            starts = [s for s, _ in taken]
            for s, e in _FINDERS[kind](plain):
                if changed[e] == changed[s]:
                    continue
                span = begin[s], end[e - 1]
                i = bisect_left(starts, span[1])
                if not (i and taken[i - 1][1] > span[0]):
                    extra[kind].append(span)
    return base, extra


def _told(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def find(docs: DataFrame, keep: list[str] | None = None, text_column: str = "text") -> DataFrame:
    """The kept columns (default: all) with counts of base spans by kind, `base` and `spans` as kind:start:end lists.

    Offsets are code points, ends exclusive; lists go by kind, then by start. A null or empty text has no spans. Whole
    texts are read, in time linear in their length. Columns of the input named like a result column are left out.
    """
    new = [f"n_{k}" for k in KINDS] + ["n_disguised", "base", "spans"]
    keep = [c for c in docs.columns if c not in new] if keep is None else keep
    chosen, name = with_text(docs, keep, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, name):
            found = [all_spans(t) for t in texts]
            counts = {f"n_{k}": pa.array([len(b[k]) for b, _ in found], pa.int64()) for k in KINDS}
            merged = [{k: sorted(b[k] + x[k]) for k in KINDS} for b, x in found]
            yield beside(
                part, keep, **counts,
                n_disguised=pa.array([sum(map(len, x.values())) for _, x in found], pa.int64()),
                base=pa.array([_told(b) for b, _ in found]), spans=pa.array([_told(m) for m in merged]),
            )

    ddl = ", ".join(f"n_{k} long" for k in KINDS) + ", n_disguised long, base string, spans string"
    return chosen.mapInArrow(run, schema_with(docs, keep, ddl))


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced together."""
    base, extra = all_spans(text)
    spans = sorted((s, e, k) for k in KINDS for s, e in base[k] + extra[k])
    out, at = [], 0
    for s, e, kind in spans:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]]) if spans else text


def mask(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """The documents with personal data masked in the text; a null text stays null, the length column follows the text."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text_column):
            valid = part.column(text_column).is_valid().to_pylist()
            clean = [masked(t) if v else None for t, v in zip(texts, valid)]
            columns = {c: part.column(c) for c in names}
            columns[text_column] = pa.array(clean, part.schema.field(text_column).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    out = docs.mapInArrow(run, docs.schema)
    if length_column in names:
        kind = docs.schema[length_column].dataType
        out = out.withColumn(length_column, F.length(text_column).cast(kind))
    return out
