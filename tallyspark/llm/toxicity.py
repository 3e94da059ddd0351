"""Toxic clauses by composed weighted transducers over words."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, schema_with, slices, with_text
from .labelled import MAX_ROWS, training_sample

# Words of each class in English, German, French and Spanish; a star stands for any ending.

INSULTS = (
    "idiot* moron* stupid* dumb* fool* loser* pathetic worthless disgusting scum trash clown* imbecile* filth* vermin "
    "dumm* trottel abschaum widerlich* wertlos* versager* "
    "imbécile* crétin* abruti* ordure* minable* dégoûtant* "
    "imbécil* idiota* estúpid* basura asqueros* escoria patétic* inútil*"
).split()
THREATS = (
    "kill* hurt* beat* destroy* shoot* stab* punch* burn* hang* "
    "töte* umbring* schlag* erschieß* tuer* tue frapp* détruir* matar* mataré golpe* destru*"
).split()
TARGETS = (
    "you your yours yourself he she him her they them these those this u ur "
    "du dich dir dein* ihr euch sie er tu toi te vous ton ta votre il elle ils tú ti usted* él ella ellos vos"
).split()
NEGATIONS = "not no never isn aren wasn don doesn didn won nicht kein* nie niemals pas jamais aucun* nunca jamás ningún tampoco".split()
REPORTS = "said says say saying called calls wrote writes quoted quotes reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()

#: A negation reaches this many words ahead.
REACH = 3
#: What is left of a weight after a negation, and in reported speech.
NEGATED, REPORTED = 0.3, 0.5
#: Weight of an insult aimed at somebody against one that stands alone, of a threat with and without a target.
AIMED, LOOSE, THREAT_AIMED, THREAT_LOOSE = 1.0, 0.85, 0.5, 0.0

#: Units (words or their beginnings) kept from labelled texts at most, and how often one must occur in toxic texts.
MAX_UNITS, MIN_TEXTS = 2000, 4
PREFIX_SIZES = (4, 5, 6, 7)

_SOLID = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_CLAUSE_END = re.compile("[.!?;\n\u0085\u2028\u2029…‽。．｡！？；؟۔।॥]")


def spaced(text: str) -> str:
    """Lower case with signs of any script as blanks; positions stay. Combining marks belong to their word."""
    # No other letter becomes longer in lower case.
    low = text.replace("İ", "i").lower().encode("utf-8", "surrogatepass").translate(_SOLID).decode("utf-8", "surrogatepass")
    if low.isascii():
        return low
    signs = [c for c in set(low) if not (c.isalnum() or unicodedata.category(c).startswith("M"))]
    return low.translate(dict.fromkeys(map(ord, signs), " "))


@dataclass
class Lexicon:
    """Classes of words and beginnings of words, each with a weight."""

    words: dict[str, tuple[str, float]] = field(default_factory=dict)
    prefixes: dict[str, tuple[str, float]] = field(default_factory=dict)

    def add(self, unit: str, kind: str, weight: float) -> None:
        (self.prefixes if unit.endswith("*") else self.words)[unit.rstrip("*")] = kind, weight

    def ready(self) -> None:
        """An automaton that finds where an insult or a threat may begin; other classes only matter around one."""
        self.sizes = sorted({len(p) for p in self.prefixes}, reverse=True)
        self.scan = ahocorasick.Automaton()
        for units, end in ((self.words, " "), (self.prefixes, "")):
            for unit, (kind, _) in units.items():
                if kind in ("insult", "threat"):
                    self.scan.add_word(f" {unit}{end}", len(unit) + len(end))
        self.scan.make_automaton()

    def kind(self, word: str) -> tuple[str, float]:
        found = self.words.get(word)
        if found:
            return found
        for size in self.sizes:
            if len(word) >= size and (found := self.prefixes.get(word[:size])):
                return found
        return "other", 0.0


def base_lexicon() -> Lexicon:
    lexicon = Lexicon()
    for kind, units in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS), ("threat", THREATS), ("insult", INSULTS)):
        for unit in units:
            lexicon.add(unit, kind, 1.0)
    return lexicon


class Transducer:
    """Weighted arcs: state and class of a word give the next state and a factor. Other classes keep state and weight."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, float]]):
        self.arcs = arcs

    def step(self, state: int, kind: str) -> tuple[int, float]:
        return self.arcs.get((state, kind), self.arcs.get((state, "*"), (state, 1.0)))


# Negation: state n > 0 reaches n more words. Insults and threats inside are weakened.
NEGATION = Transducer(
    {(s, "negation"): (REACH, 1.0) for s in range(REACH + 1)}
    | {(s, k): (s - 1, NEGATED) for s in range(1, REACH + 1) for k in ("insult", "threat")}
    | {(s, "*"): (s - 1, 1.0) for s in range(1, REACH + 1)}
)
# Reported speech: from the verb to the end of the clause.
REPORT = Transducer({(0, "report"): (1, 1.0), (1, "insult"): (1, REPORTED), (1, "threat"): (1, REPORTED)})
# Target: whether somebody was named so far in the clause.
TARGET = Transducer(
    {(0, "target"): (1, 1.0), (0, "insult"): (0, LOOSE), (1, "insult"): (1, AIMED), (0, "threat"): (0, THREAT_LOOSE), (1, "threat"): (1, THREAT_AIMED)}
)


class Composition:
    """The transducers run side by side; arcs of the composed machine are made when first met."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.arcs: dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float]] = {}

    def step(self, state: tuple[int, ...], kind: str) -> tuple[tuple[int, ...], float]:
        arc = self.arcs.get((state, kind))
        if arc is None:
            steps = [part.step(s, kind) for part, s in zip(self.parts, state)]
            arc = self.arcs[state, kind] = tuple(s for s, _ in steps), math.prod(w for _, w in steps)
        return arc

    def weight(self, kinds: list[tuple[str, float]]) -> float:
        """Weight of a clause: insults and threats, each times the factors of its arc."""
        # A target after the insult counts as well ("idiot you are"), so the clause starts with what it knows.
        state, total = (0, 0, int(any(k == "target" for k, _ in kinds))), 0.0
        for kind, weight in kinds:
            state, factor = self.step(state, kind)
            if kind in ("insult", "threat"):
                total += weight * factor
        return total


GRAMMAR = Composition(NEGATION, REPORT, TARGET)


def clause_weights(text: str, lexicon: Lexicon) -> list[tuple[int, int, float]]:
    """(start, end, weight) of every clause with an insult or a threat; clauses end at . ! ? ; their like in other scripts and line ends."""
    plain = f" {spaced(text)} "
    hits = [end + 1 - size for end, size in lexicon.scan.iter(plain)]
    if not hits:
        return []
    # plain has one blank before the text.
    ends = [m.start() for m in _CLAUSE_END.finditer(text)]
    out, last = [], -1
    for at in sorted(hits):
        i = bisect_right(ends, at - 1)
        if i == last:
            continue
        last = i
        start, end = ends[i - 1] + 1 if i else 0, ends[i] if i < len(ends) else len(text)
        weight = GRAMMAR.weight([lexicon.kind(w) for w in plain[start + 1 : end + 1].split()])
        if weight > 0:
            out.append((start, end, weight))
    return out


def measures(weights: list[float]) -> list[float]:
    """Heaviest clause, sum over clauses and their number, each with falling returns."""
    if not weights:
        return [0.0, 0.0, 0.0]
    return [min(max(weights), 4.0), math.log1p(sum(weights)), math.log1p(len(weights))]


def learned(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> list[tuple[str, float]]:
    """Units that mark toxic texts, heaviest evidence first, none of them the beginning of another one kept.

    A unit must be far more frequent in toxic texts than chance allows. A beginning must be carried by several words:
    where one word brings most of its texts, the word itself is the unit.
    """
    carried: Counter = Counter()
    for unit, (p, _) in counts.items():
        if not unit.endswith("*"):
            for size in PREFIX_SIZES:
                stem = f"{unit[:size]}*"
                carried[stem] = max(carried[stem], p)
    found = []
    for unit, (p, n) in counts.items():
        chance = (p + n) * toxic / (toxic + clean)
        if p - chance > 4.5 * math.sqrt(chance + 0.5) and p > 1.5 * carried[unit]:
            odds = math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))
            found.append((p * odds - n, unit, odds))
    kept: list[tuple[str, float]] = []
    seen: set[str] = set()
    for _, unit, odds in sorted(found, reverse=True):
        stem = unit.rstrip("*")
        if any(stem[:i] + "*" in seen for i in range(1, len(stem) + 1)):
            continue
        seen.add(unit)
        kept.append((unit, min(odds / 4, 1.5)))
        if len(kept) == MAX_UNITS:
            break
    return kept


def _units(text: str) -> set[str]:
    words = {w for w in spaced(text).split() if 3 < len(w) <= 40 and not w.isdigit()}
    return words | {f"{w[:size]}*" for w in words for size in PREFIX_SIZES if len(w) > size}


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: list[float]

    def score(self, texts: list[str]) -> np.ndarray:
        x = [[1.0, *measures([w for *_, w in clause_weights(t, self.lexicon)])] for t in texts]
        z = np.array(x).reshape(len(texts), 4) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 40) -> np.ndarray:
    """Newton's method; the first column is the intercept and not shrunk."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [l2] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Learns words and weights from `labels.toxic` on at most `max_rows` labelled rows outside the held-out fold.

    How many texts hold a unit is counted on the executors; only units that are frequent in toxic texts come back, and
    then three measures per labelled row. Without toxic rows, or with nothing else, the given words decide alone.
    """
    sample = training_sample(docs, labels, "toxic", max_rows)
    # Copies are one piece of evidence.
    single = sample.dropDuplicates(["text", "label"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def told() -> pa.RecordBatch:
            units = list(held[0].keys() | held[1].keys())
            columns = [pa.array(units, pa.string()), *(pa.array([held[k][u] for u in units], pa.int64()) for k in (1, 0))]
            return pa.RecordBatch.from_arrays(columns, names=["unit", "toxic", "clean"])

        for part, texts in slices(batches):
            for text, label in zip(texts, part.column("label").to_pylist()):
                held[int(label == 1)].update(_units(text))
                held[int(label == 1)][""] += 1
            if len(held[0]) > 300_000:
                yield told()
                held = {0: Counter(), 1: Counter()}
        yield told()

    units = single.mapInArrow(count, "unit string, toxic long, clean long").groupBy("unit")
    summed = units.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # Evidence must outweigh chance, so the bound on units that come back is MAX_UNITS a size and the words themselves.
    best = summed.where(f"unit != '' and toxic >= {MIN_TEXTS} and toxic > clean").orderBy(
        F.desc(F.col("toxic") - F.col("clean")), "unit"
    ).limit(MAX_UNITS * (len(PREFIX_SIZES) + 1))
    rows = best.unionByName(summed.where("unit = ''")).collect()
    counts = {r["unit"]: (r["toxic"], r["clean"]) for r in rows}
    toxic, clean = counts.pop("", (0, 0))
    lexicon = base_lexicon()
    if toxic and clean:
        for unit, weight in learned(counts, toxic, clean):
            lexicon.add(unit, "insult", weight)
    lexicon.ready()
    if not (toxic and clean):
        return ToxicityModel(lexicon, [-3.0, 2.0, 2.0, 1.0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = lexicon
        scan.ready()
        for part, texts in slices(batches):
            x = [measures([w for *_, w in clause_weights(t, scan)]) for t in texts]
            yield beside(part, ["label"], x=pa.array(x, pa.list_(pa.float64())))

    measured = sample.mapInArrow(measure, schema_with(sample, ["label"], "x array<double>")).collect()
    x = np.array([[1.0, *r["x"]] for r in measured])
    return ToxicityModel(lexicon, logistic(x, np.array([r["label"] for r in measured], np.float64)).tolist())


def score(
    docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None, text_column: str = "text", column: str = "score"
) -> DataFrame:
    """The kept columns (default: all) with a score, the probability of a toxic text, and `toxic_clauses`.

    `toxic_clauses` lists start, end (code points) and weight of each matched clause. Whole texts are read; a null text
    is scored like an empty one. Columns of the input named like a result column are left out of the default.
    """
    keep = [c for c in docs.columns if c not in (column, "toxic_clauses")] if keep is None else keep
    chosen, name = with_text(docs, keep, text_column)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.lexicon.ready()
        w = np.array(model.weights)
        for part, texts in slices(batches, name):
            clauses = [clause_weights(t, model.lexicon) for t in texts]
            x = np.array([[1.0, *measures([c[2] for c in found])] for found in clauses]).reshape(len(texts), 4)
            told = [[{"start": s, "end": e, "weight": v} for s, e, v in found] for found in clauses]
            found = {column: pa.array(1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))), "toxic_clauses": pa.array(told, kind)}
            yield beside(part, keep, **found)

    ddl = f"`{column}` double, toxic_clauses array<struct<start: int, end: int, weight: double>>"
    return chosen.mapInArrow(run, schema_with(docs, keep, ddl))
