"""Fill-in-the-middle: documents cut in three and rearranged by byte displacements, and put back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_CHARS, beside, free_name, schema_with

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes whose displacements are summed and scattered at a time, so that a very long text needs no long arrays.
STEP = 1 << 20


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts without nulls, and where each text begins (one more: the end)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, each of about `SLICE_CHARS` bytes of text or of one text; nothing is decoded for it."""
    for batch in batches:
        ends = np.cumsum(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def char_starts(data: np.ndarray, begins: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Byte at which the given code point of each text begins; `begins` are the texts' first bytes, in order."""
    wanted, out, seen = np.empty(len(chars), np.int64), np.empty(len(chars), np.int64), 0
    first = np.empty(len(begins), np.int64)
    # Two scans over the bytes: code points before each text, then the byte of each wanted code point.
    counts = [0]
    for at in range(0, len(data), STEP):
        head = np.flatnonzero((data[at : at + STEP] & 0xC0) != 0x80) + at
        inside = (begins >= at) & (begins < at + STEP)
        first[inside] = seen + np.searchsorted(head, begins[inside])
        seen += len(head)
        counts.append(seen)
    first[begins >= len(data)] = seen
    wanted[:] = first + chars
    for k, at in enumerate(range(0, len(data), STEP)):
        inside = (wanted >= counts[k]) & (wanted < counts[k + 1])
        if inside.any():
            head = np.flatnonzero((data[at : at + STEP] & 0xC0) != 0x80) + at
            out[inside] = head[wanted[inside] - counts[k]]
    out[wanted >= seen] = len(data)
    return out


def displacements(points: np.ndarray, shifts: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shift of every byte, in steps: the running sum of a difference array that is set where a segment begins.

    `points` are the first bytes of the segments in order (several may coincide, the last one holds), `shifts` what
    each segment's bytes move by.
    """
    carry, jumps = 0, np.diff(shifts, prepend=0)
    for at in range(0, length, STEP):
        size = min(STEP, length - at)
        difference = np.zeros(size, np.int64)
        low, high = np.searchsorted(points, [at, at + size])
        np.add.at(difference, points[low:high] - at, jumps[low:high])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = shift[-1]
        yield at, shift


def _layout(begin: np.ndarray, cut1: np.ndarray, cut2: np.ndarray, end: np.ndarray, kind: np.ndarray):
    """Output offsets, first bytes and shifts of prefix, middle and suffix, and places of the three marks.

    kind: 0 the text as it is, 1 prefix, suffix, middle, 2 suffix, prefix, middle; each part behind its mark.
    """
    mark = len(PREFIX)
    n_prefix, n_middle, n_suffix = cut1 - begin, cut2 - cut1, end - cut2
    offsets = np.concatenate([[0], np.cumsum(end - begin + 3 * mark * (kind > 0))])
    base = offsets[:-1]
    lead = np.where(kind > 0, mark, 0)
    prefix = base + np.where(kind == 2, 2 * mark + n_suffix, lead)
    suffix = np.where(kind == 0, base + n_prefix + n_middle, base + np.where(kind == 2, mark, 2 * mark + n_prefix))
    middle = np.where(kind == 0, base + n_prefix, base + 3 * mark + n_prefix + n_suffix)
    points = np.stack([begin, cut1, cut2], 1).ravel()
    shifts = np.stack([prefix - begin, middle - cut1, suffix - cut2], 1).ravel()
    marks = {name: (at - mark)[kind > 0] for name, at in ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle))}
    return offsets, points, shifts, marks


def rearranged(texts: pa.Array, kind: np.ndarray, prefix: np.ndarray, middle: np.ndarray) -> pa.Array:
    """The texts in their forms; `prefix` and `middle` count code points. Every byte is scattered to its place."""
    data, offsets = _bytes_of(texts)
    begin, end = offsets[:-1], offsets[1:]
    cut1 = np.where(kind > 0, char_starts(data, begin, prefix), begin)
    cut2 = np.where(kind > 0, char_starts(data, begin, prefix + middle), begin)
    # The code point after the last one of a text is that of the next text, which begins where this one ends.
    cut1, cut2 = np.minimum(cut1, end), np.minimum(cut2, end)
    places, points, shifts, marks = _layout(begin, cut1, cut2, end, kind)
    out = np.empty(places[-1], np.uint8)
    for at, shift in displacements(points, shifts, len(data)):
        out[np.arange(at, at + len(shift)) + shift] = data[at : at + len(shift)]
    for name, starts in marks.items():
        for i, byte in enumerate(name.encode()):
            out[starts + i] = byte
    return _texts(out, places)


def _found(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, name: str) -> np.ndarray:
    """Where the mark stands in each rearranged text; it occurs once in each, and may occur in others."""
    hits = [np.empty(0, np.int64)]
    mark = np.frombuffer(name.encode(), np.uint8)
    for at in range(0, len(data), STEP):
        part = data[at : at + STEP + len(mark) - 1]
        same = part[: len(part) - 2] == mark[0]
        for i in (1, 2):
            same &= part[i : len(part) - 2 + i] == mark[i]
        hits.append(np.flatnonzero(same) + at)
    hit = np.concatenate(hits)
    text = np.searchsorted(offsets, hit, "right") - 1
    inside = (hit + len(mark) <= offsets[text + 1]) & (kind[text] > 0)
    at = np.full(len(kind), -1, np.int64)
    at[text[inside]] = hit[inside]
    if (at[kind > 0] < 0).any() or inside.sum() != (kind > 0).sum():
        raise ValueError(f"a rearranged text does not hold {name} just once")
    return at[kind > 0]


def restored(outputs: pa.Array, kind: np.ndarray) -> pa.Array:
    """The texts from outputs and forms alone: the marks give the cuts, then every byte is gathered from its place."""
    data, offsets = _bytes_of(outputs)
    moved, mark = kind > 0, len(PREFIX)
    begin, end = offsets[:-1], offsets[1:]
    n_prefix, n_middle = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
    at = {name: _found(data, offsets, kind, name) for name in (PREFIX, SUFFIX, MIDDLE)}
    after = np.where(kind[moved] == 2, at[MIDDLE], at[SUFFIX])
    n_prefix[moved] = after - at[PREFIX] - mark
    n_middle[moved] = end[moved] - at[MIDDLE] - mark
    places = np.concatenate([[0], np.cumsum(end - begin - 3 * mark * moved)])
    first = places[:-1]
    _, points, shifts, _ = _layout(first, first + n_prefix, first + n_prefix + n_middle, places[1:], kind)
    out = np.empty(places[-1], np.uint8)
    for at_, shift in displacements(points, shifts, len(out)):
        out[at_ : at_ + len(shift)] = data[np.arange(at_, at_ + len(shift)) + shift]
    return _texts(out, places)


#: The forms, by number.
FORMS = ("plain", "psm", "spm")


def _kinds(column: pa.Array) -> np.ndarray:
    return np.array([FORMS.index(f) for f in column.to_pylist()], np.int64)


def infill(
    docs: DataFrame, keep: list[str], id_column: str = "doc_id", text_column: str = "text", seed: int = 1, rate: int = 90, spm: int = 20
) -> DataFrame:
    """The kept columns with n, form, prefix_chars, middle_chars and output: texts rearranged for infilling.

    The seed and the id decide, by the first four 32-bit words of a SHA-256, where a text of n code points is cut and in
    what form it comes: `rate` in a hundred texts are cut, `spm` in a hundred of those with the suffix first. An empty
    text and one that contains a mark stay plain, with null counts. A null text is the empty one, a null id counts as
    the empty text. Repeated rows come out alike. A kept column that is named like a new one is not allowed; other
    columns are not read. Very long texts are moved in steps; a task holds a text, its output and a few more bytes
    for each of `STEP` bytes.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    n = F.char_length(text).cast("long")
    plain = (n == 0) | (h[2] % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | text.contains(mark)
    form = F.when(plain, FORMS[0]).when(h[3] % 100 < spm, FORMS[2]).otherwise(FORMS[1])
    low, high = F.least(h[0] % (n + 1), h[1] % (n + 1)), F.greatest(h[0] % (n + 1), h[1] % (n + 1))
    clash = {c.lower() for c in keep} & {"n", "form", "prefix_chars", "middle_chars", "output"}
    if clash:
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    kept = docs.select(*(F.col(f"`{c}`") for c in keep))
    name = free_name(kept, "_text")
    shape = docs.select(
        *(F.col(f"`{c}`") for c in keep), text.alias(name), n.alias("n"), form.alias("form"),
        F.when(form != FORMS[0], low).alias("prefix_chars"), F.when(form != FORMS[0], high - low).alias("middle_chars"),
    )
    kept_names = [*keep, "n", "form", "prefix_chars", "middle_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, name):
            counts = [pa.compute.fill_null(part.column(c), 0).to_numpy() for c in ("prefix_chars", "middle_chars")]
            yield beside(part, kept_names, output=rearranged(part.column(name), _kinds(part.column("form")), *counts))

    return shape.mapInArrow(run, schema_with(shape, kept_names, "output string"))


def restore(rearranged_docs: DataFrame, keep: list[str], output_column: str = "output", form_column: str = "form") -> DataFrame:
    """The kept columns and `restored`, the texts as they were before `infill`, from output and form alone.

    A null output is the empty one, a null form is plain. An output that does not hold each mark once although its form
    says so raises a ValueError, as nothing right can come of it.
    """
    kept = rearranged_docs.select(*(F.col(f"`{c}`") for c in keep))
    name, kind = free_name(kept, "_output"), free_name(kept, "_form")
    chosen = rearranged_docs.select(
        *(F.col(f"`{c}`") for c in keep), F.coalesce(F.col(f"`{output_column}`"), F.lit("")).alias(name),
        F.coalesce(F.col(f"`{form_column}`"), F.lit(FORMS[0])).alias(kind),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, name):
            yield beside(part, keep, restored=restored(part.column(name), _kinds(part.column(kind))))

    return chosen.mapInArrow(run, schema_with(chosen, keep, "restored string"))
