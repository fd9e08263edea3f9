"""Personal data in whole texts: fixed patterns, and the spans that a trained tagger adds to them.

**Patterns** (email, ip, card, phone) are matched leftmost and without overlap per kind; matches that fail their test
(parts up to 255; 14 to 19 digits and Luhn; 10 to 15 digits) are dropped without another try. They are only
tried where they can start: at '@', at the first digit of a run, at '+'.

**Tagger.** A bidirectional LSTM with CRF transitions (``tagger``) is trained from labelled spans: windows around
the pattern spans of a bounded sample (``TRAIN_WINDOWS`` of the whole table, smallest hashes first), windows around
other digits, and windows of plain text. It then reads every character of every text in windows of ``WINDOW``
characters that overlap by ``OVERLAP``. Each window is decoded alone; in an overlap, each half is taken from the
window in which it lies farther from the edge, and spans are read off the joined labels, so a span over several windows
is one. Spans of the tagger that touch no pattern span are added, without blanks at their ends.

Positions are code points, ends exclusive.

Defined cases: NULL and empty texts have no spans; repeated rows give repeated results; a sample without spans trains
a tagger that finds none; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm import tagger, textcols
from shelfwright.llm.tagger import KINDS

# fixed values: the four patterns
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WINDOW = 320
OVERLAP = 64
TRAIN_WINDOWS = 3000
TRAIN_STEPS = 96  # characters of a training window
SHORTEST = 6  # characters of an added span
WINDOWS_AT_ONCE = 1024

LOCAL = np.zeros(256, bool)
LOCAL[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def right(kind: int, found: str) -> bool:
    """Whether a match passes the test of its kind."""
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in found.split("."))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 10 <= len(digits) <= 15


def pattern_spans(text: str, ats: list[int], locals_: list[int], digits: list[int], pluses: list[int]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of one text, in order. ``locals_``: where the run of local characters before each '@' begins."""
    spans = []
    last = 0
    for at, begin in zip(ats, locals_):
        begin = max(begin, last)
        found = EMAIL.match(text, begin) if begin < at else None
        if found:
            spans.append((begin, 0, found.end()))
            last = found.end()
    for kind, pattern, places in ((1, IP, digits), (2, CARD, digits), (3, PHONE, pluses)):
        last = 0
        for p in places:
            if p < last:
                continue
            found = pattern.match(text, p)
            if found:
                last = found.end()
                if right(kind, found[0]):
                    spans.append((p, kind, last))
    return sorted(spans)


class Texts:
    """The characters of a column of texts, and where patterns can start."""

    def __init__(self, column: pa.Array):
        self.column = column
        data, bounds = textcols.flat(column)
        head = np.flatnonzero((data & 0xC0) != 0x80)
        self.first = data[head]  # first byte of each character
        self.bounds = np.searchsorted(head, bounds)

    def candidates(self) -> dict[int, list[list[int]]]:
        """Per row with any: '@' places, local run begins, digit run begins, '+' places."""
        first, bounds = self.first, self.bounds
        ats = np.flatnonzero(first == 64)
        digits, _ = textcols.runs((first >= 48) & (first <= 57), bounds)
        pluses = np.flatnonzero(first == 43)
        begins = ats.copy()
        if len(ats):
            starts, ends = textcols.runs(LOCAL[first], bounds)
            near = np.searchsorted(ends, ats)
            near = np.minimum(near, max(len(ends) - 1, 0))
            if len(ends):
                # a run that ends at an '@' of the same row
                row = np.searchsorted(bounds, ats, "right") - 1
                touches = (ends[near] == ats) & (starts[near] >= bounds[row])
                begins = np.where(touches, starts[near], ats)
        found: dict[int, list[list[int]]] = {}
        for i, (places, values) in enumerate(((ats, ats), (ats, begins), (digits, digits), (pluses, pluses))):
            rows = np.searchsorted(bounds, places, "right") - 1
            for r, v in zip(rows.tolist(), (values - bounds[rows]).tolist()):
                found.setdefault(r, [[], [], [], []])[i].append(v)
        return found

    def spans(self) -> list[list[tuple[int, int, int]]]:
        """The pattern spans of each row."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(self.column))]
        for r, places in self.candidates().items():
            out[r] = pattern_spans(self.column[r].as_py(), *places)
        return out


def labels_of(spans: list[tuple[int, int, int]], lo: int, n: int) -> np.ndarray:
    """Labels of the characters lo .. lo + n - 1; of overlapping spans the first counts."""
    y = np.zeros(n, np.uint8)
    for start, kind, end in spans:
        part = y[max(0, start - lo) : max(0, end - lo)]
        part[part == 0] = kind + 1
    return y


def training_windows(column: pa.Array) -> list[tuple[bytes, bytes]]:
    """(classes, labels) of windows around spans, around some other digits, and of some plain text."""
    texts = Texts(column)
    classes = tagger.CLASS_OF_BYTE[texts.first]
    found = []
    candidates = texts.candidates()
    for r in range(len(column)):
        lo, hi = texts.bounds[r], texts.bounds[r + 1]
        places = candidates.get(r)
        spans = pattern_spans(column[r].as_py(), *places) if places else []
        rng = np.random.default_rng([int(hi - lo), *(classes[lo : lo + 64].astype(int).tolist())])
        chosen = [s for s, _, _ in spans]
        if places:
            chosen += [d for d in places[2] if rng.random() < 0.2]
        if hi > lo and rng.random() < 0.05:
            chosen.append(int(rng.integers(0, hi - lo)))
        for place in chosen:
            begin = max(0, place - int(rng.integers(8, TRAIN_STEPS - 40)))
            x = np.full(TRAIN_STEPS, tagger.PAD, np.uint8)
            part = classes[lo + begin : min(hi, lo + begin + TRAIN_STEPS)]
            x[: len(part)] = part
            found.append((x.tobytes(), labels_of(spans, begin, TRAIN_STEPS).tobytes()))
    return found


def train_tagger(docs: DataFrame, text_col: str = "text", windows: int = TRAIN_WINDOWS, **options) -> dict[str, np.ndarray]:
    """Weights trained on at most ``windows`` windows of the texts."""

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                rows = training_windows(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], ["x", "y"]
                )

    sample = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "x binary, y binary")
    rows = sample.orderBy(F.xxhash64("x", "y"), "x", "y").limit(windows).collect()
    x, y = (np.array([np.frombuffer(bytes(r[c]), np.uint8) for r in rows]).reshape(-1, TRAIN_STEPS).T for c in ("x", "y"))
    return tagger.fit(x, y, **options)


def tagged(w: dict, texts: Texts, window: int = WINDOW, overlap: int = OVERLAP) -> np.ndarray:
    """The label of every character of the texts."""
    classes, bounds = tagger.CLASS_OF_BYTE[texts.first], texts.bounds
    n = np.diff(bounds)
    stride = window - overlap
    per = np.where(n > 0, np.maximum(0, -(-(n - overlap) // stride)).clip(1), 0)
    row = np.repeat(np.arange(len(n)), per)
    step = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start = bounds[:-1][row] + step * stride
    stop = bounds[1:][row]
    lo = np.where(step > 0, start + overlap // 2, start)
    hi = np.where(step < per[row] - 1, start + stride + overlap // 2, stop)
    labels = np.zeros(len(classes), np.uint8)
    steps = np.arange(window)
    for i in range(0, len(row), WINDOWS_AT_ONCE):
        part = slice(i, i + WINDOWS_AT_ONCE)
        at = start[part, None] + steps
        inside = at < stop[part, None]
        x = np.where(inside, classes[np.where(inside, at, 0)], tagger.PAD)
        y = tagger.decode(w, np.ascontiguousarray(x.T)).T
        own = (at >= lo[part, None]) & (at < hi[part, None])
        labels[at[own]] = y[own]
    return labels


def all_spans(w: dict, column: pa.Array) -> list[list[tuple[int, int, int, bool]]]:
    """(start, kind, end, from a pattern) of each row, in order."""
    texts = Texts(column)
    out = [[(*s, True) for s in spans] for spans in texts.spans()]
    labels, bounds = tagged(w, texts), texts.bounds
    blank = textcols.SPACE[texts.first]
    edge = np.zeros(len(labels) + 1, bool)
    edge[bounds] = True
    change = np.ones(len(labels), bool)
    change[1:] = labels[1:] != labels[:-1]
    starts = np.flatnonzero(change | edge[:-1])
    ends = np.append(starts[1:], len(labels)) if len(starts) else starts
    for a, b in zip(starts.tolist(), ends.tolist()):
        if not labels[a]:
            continue
        while a < b and blank[a]:
            a += 1
        while a < b and blank[b - 1]:
            b -= 1
        r = int(np.searchsorted(bounds, a, "right")) - 1
        lo, hi = a - int(bounds[r]), b - int(bounds[r])
        if hi - lo >= SHORTEST and all(hi <= s or e <= lo for s, _, e, base in out[r] if base):
            out[r].append((lo, int(labels[a]) - 1, hi, False))
    return [sorted(s) for s in out]


SPANS = "spans array<struct<kind: string, start: long, end: long, pattern: boolean>>"


def private_spans(docs: DataFrame, weights: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and spans (kind, start, end, whether a pattern found it) of every text, by start and kind."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # some thousand numbers
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.bool_())])

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                rows = [
                    [{"kind": KINDS[k], "start": s, "end": e, "pattern": p} for s, k, e, p in spans]
                    for spans in all_spans(shared.value, part.column("text"))
                ]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, pa.list_(kind_of))], ["id", "spans"])

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, {SPANS}").withColumnRenamed("id", id_col)
