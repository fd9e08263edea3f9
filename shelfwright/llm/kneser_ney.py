"""An interpolated modified Kneser-Ney model: counted in Spark, stored as sorted hash arrays, memory-mapped to score.

**Words.** A first pass counts the words and numbers them, the frequent ones of each hash range first, so that n-grams are
short numbers that compress well and are known exactly while they are counted.

**Counting.** Tasks count the n-grams of about ``TASK_TOKENS`` tokens at a time and deal them out by the hash of all but their
last word, one compressed row per range. A range thus holds each context whole: it adds up its n-grams, notes what each
context gets from them, and passes on what each suffix gets to the next level: raw counts at the highest level, numbers of
different predecessors below. A frequent word is thus one entry per different word beside it, never one row per occurrence.
Ranges are as many as the tokens ask for. All levels are one job: discounts are not needed before scoring.

**Storing.** Each range of each level is a file in the shared folder: for n-grams their counts, four bits each, for contexts
one byte for the numbers of their counts, and a list of those that need more. An n-gram is known by its range, its bucket (of
sixteen n-grams at most on average) and 32 bits more of its hash: one that was never seen is taken for one that was with a
chance of 4e-9, whatever the input. Files are written under another name and moved when complete; they hold the same bytes
whichever attempt of a task writes them.

**Scoring.** Workers map the files they need and look sorted queries up by binary search. A shared folder that
cannot be mapped (an object store) is read file by file instead.

Words are the runs of other than ASCII white space, A-Z lower-cased; each text ends in one end token, which is
predicted and counted. Words are known by 64-bit hashes.

Probabilities: p_k(w | context) = (c - D(c)) / total + backoff * p_(k-1)(w | shorter context), for an unseen context
p_(k-1) alone; the lowest level backs off to 1 / (V + 1), the share of each known word and of all unknown ones.

Defined cases: NULL and empty texts consist of the end token; a NULL id is held out; repeated rows are counted and scored
each; other columns are ignored; an empty table gives an empty result; without training texts every
probability is 1.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm import textcols
from shelfwright.llm.files import file_system, new_folder, write_file
from shelfwright.llm.shingles import gram_hashes, keys_of, scrambled, word_hashes

ORDER = 3
TASK_TOKENS = 4_000_000
RANGE_TOKENS = 1_000_000
SLICE_BYTES = 4 << 20
BASE_ADD = 0.1

BEGIN, END = np.uint64(0x1F3D5B79A2C4E680), np.uint64(0x8E6C4A2B97B5D3F1)
START, UNKNOWN, FIRST = 0, 1, 2  # numbers of the begin mark, of words that were not counted, and of the first counted one
BUCKET = 16  # n-grams of a bucket, on average, at most


def token_rows(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text after ``order - 1`` begin marks and before an end mark; row bounds."""
    data, bounds = textcols.flat(column)
    data = textcols.lower_ascii(data)
    starts, ends, words = textcols.word_runs(data, bounds)
    n = len(bounds) - 1
    tokens = np.full(len(starts) + n * order, BEGIN, np.uint64)
    tokens[np.arange(len(starts)) + textcols.owner(words) * order + order - 1] = word_hashes(data, starts, ends)
    limits = words + np.arange(n + 1) * order
    tokens[limits[1:] - 1] = END
    return tokens, limits


def predicted(limits: np.ndarray, order: int) -> np.ndarray:
    """Places of the tokens that are predicted: all but the begin marks."""
    keep = np.ones(int(limits[-1]), bool)
    for j in range(order - 1):
        keep[limits[:-1] + j] = False
    return np.flatnonzero(keep)


def squeeze(arrays: list[np.ndarray]) -> bytes:
    """64-bit arrays in one compressed string, as byte planes; of the first one, which ascends, the differences."""
    planes = []
    for i, a in enumerate(arrays):
        a = a.astype(np.uint64)
        a = np.diff(a, prepend=np.uint64(0)) if i == 0 else a
        planes.append(a.view(np.uint8).reshape(-1, 8).T.tobytes())
    raw = b"".join(planes)
    return np.array([len(raw), len(arrays)], np.int64).tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)


def expand(data: bytes) -> list[np.ndarray]:
    size, n = np.frombuffer(data, np.int64, 2).tolist()
    raw = np.frombuffer(pa.Codec("zstd").decompress(data[16:], size, asbytes=True), np.uint8).reshape(n, 8, -1)
    arrays = [np.ascontiguousarray(a.T).view(np.uint64).ravel() for a in raw]
    return [np.cumsum(arrays[0], dtype=np.uint64), *arrays[1:]]


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range of each key, of ``ranges`` equal ones."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def summed(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct keys, ascending; the sums of values by key; where each key first stands."""
    if not len(keys):
        return keys, values, np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], [np.add.reduceat(v[order], first) for v in values], order[first]


def head_parts(codes: list[np.ndarray], ranges: int) -> np.ndarray:
    """The range of each n-gram: that of all its words but the last one, or of its only one."""
    return range_of(scrambled(keys_of(codes[:-1] or codes)), ranges)


def dealt(kind: str, part: np.ndarray, arrays: list[np.ndarray], ranges: int):
    """(kind, range, data) for each range that has rows, in their order."""
    order = by_part(part, ranges)
    edges = np.searchsorted(part[order], np.arange(ranges + 1))
    for r in range(ranges):
        at = order[edges[r] : edges[r + 1]]
        if len(at):
            yield kind, r, squeeze([a[at] for a in arrays])


def by_part(part: np.ndarray, ranges: int) -> np.ndarray:
    """Places sorted by range, each range's in their order; short integers are sorted by their digits."""
    return np.argsort(part.astype(np.int16 if ranges < 1 << 15 else np.int64), kind="stable")


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds, parts, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.string()), pa.array(parts, pa.int64()), pa.array(data, pa.binary())], ["kind", "part", "data"]
    )


ROWS = "kind string, part long, data binary"


def in_parts(texts: DataFrame, order: int, flush, coded=lambda tokens: tokens) -> DataFrame:
    """``flush`` of the tokens (words ``coded``) and row bounds of about ``TASK_TOKENS`` tokens at a time."""

    def joined(held):
        shifts = np.cumsum([0] + [len(t) for t, _ in held[:-1]])
        limits = np.concatenate([[0], *[m[1:] + shift for (_, m), shift in zip(held, shifts)]])
        return batch_of(list(flush(np.concatenate([t for t, _ in held]), limits)))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for part in textcols.row_slices(batch, "text", SLICE_BYTES):
                tokens, limits = token_rows(part.column("text"), order)
                held.append((coded(tokens), limits))
                n += len(tokens)
                if n >= TASK_TOKENS:
                    yield joined(held)
                    held, n = [], 0
        if held:
            yield joined(held)

    return texts.mapInArrow(run, ROWS)


def count_words(texts: DataFrame, ranges: int) -> DataFrame:
    """Rows of kind ``word``: hashes and counts."""

    def flush(tokens, limits):
        keys, (counts,), _ = summed(tokens, [np.ones(len(tokens), np.int64)])
        yield from dealt("word", range_of(keys, ranges), [keys, counts], ranges)

    return in_parts(texts, 1, flush)


def count_grams(texts: DataFrame, model: Model) -> DataFrame:
    """Rows of kind ``gram``: the word numbers of n-grams of the highest level, and counts."""
    order, ranges = model.order, model.ranges

    def flush(codes, limits):
        places = predicted(limits, order)
        own, ranks = np.unique(codes, return_inverse=True)
        ones = [np.ones(len(places), np.int64)]
        _, (counts,), at = summed(ordered_grams(ranks.astype(np.uint64), len(own), places, order), ones)
        last = places[at]
        grams = [codes[last - order + 1 + j] for j in range(order)]
        if not fits(len(own), order):
            by_words = np.lexsort(grams[::-1])
            grams, counts = [g[by_words] for g in grams], counts[by_words]
        yield from dealt("gram", head_parts(grams, ranges), [*grams, counts], ranges)

    def coded(tokens):
        _, numbers, back = words_at(model, tokens)
        return numbers[back]

    return in_parts(texts, order, flush, coded)


def fits(kinds: int, k: int) -> bool:
    """Whether 64 bits hold k numbers below ``kinds``."""
    return (kinds - 1).bit_length() * k <= 64


def ordered_grams(ranks: np.ndarray, kinds: int, places: np.ndarray, k: int) -> np.ndarray:
    """A number for each k-gram that ends at the places: in the order of its words where 64 bits hold these, and a hash elsewhere."""
    if not fits(kinds, k):
        return gram_hashes(scrambled(ranks), k)[places - k + 1]
    bits = (kinds - 1).bit_length()
    total = ranks[places - k + 1]
    for j in range(1, k):
        total = total << np.uint64(bits) | ranks[places - k + 1 + j]
    return total


def gathered(table: pa.Table) -> list[np.ndarray]:
    """The arrays of all rows of a range, joined."""
    parts = [expand(d) for d in table.column("data").to_pylist()]
    return [np.concatenate(p) for p in zip(*parts)]


def save(folder: str, name: str, part: int, keys: np.ndarray, columns: list[np.ndarray]) -> None:
    """A file of keys and columns: its head says how many, and how wide each column is."""
    widths = [c.dtype.itemsize for c in columns]
    head = np.array([len(keys), len(columns), *widths], np.int64).tobytes()
    by_width = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    write_file(f"{folder}/{name}/{part}", head + keys.tobytes() + by_width)


def narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in as few bytes as the largest needs."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def split_counts(counts: np.ndarray) -> np.ndarray:
    """0, 1 or 2 for counts of 1, 2, and 3 or more."""
    return np.minimum(counts, 3) - 1


def add_words(folder: str, ranges: int, table: pa.Table) -> pa.Table:
    """Store a range of words: their counts and numbers, the frequent ones first."""
    part = table.column("part")[0].as_py()
    hashes, counts = gathered(table)
    keys, (counts,), _ = summed(hashes, [counts.astype(np.int64)])
    numbers = np.empty(len(keys), np.int64)
    numbers[np.argsort(-counts, kind="stable")] = np.arange(len(keys)) * ranges + part + FIRST
    save(folder, "word", part, keys, [narrow(counts), narrow(numbers)])
    return stats_row(0, counts)


def add_level(folder: str, k: int, ranges: int, table: pa.Table) -> pa.Table:
    """Store a range of level k and its contexts; what its suffixes get; how many counts are 1, 2, 3 and 4, and the sums."""
    if table.column("kind")[0].as_py() == "stats":
        return table
    part = table.column("part")[0].as_py()
    *codes, counts = gathered(table)
    keys, (counts,), at = summed(keys_of(codes), [counts.astype(np.int64)])
    codes = [c[at] for c in codes]
    save_buckets(folder, f"gram{k}", part, keys, [counts], 4)
    rows = []
    if k > 1:
        split = split_counts(counts)
        heads, values, _ = summed(keys_of(codes[:-1]), [counts, *[(split == j).astype(np.int64) for j in range(3)]])
        save_buckets(folder, f"context{k}", part, heads, values, 8)
        _, (ones,), first = summed(keys_of(codes[1:]), [np.ones(len(keys), np.int64)])
        tails = [c[first] for c in codes[1:]]
        order = np.lexsort(tails[::-1])
        tails, ones = [t[order] for t in tails], ones[order]
        rows += dealt("gram", head_parts(tails, ranges), [*tails, ones], ranges)
    return pa.Table.from_batches([batch_of(rows), *stats_row(k, counts).to_batches()])


def stats_row(level: int, counts: np.ndarray) -> pa.Table:
    values = np.array([*[(counts == j).sum() for j in (1, 2, 3, 4)], len(counts), counts.sum()], np.int64)
    return pa.Table.from_batches([batch_of([("stats", level, values.tobytes())])])


def word_adder(folder: str, ranges: int):
    return lambda table: add_words(folder, ranges, table)


def level_adder(folder: str, k: int, ranges: int):
    return lambda table: add_level(folder, k, ranges, table)


def save_buckets(folder: str, name: str, part: int, keys: np.ndarray, values: list[np.ndarray], bits: int) -> None:
    """A file of distinct hashes, ascending, and their values.

    ``values`` are one array of counts, or several arrays, of which each different row is stored once and known by its place in
    the list of these, the frequent ones first. Counts and places have 4 or 8 ``bits``; the largest number stands for a place in
    the list of those that need more.
    """
    n = len(keys)
    high = min(32, max(1, (-(-n // BUCKET) - 1).bit_length()))
    buckets = np.searchsorted(keys >> np.uint64(64 - high), np.arange((1 << high) + 1, dtype=np.uint64)).astype(np.uint32)
    rest = (keys >> np.uint64(32 - high)).astype(np.uint32)
    classes, small = np.zeros((len(values), 0), np.int64), values[0]
    if len(values) > 1:
        _, first, which, often = np.unique(keys_of(values), return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        classes, small = np.stack([v[first[order]] for v in values]), place[which]
    most = (1 << bits) - 1
    more = np.flatnonzero(small >= most)
    packed = np.minimum(small, most).astype(np.uint8)
    if bits == 4:
        packed = np.append(packed, np.zeros(n % 2, np.uint8))
        packed = packed[::2] | packed[1::2] << np.uint8(4)
    head = np.array([n, high, bits, len(more), *classes.shape], np.int64)
    arrays = [head, classes, small[more], buckets, rest, more.astype(np.uint32), packed]
    write_file(f"{folder}/{name}/{part}", b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


@dataclass
class Buckets:
    """A file of ``save_buckets``, mapped."""

    high: int
    bits: int
    classes: np.ndarray
    large: np.ndarray
    buckets: np.ndarray
    rest: np.ndarray
    more: np.ndarray
    packed: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray) -> Buckets:
        n, high, bits, more, columns, kinds = raw[:48].view(np.int64).tolist()
        at, found = 48, []
        for count, kind in [(columns * kinds, np.int64), (more, np.int64), ((1 << high) + 1, np.uint32), (n, np.uint32), (more, np.uint32)]:
            size = count * np.dtype(kind).itemsize
            found.append(raw[at : at + size].view(kind))
            at += size
        return cls(high, bits, found[0].reshape(columns, kinds), *found[1:], raw[at:])

    def at(self, keys: np.ndarray) -> list[np.ndarray]:
        """The values at the keys, 0 where a key is not stored."""
        bucket = (keys >> np.uint64(64 - self.high)).astype(np.int64)
        low, end = self.buckets[bucket].astype(np.int64), self.buckets[bucket + 1].astype(np.int64)
        asked, top, last = (keys >> np.uint64(32 - self.high)).astype(np.uint32), end, len(self.rest) - 1
        for _ in range(int((end - low).max(initial=0)).bit_length()):
            middle = (low + top) // 2
            less = (low < top) & (self.rest[np.minimum(middle, last)] < asked)
            low, top = np.where(less, middle + 1, low), np.where(less, top, middle)
        hit = np.flatnonzero((low < end) & (self.rest[np.minimum(low, last)] == asked))
        place = low[hit]
        small = (self.packed[place >> 1] >> (4 * (place & 1)).astype(np.uint8) & 15 if self.bits == 4 else self.packed[place]).astype(np.int64)
        beyond = np.flatnonzero(small == (1 << self.bits) - 1)
        small[beyond] = self.large[np.searchsorted(self.more, place[beyond].astype(np.uint32))]
        out = [np.zeros(len(keys), np.int64) for _ in range(len(self.classes) if self.classes.size else 1)]
        for o, c in zip(out, self.classes if self.classes.size else [None]):
            o[hit] = small if c is None else c[small]
        return out


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more; where counts of counts are missing, the single discount or a half."""
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
    return [min(max(d, 0.0), float(j)) for j, d in enumerate(found, 1)]


class Model:
    """Where a model lies, and its few numbers."""

    def __init__(self, folder: str, order: int, ranges: int):
        self.folder, self.order, self.ranges = folder, order, ranges
        self.discounts: dict[int, list[float]] = {}
        self.tokens = self.types = self.total = self.kinds = 0


def train(texts: DataFrame, text_col: str = "text", order: int = ORDER, folder: str | None = None) -> Model:
    """Count all texts and store the model."""
    texts = texts.select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("docs")).first()
    ranges = ((size["n"] or 0) // 6 + size["docs"]) // RANGE_TOKENS + 1
    model = Model(folder or new_folder(texts.sparkSession, "model"), order, ranges)
    # six numbers for each range and level
    counted = count_words(texts, ranges).groupBy("kind", "part").applyInArrow(word_adder(model.folder, ranges), ROWS)
    sums = summed_stats(counted)
    model.types, model.tokens = sums[0][4:].tolist()
    rows = count_grams(texts, model)
    for k in range(order, 0, -1):
        rows = rows.groupBy("kind", "part").applyInArrow(level_adder(model.folder, k, ranges), ROWS)
    sums = summed_stats(rows)
    model.discounts = {k: discounts_of(*sums[k][:4].tolist()) for k in range(order, 0, -1)}
    model.kinds, model.total = sums[1][4:].tolist()
    model.ones = sums[1][:3].tolist()
    return model


def summed_stats(rows: DataFrame) -> dict[int, np.ndarray]:
    """The sums of the rows of ``stats_row``, by level."""
    sums: dict[int, np.ndarray] = defaultdict(lambda: np.zeros(6, np.int64))
    for r in rows.select("part", "data").collect():
        sums[r["part"]] += np.frombuffer(bytes(r["data"]), np.int64)
    return sums


_OPEN: dict[str, tuple] = {}


def opened(folder: str, name: str, part: int):
    """A range, mapped into memory once per worker: of words their keys, counts and numbers; None for one without keys."""
    path = f"{folder}/{name}/{part}"
    if path not in _OPEN:
        system, place = file_system(path)
        local = system.type_name == "local"
        try:
            raw = np.memmap(place, np.uint8, "r") if local else np.frombuffer(system.open_input_file(place).read(), np.uint8)
        except FileNotFoundError:
            raw = None
        if raw is None:
            _OPEN[path] = None
        elif name != "word":
            _OPEN[path] = Buckets.of(np.asarray(raw))
        else:
            n, count = raw[:16].view(np.int64).tolist()
            widths = raw[16 : 16 + 8 * count].view(np.int64).tolist()
            at = 16 + 8 * count
            found = [raw[at : at + 8 * n].view(np.uint64)]
            at += 8 * n
            for w in widths:
                found.append(raw[at : at + w * n].view(f"u{w}"))
                at += w * n
            _OPEN[path] = found
    return _OPEN[path]


def by_range(model: Model, name: str, parts: np.ndarray):
    """(places of the keys, stored range) for each range that keys belong to and that is stored."""
    order = by_part(parts, model.ranges)
    edges = np.searchsorted(parts[order], np.arange(model.ranges + 1))
    for r in np.flatnonzero(np.diff(edges)).tolist():
        stored = opened(model.folder, name, r)
        if stored is not None:
            yield order[edges[r] : edges[r + 1]], stored


def words_at(model: Model, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts and numbers of the different words, given by their hashes; which of these each token is."""
    wanted, back = np.unique(tokens, return_inverse=True)
    counts, numbers = np.zeros(len(wanted), np.int64), np.full(len(wanted), UNKNOWN, np.uint64)
    for at, (own, *columns) in by_range(model, "word", range_of(wanted, model.ranges)):
        ask = wanted[at]
        place = np.minimum(np.searchsorted(own, ask), len(own) - 1)
        hit = own[place] == ask
        counts[at[hit]], numbers[at[hit]] = (c[place[hit]] for c in columns)
    numbers[wanted == BEGIN] = START
    return counts, numbers, back


def looked_up(model: Model, name: str, keys: np.ndarray, heads: np.ndarray, columns: int = 1) -> list[np.ndarray]:
    """The values of n-grams or contexts at the keys, 0 where a key is not stored; ``heads`` say in which range it is."""
    found = [np.zeros(len(keys), np.int64) for _ in range(columns)]
    for at, stored in by_range(model, name, range_of(scrambled(heads), model.ranges)):
        for out, values in zip(found, stored.at(keys[at])):
            out[at] = values
    return found


def discounted(counts: np.ndarray, discounts: list[float]) -> np.ndarray:
    d = np.array([0.0, *discounts])
    return counts - d[np.minimum(counts, 3).astype(np.int64)]


def probabilities(model: Model, numbers: np.ndarray, back: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The model's probability of each token at the places, given the tokens before it; token i is the word ``numbers[back[i]]``.

    Each different n-gram but the longest ones is looked up once, as an n-gram and as a context.
    """
    mixed = scrambled(numbers)
    codes = mixed[back]
    # the different k-grams of a level, the range of each, and which of them ends at each token from the k-th on
    keys, heads, which = keys_of([numbers]), keys_of([numbers]), back
    p = np.ones(len(places))
    for k in range(1, model.order + 1):
        (counts,) = looked_up(model, f"gram{k}", keys, heads)
        counts = counts[which[places - k + 1]] if which is not None else counts
        if k > 1:
            seen = total > 0
            some = np.where(seen, total, 1)
            p = np.where(seen, discounted(counts, model.discounts[k]) / some + weight / some * p, p)
        elif model.total:
            left = sum(d * n for d, n in zip(model.discounts[1], [*model.ones[:2], model.kinds - sum(model.ones[:2])]))
            p = discounted(counts, model.discounts[1]) / model.total + left / model.total / (model.kinds + 1)
        if k == model.order:
            return p
        total, *split = looked_up(model, f"context{k + 1}", keys, keys, 4)
        weight = sum(d * n for d, n in zip(model.discounts[k + 1], split))
        ends = which[places - k]
        total, weight = total[ends], weight[ends]
        grams = gram_hashes(codes, k + 1)
        if k + 1 < model.order:
            below = keys[which[: len(grams)]]
            keys, first, which = np.unique(grams, return_index=True, return_inverse=True)
            heads = below[first]
        else:
            keys, heads, which = grams[places - k], keys[ends], None


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: id, n_tokens, n_known, base_score, score and perplexity."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        floor = np.log10(model.tokens + BASE_ADD * (model.types + 1))
        for batch in batches:
            for part in textcols.row_slices(batch, "text", SLICE_BYTES):
                tokens, limits = token_rows(part.column("text"), model.order)
                places = predicted(limits, model.order)
                bounds = limits - np.arange(len(limits)) * (model.order - 1)
                n = np.diff(bounds)
                counts, numbers, back = words_at(model, tokens)
                counts = counts[back[places]]
                base = np.add.reduceat(np.log10(counts + BASE_ADD) - floor, bounds[:-1])
                score = np.add.reduceat(np.log10(probabilities(model, numbers, back, places)), bounds[:-1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, (n, textcols.per_row(counts > 0, bounds), base, score, 10 ** (-score / n)))],
                    ["id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

    shape = f"id {picked.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double, perplexity double"
    return picked.mapInArrow(run, shape).withColumnRenamed("id", id_col)


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves 0 when divided by 10."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0
