"""Exact removal of repeated word windows, with super-k-mer partitioning.

A window is ``window`` consecutive words of one text. A word is removed where it lies in a window whose words also
start earlier: in a smaller id, or earlier in the same text.

**Partitioning.** The minimiser of a window is the smallest hash of its ``m``-word grams. Consecutive windows with
one minimiser form a super-k-mer: their words travel once, as one packed string, to the minimiser's bucket. Equal
windows have equal minimisers, so each bucket counts its windows on its own. All super-k-mers that a slice of texts
sends to one bucket share a compressed row.

**Counting.** A bucket gives its words exact ids, sorts its windows by hash in the order of (id, start), and compares
each window with the first of its hash word by word; it returns the spans of those that are no first.

**Skew.** Equal super-k-mers of one slice are sent once (the others surely start later than the first, and are
removed on the spot), so a text copied many times costs a bucket one row per slice. Minimisers that many different
super-k-mers share (a frequent line in ever new surroundings) are counted beforehand and rank last among grams;
windows of nothing else are dealt out by their own hash. The list has at most ``MOST_HOT`` entries, by its threshold.
Buckets are as many as the bytes of text ask for, so one bucket fits in a task at any size.

Defined cases: NULL, empty and short texts have no windows and keep their words; ids are integers, NULL as the
largest; rows that repeat an id and a text are one document, rows that repeat an id alone are ordered by a hash of
their text; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.llm import textcols
from shelfwright.llm.shingles import gram_hashes, scrambled, word_hashes
from shelfwright.session import durable

WINDOW = 20
GRAM = 4
BUCKET_BYTES = 2 << 20  # of text per bucket; its super-k-mers are about four times as many
SLICE_BYTES = 8 << 20
MOST_HOT = 1_000_000
LEAST_HOT = 2_000
BROADCAST_IDS = 500_000  # document keys small enough to send to all tasks
RUN_BYTES = 40  # of text per super-k-mer, about

_TOP = np.uint64(1 << 63)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_Q_INVERSE = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))


def chain(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, base ** 1, ... of n numbers."""
    values = np.full(n, base, np.uint64)
    values[:1] = 1
    return np.multiply.accumulate(values)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    least = values[:n].copy()
    for j in range(1, width):
        np.minimum(least, values[j : j + n], out=least)
    return least


class Slice:
    """The super-k-mers of a column of texts."""

    def __init__(self, column: pa.Array, window: int, m: int, hot: np.ndarray):
        data, bounds = textcols.flat(column)
        starts, ends, words = textcols.word_runs(data, bounds)
        n = len(starts) - window + 1
        self.text = b""
        if n <= 0:
            self.row = self.start = self.count = self.lo = self.hi = np.zeros(0, np.int64)
            self.key = self.content = np.zeros(0, np.uint64)
            return
        lengths = ends - starts
        at = np.cumsum(lengths + 1) - (lengths + 1)
        packed = np.full(int(at[-1] + lengths[-1] + 1), 32, np.uint8)
        letters = data[~textcols.SPACE[data]]
        packed[np.arange(len(letters)) + np.repeat(np.arange(len(starts)), lengths)] = letters
        self.text = packed.tobytes()
        hashed = word_hashes(data, starts, ends)
        row = textcols.owner(words)
        valid = np.arange(n) + window <= words[1:][row[:n]]
        grams = gram_hashes(hashed, m)
        rank = grams >> np.uint64(1)
        if len(hot):
            near = np.minimum(np.searchsorted(hot, rank), len(hot) - 1)
            rank = np.where(hot[near] == rank, rank | _TOP, rank)
        key = sliding_least(rank, window - m + 1)
        only_hot = np.flatnonzero(key >= _TOP)
        if len(only_hot):
            key[only_hot] = gram_hashes(hashed, window)[only_hot] | _TOP
        opens = valid.copy()
        opens[1:] &= ~valid[:-1] | (key[1:] != key[:-1])
        closes = valid.copy()
        closes[:-1] &= ~valid[1:] | (key[1:] != key[:-1])
        first, last = np.flatnonzero(opens), np.flatnonzero(closes) + window - 1
        self.row, self.start = row[first], first - words[:-1][row[first]]
        self.count = last - first - window + 2
        self.lo, self.hi = at[first], at[last] + lengths[last]
        self.key = key[first]
        sums = np.zeros(len(hashed) + 1, np.uint64)
        np.cumsum(hashed * chain(_Q, len(hashed)), out=sums[1:])
        self.content = (sums[last + 1] - sums[first]) * chain(_Q_INVERSE, len(hashed))[first] + self.count.astype(np.uint64)

    def repeated(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Marks super-k-mers whose packed string another, earlier one of the slice has."""
        order = np.lexsort((self.start, hashes[self.row], ids[self.row], self.content))
        content = self.content[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = content[1:] != content[:-1]
        first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        again = np.zeros(len(order), bool)
        for i, j in zip(order[~fresh].tolist(), first[~fresh].tolist()):
            same_place = ids[self.row[i]] == ids[self.row[j]] and hashes[self.row[i]] == hashes[self.row[j]] and self.start[i] == self.start[j]
            again[i] = not same_place and self.text[self.lo[i] : self.hi[i]] == self.text[self.lo[j] : self.hi[j]]
        return again


def pack(arrays: list[np.ndarray], text: bytes) -> bytes:
    """Arrays of 64-bit values and a text, compressed into one string."""
    raw = b"".join(a.astype(np.int64).tobytes() for a in arrays) + text
    head = np.array([len(raw), len(arrays), *map(len, arrays)], np.int64)
    return head.tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)


def unpack(data: bytes) -> tuple[list[np.ndarray], bytes]:
    size, n = np.frombuffer(data, np.int64, 2)
    counts = np.frombuffer(data, np.int64, int(n), 16)
    raw = pa.Codec("zstd").decompress(data[16 + 8 * int(n) :], int(size), asbytes=True)
    arrays, at = [], 0
    for c in counts.tolist():
        arrays.append(np.frombuffer(raw, np.int64, c, at))
        at += 8 * c
    return arrays, raw[at:]


def doc_keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("id").to_numpy(), part.column("hash").to_numpy()


def crowded_keys(picked: DataFrame, window: int, m: int, threshold: int) -> np.ndarray:
    """Minimisers with more than ``threshold`` different super-k-mers, at least four in a slice each; ascending."""

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text", SLICE_BYTES):
                found = Slice(part.column("text"), window, m, np.zeros(0, np.uint64))
                once = np.unique(np.stack([found.key, found.content]), axis=1) if len(found.key) else np.zeros((2, 0), np.uint64)
                keys, counts = np.unique(once[0], return_counts=True)
                many = counts >= 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], ["key", "n"]
                )

    rows = picked.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > threshold)
    return np.sort(np.array([r["key"] for r in rows.select("key").collect()], np.int64).view(np.uint64))


def spans_of(window: int, table: pa.Table) -> pa.Table:
    """The removed spans of one bucket."""
    parts, done = [], []
    for data in table.column("data").to_pylist():
        arrays, text = unpack(data)
        parts.append((*arrays[:5], text))
        done.append(arrays[5:])
    ids, hashes, start, count, size = (np.concatenate([p[i] for p in parts]) for i in range(5))
    ends = np.cumsum(size)
    text = np.frombuffer(b"".join(p[5] for p in parts), np.uint8)
    order = np.lexsort((start, hashes, ids))
    if len(order):
        same = np.zeros(len(order), bool)
        same[1:] = (np.diff(ids[order]) == 0) & (np.diff(hashes[order]) == 0) & (np.diff(start[order]) == 0)
        order = order[~same]  # rows that repeat an id and a text
    bounds = np.concatenate([[0], ends])
    starts, stops, words = textcols.word_runs(text, bounds)
    word_ids, _ = textcols.exact_ids(textcols.pieces(text, starts, stops))
    # windows in the order of (id, start)
    n = count[order]
    owner = np.repeat(np.arange(len(order)), n)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = words[:-1][order][owner] + offset
    grams = gram_hashes(scrambled(word_ids.astype(np.uint64) + np.uint64(1)), window)[at] if len(at) else np.zeros(0, np.uint64)
    by = np.argsort(grams, kind="stable")
    fresh = np.ones(len(by), bool)
    fresh[1:] = grams[by][1:] != grams[by][:-1]
    first = np.empty(len(by), np.int64)
    first[by] = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
    again = first != np.arange(len(by))
    later = np.flatnonzero(again)
    equal = np.ones(len(later), bool)
    for j in range(window):
        equal &= word_ids[at[later] + j] == word_ids[at[first[later]] + j]
    if not equal.all():  # different windows with one hash: settle these hashes by the words themselves
        for h in np.unique(grams[later[~equal]]):
            seen: set = set()
            for i in np.flatnonzero(grams == h).tolist():
                key = word_ids[at[i] : at[i] + window].tobytes()
                again[i] = key in seen
                seen.add(key)
    opens = again.copy()
    opens[1:] &= ~again[:-1] | (owner[1:] != owner[:-1])
    closes = again.copy()
    closes[:-1] &= ~again[1:] | (owner[1:] != owner[:-1])
    a, b = np.flatnonzero(opens), np.flatnonzero(closes)
    run = order[owner[a]]
    columns = [
        np.concatenate([x, *[d[i] for d in done]])
        for i, x in enumerate((ids[run], hashes[run], start[run] + offset[a], start[run] + offset[b] + window))
    ]
    return pa.table([pa.array(c) for c in columns], names=["id", "hash", "lo", "hi"])


def repeated_spans(picked: DataFrame, window: int = WINDOW, m: int = GRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, hash, lo, hi): spans of words to remove from the texts of (id, text, hash); they may overlap."""
    total = picked.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = total // bucket_bytes + 1
    hot = crowded_keys(picked, window, m, max(LEAST_HOT, total // RUN_BYTES // MOST_HOT))
    shared = picked.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text", SLICE_BYTES):
                ids, hashes = doc_keys(part)
                found = Slice(part.column("text"), window, m, shared.value)
                again = found.repeated(ids, hashes)
                to = (scrambled(found.key) >> np.uint64(1)).astype(np.int64) % buckets
                where = np.where(again, -1, to)
                order = np.argsort(where, kind="stable")
                gone = np.flatnonzero(again)
                home = ids[found.row[gone]] % buckets
                gone = gone[np.argsort(home, kind="stable")]
                home = np.sort(home)
                names, rows = [], []
                for k in np.union1d(where[where >= 0], home).tolist():
                    at = order[slice(*np.searchsorted(where[order], [k, k + 1]))]
                    out = gone[slice(*np.searchsorted(home, [k, k + 1]))]
                    text = b"".join([found.text[a:b] for a, b in zip(found.lo[at].tolist(), found.hi[at].tolist())])
                    row, rid = found.row[at], found.row[out]
                    arrays = [ids[row], hashes[row], found.start[at], found.count[at], found.hi[at] - found.lo[at]]
                    arrays += [ids[rid], hashes[rid], found.start[out], found.start[out] + found.count[out] + window - 1]
                    names.append(k)
                    rows.append(pack(arrays, text))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(rows, pa.binary())], ["bucket", "data"])

    packed = picked.mapInArrow(run, "bucket long, data binary")
    return packed.groupBy("bucket").applyInArrow(lambda t: spans_of(window, t), "id long, hash long, lo long, hi long")


def kept_words(column: pa.Array, spans: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words, removed words and the kept words joined by spaces, of each text. ``spans``: a list of (lo, hi) per text."""
    data, bounds = textcols.flat(column)
    starts, ends, words = textcols.word_runs(data, bounds)
    change = np.zeros(len(starts) + 1, np.int64)
    counts = np.nan_to_num(pc.list_value_length(spans).to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = spans.flatten()
    if len(flat):
        base = np.repeat(words[:-1], counts)
        np.add.at(change, base + flat.field(0).to_numpy(), 1)
        np.subtract.at(change, base + flat.field(1).to_numpy(), 1)
    gone = np.cumsum(change[:-1]) > 0
    keep = np.flatnonzero(~gone)
    joined = textcols.pieces(data, starts[keep], ends[keep])
    values = joined.to_pylist()
    at = np.searchsorted(keep, words).tolist()
    texts = [b" ".join(values[at[i] : at[i + 1]]) for i in range(len(bounds) - 1)]
    return np.diff(words), textcols.per_row(gone, words), texts


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, m: int = GRAM, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Per document: id, n_words, n_removed and the kept words as text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    largest = F.lit(np.iinfo(np.int64).max)
    picked = docs.select(F.coalesce(F.col(id_col).cast("long"), largest).alias("id"), text.alias("text"))
    unique = picked.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    # the hash tells texts of one id apart, and costs as much as all else that goes with a super-k-mer
    picked = picked.withColumn("hash", F.lit(0).cast("long") if unique else F.xxhash64("text"))
    spans = durable(
        repeated_spans(picked, window, m, bucket_bytes)
        .groupBy(F.col("id").alias("i"), F.col("hash").alias("h"))
        .agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    )
    same = (F.col("id") == F.col("i")) & (F.col("hash") == F.col("h"))
    if spans.count() <= BROADCAST_IDS:  # only texts with spans have to meet them in a shuffle
        keys = F.broadcast(spans.select("i", "h"))
        whole = picked.join(keys, same, "left_anti").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
        joined = picked.join(keys, same, "left_semi").join(spans, same).select("id", "text", "hash", "spans").unionByName(whole)
    else:
        joined = picked.join(spans, same, "left")
    joined = joined.select(F.nullif("id", largest).alias("id"), "text", "spans")

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                n, gone, texts = kept_words(part.column("text"), part.column("spans"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(gone), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["id", "n_words", "n_removed", "text"],
                )

    return joined.mapInArrow(run, "id long, n_words long, n_removed long, text string").select(
        F.col("id").alias(id_col), "n_words", "n_removed", F.col("text").alias(text_col)
    )
