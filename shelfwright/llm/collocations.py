"""Collocations by prefix-free parsing: frequent phrases are counted in distinct chunks of text, and scored.

**Parsing.** A text's words are cut into chunks where the hash of ``OVERLAP`` words says so, whatever stands around them; a
chunk goes on to the end of the next trigger, so neighbours overlap by ``OVERLAP`` words. The distinct chunks of a
language with their frequencies are the dictionary, a table in the shared folder. A passage that many texts share
becomes the same chunks in all of them, and is counted once, with its weight.

**Counting.** A phrase of up to ``OVERLAP + 1`` words lies whole in the chunk that owns its first word (all but the overlap
with the next), so it is counted once. Lengths are counted one after the other, as hashes: a phrase is only counted if both
phrases of one word less may be frequent. What may be frequent is a bitmap of a fixed size (``FILTER_BITS``): it only lets
through too much, never too little. A last pass counts the words themselves of what passed, exactly.

**Scoring** is joins and decimal arithmetic in Spark: the lowest ``floor(1000 a n / (l r))`` over the cuts of a phrase, with no
phrase that a longer one contains in the same number (in the given share).

Defined cases: NULL and empty texts have no words; a NULL language is ``und``; repeated rows count again; other columns are
ignored; an empty table has no phrases. Products are exact for up to 10^17 words of a language. A worker's memory follows
the longest text.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwright.llm import textcols
from shelfwright.llm.files import new_folder
from shelfwright.session import durable

LONGEST = 5
OVERLAP = LONGEST - 1
SPACING = 32  # words from one trigger to the next, on average
LEAST = 100
SHARE = 100  # percent of a phrase's occurrences inside a longer one that drop it
FIRST = 2000
FILTER_BITS = 26
SLICE = 2 << 20
UNKNOWN = "und"

CUTS = np.zeros(256, bool)
CUTS[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANKS = np.zeros(256, bool)
BLANKS[[9, 32]] = True

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed_bits(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    h = (h ^ (h >> np.uint64(32))) * STEP
    h = (h ^ (h >> np.uint64(32))) * STEP
    return h ^ (h >> np.uint64(32))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the range stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=total[1:])
    return mixed_bits((total[ends] - total[starts]) * powers(INVERSE, len(data))[starts])


def windows_of(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` neighbours of an array."""
    m = max(len(h) - k + 1, 0)
    out = np.zeros(m, np.uint64)
    for j in range(k):
        out = (out ^ h[j : j + m]) * BASE
        out ^= out >> np.uint64(29)
    return mixed_bits(out)


def parsed(texts: pa.Array, spacing: int = SPACING) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """The chunks of each text: its row, its words (a blank before each, a line end where a phrase cannot go on), how many
    of them it owns, and how many it shares with the next chunk."""
    data, bounds = textcols.flat(texts)
    data = textcols.lower_ascii(data)
    inside = ~(CUTS[data] | BLANKS[data])
    starts, ends = textcols.runs(inside, bounds)
    edges = np.searchsorted(starts, bounds)
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = textcols.owner(edges)
    cuts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(CUTS[data], out=cuts[1:])
    fresh = np.ones(n, bool)
    fresh[1:] = (cuts[starts[1:]] > cuts[ends[:-1]]) | (row[1:] != row[:-1])
    first = np.zeros(n, bool)
    first[edges[:-1][np.diff(edges) > 0]] = True
    trigger = windows_of(word_hashes(data, starts, ends), OVERLAP) % np.uint64(spacing) == 0
    opens = first.copy()
    opens[: len(trigger)] |= trigger & (row[: len(trigger)] == row[OVERLAP - 1 :])
    begin = np.flatnonzero(opens)
    after = np.append(begin[1:], n)
    last = np.append(first[begin[1:]], True)  # the next chunk belongs to another text
    shared = np.where(last, 0, OVERLAP)

    place = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    joined = np.empty(place[-1], np.uint8)
    between = np.zeros(place[-1], bool)
    between[place[:-1]] = True
    joined[place[:-1]] = np.where(fresh, 10, 32)
    joined[~between] = data[inside]
    whole = joined.tobytes()
    chunks = [whole[a:b] for a, b in zip((place[begin] + 1).tolist(), place[after + shared].tolist())]
    return row[begin], chunks, after - begin, shared


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", spacing: int = SPACING) -> DataFrame:
    """``lang``, ``chunk``, ``owned``, ``shared`` and ``times`` of every distinct chunk, in the shared folder."""
    picked = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text_col].cast("string").alias("text")
    )

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text", SLICE):
                row, chunks, owned, shared = parsed(part.column("text"), spacing)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("lang").take(pa.array(row)),
                        pa.array(chunks, pa.binary()).cast(pa.string()),
                        pa.array(owned.astype(np.int32)),
                        pa.array(shared.astype(np.int32)),
                    ],
                    ["lang", "chunk", "owned", "shared"],
                )

    chunks = picked.mapInArrow(run, "lang string, chunk string, owned int, shared int")
    distinct = chunks.groupBy("lang", "chunk", "owned", "shared").agg(F.count("*").alias("times"))
    folder = new_folder(docs.sparkSession, "phrase-chunks")
    distinct.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


class Phrases:
    """The words of a slice of chunks, and which stretches of them are phrases that the slice owns."""

    def __init__(self, part: pa.RecordBatch):
        self.data, bounds = textcols.flat(part.column("chunk"))
        self.starts, self.ends = textcols.runs((self.data != 32) & (self.data != 10), bounds)
        edges = np.searchsorted(self.starts, bounds)
        self.row = textcols.owner(edges)
        n = len(self.starts)
        self.owned = np.arange(n) - edges[self.row] < part.column("owned").to_numpy()[self.row]
        self.times = part.column("times").to_numpy().astype(float)[self.row]  # exact below 2^53
        self.fresh = np.zeros(n, bool)
        self.fresh[edges[:-1][np.diff(edges) > 0]] = True
        self.fresh[self.starts > 0] |= self.data[self.starts[self.starts > 0] - 1] == 10

    def unbroken(self, k: int) -> np.ndarray:
        """Whether ``k`` words from each place on are a phrase."""
        m = max(len(self.fresh) - k + 1, 0)
        return reduce(np.logical_and, (~self.fresh[j : j + m] for j in range(1, k)), np.ones(m, bool))

    def keys(self, part: pa.RecordBatch, lengths: range) -> dict[int, np.ndarray]:
        """Hashes of (language, phrase) from each place on, for each length."""
        langs = part.column("lang").dictionary_encode()
        data, bounds = textcols.flat(langs.dictionary)
        h = word_hashes(self.data, self.starts, self.ends)
        salt = word_hashes(data, bounds[:-1], bounds[1:])[langs.indices.to_numpy()][self.row] if len(h) else h
        return {k: mixed_bits(windows_of(h, k) + salt[: max(len(h) - k + 1, 0)]) for k in lengths}


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    at = keys & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def weighed(values: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values, a place of each, and its summed weight."""
    found, at, inverse = np.unique(values, return_index=True, return_inverse=True)
    return found, at, np.bincount(inverse, times, len(found)).astype(np.int64)


def frequent_hashes(chunks: DataFrame, k: int, shorter: np.ndarray | None, least: int, bits: int) -> np.ndarray:
    """A bitmap of the phrases of ``k`` words that may occur ``least`` times, given the one of a word less."""
    spark = chunks.sparkSession
    known = spark.sparkContext.broadcast(shorter)  # 2^bits bits, whatever the input

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "chunk", SLICE):
                words = Phrases(part)
                keys = words.keys(part, range(max(k - 1, 1), k + 1))
                stays = words.unbroken(k)
                m = len(stays)
                stays &= words.owned[:m]
                if k > 1 and m:
                    likely = passes(known.value, keys[k - 1])
                    stays &= likely[:m] & likely[1 : m + 1]
                found, _, total = weighed(keys[k][stays], words.times[:m][stays])
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(total)], ["h", "c"])

    counts = chunks.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= least)
    place = F.col("h").bitwiseAND((1 << bits) - 1)
    one = F.expr("shiftleft(1L, CAST(h & 63 AS INT))")
    cells = counts.groupBy(F.shiftright(place, 6).alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    known.unpersist()
    return out.view(np.uint64)


def phrase_counts(chunks: DataFrame, least: int = LEAST, bits: int = FILTER_BITS) -> DataFrame:
    """``lang``, ``size``, ``phrase`` and ``a`` of every phrase of 1 to ``LONGEST`` words that occurs ``least`` times."""
    maps: list[np.ndarray] = []
    for k in range(1, LONGEST + 1):
        maps.append(frequent_hashes(chunks, k, maps[-1] if maps else None, least, bits))
    likely = chunks.sparkSession.sparkContext.broadcast(np.stack(maps))

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "chunk", SLICE):
                words = Phrases(part)
                n = len(words.starts)
                if not n:
                    continue
                keys = words.keys(part, range(1, LONGEST + 1))
                ids, distinct = textcols.exact_ids(textcols.pieces(words.data, words.starts, words.ends))
                langs = part.column("lang").dictionary_encode().indices.to_numpy().astype(np.int64)
                whole = words.data.tobytes()
                places, same = np.arange(n), langs[words.row]  # equal numbers: equal language and words so far
                for k in range(1, LONGEST + 1):
                    on = places < n - k + 1
                    places, same = places[on], same[on]
                    on = words.unbroken(k)[places] & passes(likely.value[k - 1], keys[k][places])
                    places = places[on]
                    _, same = np.unique(same[on] * np.int64(distinct) + ids[places + k - 1], return_inverse=True)
                    mine = words.owned[places]
                    _, at, total = weighed(same[mine], words.times[places[mine]])
                    at = places[mine][at]
                    phrases = [whole[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at + k - 1].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("lang").take(pa.array(words.row[at])),
                            pa.array(np.full(len(at), k, np.int32)),
                            pa.array(phrases, pa.binary()).cast(pa.string()),
                            pa.array(total),
                        ],
                        ["lang", "size", "phrase", "c"],
                    )

    found = chunks.mapInArrow(run, "lang string, size int, phrase string, c long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)


def scored_phrases(counts: DataFrame, sizes: DataFrame, share: int = SHARE) -> DataFrame:
    """The phrases of two words and more that no longer one contains, with the parts and score of their worst cut.

    ``counts`` holds all frequent phrases, single words included, and ``sizes`` the words (``n``) of each language.
    """
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("times"))
    words = F.split("phrase", " ", -1)
    long = counts.filter(F.col("size") > 1).withColumn("words", words)
    inner = long.filter(F.col("size") > 2).select(
        "lang",
        F.explode(F.array(F.expr("slice(words, 1, size - 1)"), F.expr("slice(words, 2, size - 1)"))).alias("phrase"),
        "a",
    )
    inner = inner.groupBy("lang", F.array_join("phrase", " ").alias("phrase")).agg(F.max("a").alias("inside"))
    # a longer phrase still is no more frequent than these, so they suffice
    kept = long.join(inner, ["lang", "phrase"], "left").filter(
        F.col("inside").isNull() | (100 * F.col("inside") < share * F.col("a"))
    )
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.expr("slice(words, 1, k)"), " ").alias("left"),
        F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("right"),
    )
    left = parts.select("lang", F.col("part").alias("left"), F.col("times").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("times").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(sizes, "lang")

    def exact(name):
        return F.col(name).cast("decimal(20,0)")

    top = (exact("a") * exact("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)")
    score = F.call_function("div", top.cast("decimal(38,0)"), (exact("l") * exact("r")).cast("decimal(38,0)"))
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("worst")
    return cuts.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "worst.*")


def ranked(scored: DataFrame, first: int = FIRST, deals: int = 64) -> DataFrame:
    """Each language's ``first`` phrases, numbered from 1: the best of each deal, then the best of these."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = scored.withColumn("_deal", F.pmod(F.xxhash64("phrase"), F.lit(deals)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_deal").orderBy(*order)))
    some = some.filter(F.col("rank") <= first).drop("_deal", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return some.withColumn("rank", rank).filter(F.col("rank") <= first)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    share: int = SHARE,
    first: int = FIRST,
    spacing: int = SPACING,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's first phrases."""
    chunks = dictionary(docs, text_col, lang_col, spacing)
    counts = durable(phrase_counts(chunks, least, bits))
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("times")).alias("n"))
    found = ranked(scored_phrases(counts, sizes, share), first)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
