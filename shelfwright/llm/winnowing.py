"""Benchmark decontamination by winnowing, in DataFrame expressions only.

A window of ``window`` words is contaminated where it equals a window of a benchmark item. Both sides keep
the smallest ``k``-gram hash of every run of ``window - k + 1`` k-grams (ties included), so any two equal
windows keep the same k-gram at the same place in them. Kept fingerprints are joined, and each hit is
extended: the windows around the shared k-gram are compared word by word, so no hash decides a result.
Items shorter than a window count as one window of their own length; for them every n-gram of that length
is a fingerprint.

The benchmark side is broadcast while its texts together stay under ``broadcast_bytes`` (measured), and
shuffled beyond it, where adaptive execution splits hot fingerprints.

Defined cases: NULL or wordless texts and items have no windows; repeated items all count; a NULL id is an id
like any other; rows that share an id share their hits; other columns are ignored; without documents the
result is empty, without items nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.session import durable

WINDOW = 13
K = 7
BROADCAST_BYTES = 8 << 20
BROADCAST_IDS = 500_000  # ids small enough to send to all tasks

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text."""
    return F.regexp_extract_all(lowered(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def lowered(text: Column) -> Column:
    """A-Z lower-cased: ``lower`` does no more to texts of one byte a character, and is much faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_of(text: Column) -> Column:
    """How many words a text has. Letters of either case count, so none has to be lower-cased."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(ANY_CASE_WORD))


def upto(n: Column) -> Column:
    """0, 1, ..., n - 1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def fingerprints(texts: DataFrame, keep: list[str], k: int, window: int) -> DataFrame:
    """Columns ``keep`` and ``words``, and one row per kept k-gram of ``words``: its place and hash.

    The explode is an outer one: an inner one would make Spark test the array before it, and so compute it twice.
    """
    width = window - k + 1
    hashed = texts.filter(F.size("words") >= window).select(
        *keep,
        "words",
        F.transform(
            upto(F.size("words") - (k - 1)), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(k)])
        ).alias("_g"),
    )
    if width == 1:
        picked = hashed.withColumn("_at", upto(F.size("_g")))
    else:
        least = F.transform(
            upto(F.size("_g") - (width - 1)), lambda s: F.least(*[F.get("_g", s + j) for j in range(width)])
        )

        def smallest(i: Column) -> Column:
            own, found = F.get("_g", i), F.lit(False)
            for j in range(width):
                found = found | (own == F.get("_m", i - j))
            return found

        picked = hashed.withColumn("_m", least).withColumn("_at", F.filter(upto(F.size("_g")), smallest))
    marks = picked.select(
        *keep, "words", F.transform("_at", lambda i: F.struct(i.alias("at"), F.get("_g", i).alias("hash"))).alias("_f")
    )
    return marks.select(*keep, "words", F.explode_outer("_f").alias("_f")).select(*keep, "words", "_f.at", "_f.hash")


def around(words: str, at: str, k: int, window: int) -> Column:
    """The words of all windows that hold the k-gram at a place, and how many of them stand before it."""
    reach = window - k
    before = F.least(F.col(at), F.lit(reach))
    return F.struct(F.slice(words, F.col(at) - before + 1, before + F.lit(window)).alias("words"), before.alias("before"))


def extended(k: int, window: int) -> Column:
    """How far before the shared k-gram each equal window starts."""

    def same(a: Column) -> Column:
        def part(side: str) -> Column:
            return F.slice(F.col(f"{side}.words"), F.col(f"{side}.before") - a + 1, window)

        return (
            (a <= F.col("_d.before"))
            & (a <= F.col("_i.before"))
            & (F.size(part("_d")) == window)
            & (part("_d") == part("_i"))
        )

    # slice() needs a start of 1 or more, so places before the first word are never asked for
    return F.filter(F.sequence(F.lit(0), F.least(F.col("_d.before"), F.col("_i.before"))), same)


def window_hits(docs: DataFrame, items: DataFrame, k: int, window: int, small: bool) -> DataFrame:
    """Rows (doc, item, start, stop): each occurrence in ``docs`` of a window of ``items``."""
    there = fingerprints(items, ["_item"], k, window).select("hash", "_item", around("words", "at", k, window).alias("_i"))
    here = fingerprints(docs, ["_doc"], k, window)
    if small:  # the document's words are only cut where the join finds something
        joined = here.join(F.broadcast(there), "hash").withColumn("_d", around("words", "at", k, window))
    else:
        joined = here.select("_doc", "at", "hash", around("words", "at", k, window).alias("_d")).join(there, "hash")
    return (
        joined.select("_doc", "_item", "at", F.explode_outer(extended(k, window)).alias("_back"))
        .filter(F.col("_back").isNotNull())
        .select("_doc", "_item", (F.col("at") - F.col("_back")).alias("start"), (F.col("at") - F.col("_back") + window).alias("stop"))
    )


def hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    k: int = K,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All occurrences of benchmark windows: (id_col, item_col, start, stop), in words."""
    d = docs.select(F.col(id_col).alias("_doc"), words_of(F.col(text_col)).alias("words"))
    i = items.select(F.col(item_col).alias("_item"), words_of(F.col(item_text_col)).alias("words"))
    sizes = items.agg(F.sum(F.octet_length(F.col(item_text_col).cast("string"))).alias("n")).first()["n"] or 0
    small = sizes <= broadcast_bytes
    short = [r["n"] for r in i.select(F.size("words").alias("n")).filter((F.col("n") > 0) & (F.col("n") < window)).distinct().collect()]
    found = window_hits(d, i, k, window, small)
    for n in sorted(short):  # fewer than ``window`` lengths
        found = found.unionByName(window_hits(d, i.filter(F.size("words") == n), n, n, small))
    return found.select(F.col("_doc").alias(id_col), F.col("_item").alias(item_col), "start", "stop")


def united(spans: Column) -> Column:
    """The number of places in a union of (start, stop) spans."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["to"]))).alias("n"),
        F.greatest(acc["to"], s["stop"]).alias("to"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["n"].cast("long"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, n_words, n_hit, the sorted item ids (as strings), contaminated.

    Contaminated: some word is hit, and at least one word in twenty.
    """
    found = (
        hits(docs, items, id_col, text_col, **options)
        .groupBy(F.col(id_col).alias("_doc"))
        .agg(
            F.collect_set(F.struct("start", "stop")).alias("_spans"),
            F.collect_set(F.col(options.get("item_col", "item_id")).cast("string")).alias("_items"),
        )
        .select("_doc", united(F.col("_spans")).alias("_hit"), F.array_sort("_items").alias("_items"))
    )
    counted = docs.select(F.col(id_col).alias("_id"), count_of(F.col(text_col)).cast("long").alias("n_words"))
    n_hit = F.coalesce("_hit", F.lit(0)).cast("long")
    return counted.join(found, F.col("_id").eqNullSafe(F.col("_doc")), "left").select(
        F.col("_id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns. A document is dropped by its id."""
    bad = durable(
        contamination(docs, items, id_col, text_col, **options)
        .filter("contaminated")
        .select(F.col(id_col).alias("_bad"))
        .distinct()
    )
    few = bad.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(bad) if few else bad, docs[id_col].eqNullSafe(bad["_bad"]), "left_anti")
