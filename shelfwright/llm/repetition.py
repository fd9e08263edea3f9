"""Quality rules on repeated text, from a suffix array over the words of each document.

Within a text, suffixes are sorted by prefix doubling (several texts at once, none compared with
another). Neighbours' longest common prefixes give for each word the longest repeat that starts there;
runs of neighbours with a common prefix of at least ``shortest`` words are the LCP intervals whose
strings are the repeated substrings. Their spans, all occurrences included, are united.

Defined cases: NULL and blank texts have no words, hence no repeats, and fail the word minimum; a text
of any length is handled whole (memory follows the longest text); repeated rows are judged alike; extra
columns are passed on by ``keep_quality`` and ignored by ``repetition_stats``. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwright.llm import textcols

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

WINDOW = 8  # words of a repeat that count against the base rule
MIN_WORDS = 20
BASE_PERCENT = 30  # of words in repeats of WINDOW words
SHORTEST = 5  # words of a repeat that count for the covered fraction
MAX_COVERED = 0.4
MAX_REPEAT = 200  # words of the longest repeat


def longest_repeats(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word, the most words from it on that occur again from another place of the same row.

    ``ids`` are word ids, ``bounds`` the row bounds. Suffixes are ranked by their first 1, 2, 4, ...
    words; only those that still share a rank go on to the next doubling.
    """
    n = len(ids)
    row = textcols.owner(bounds)
    end = bounds[1:][row] if n else row
    key = row * (int(ids.max()) + 1 if n else 1) + ids
    order = np.argsort(key, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = np.diff(key[order]) != 0
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels = []
    step = 1
    while True:
        active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1) if n else order
        if not len(active):
            break
        levels.append((step, rank.copy()))
        after = active + step
        inside = after < end[active]
        second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        by = np.lexsort((second, rank[active]))
        active, second = active[by], second[by]
        old = rank[active]
        at = np.arange(len(active))
        opens = np.ones(len(active), bool)
        opens[1:] = np.diff(old) != 0
        splits = opens.copy()
        splits[1:] |= np.diff(second) != 0
        group = np.maximum.accumulate(np.where(opens, at, 0))
        rank[active] = old + np.maximum.accumulate(np.where(splits, at, 0)) - group
        step *= 2
    best = np.zeros(n, np.int64)
    if not levels:
        return best
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    first = levels[0][1]
    left, right = suffixes[:-1], suffixes[1:]
    near = first[left] == first[right]
    left, right = left[near], right[near]
    common = np.zeros(len(left), np.int64)
    for step, rank_at in reversed(levels):
        a, b = left + common, right + common
        inside = (a < end[left]) & (b < end[right])
        same = inside & (rank_at[np.where(inside, a, 0)] == rank_at[np.where(inside, b, 0)])
        same &= np.where(inside, a, 0) != np.where(inside, b, 0)
        common += np.where(same, step, 0)
    np.maximum.at(best, left, common)
    np.maximum.at(best, right, common)
    return best


def covered(best: np.ndarray, shortest: int) -> np.ndarray:
    """Marks each word inside any repeat of at least ``shortest`` words."""
    change = np.zeros(len(best) + 1, np.int64)
    at = np.flatnonzero(best >= shortest)
    change[at] += 1
    np.subtract.at(change, at + best[at], 1)
    return np.cumsum(change[:-1]) > 0


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a column."""
    data, bounds = textcols.flat(column)
    starts, ends, words = textcols.word_runs(data, bounds)
    ids, _ = textcols.exact_ids(textcols.pieces(data, starts, ends))
    n_words = np.diff(words)
    best = longest_repeats(ids, words)
    spaces = textcols.SPACE[data]
    head = (data & 0xC0) != 0x80  # the first byte of a code point

    line_starts, line_ends = textcols.runs(data != 10, bounds)
    n_before = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    full = n_before[1] > n_before[0]
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_ids, n_ids = textcols.exact_ids(textcols.pieces(data, line_starts, line_ends))
    line_bounds = np.searchsorted(line_starts, bounds)
    distinct = np.unique(textcols.owner(line_bounds) * max(n_ids, 1) + line_ids)
    n_distinct = np.bincount(distinct // max(n_ids, 1), minlength=len(n_words))

    lengths = np.zeros(len(n_words), np.int64)
    np.maximum.at(lengths, textcols.owner(words), best)
    return {
        "n_words": n_words,
        "word_chars": textcols.per_row(head & ~spaces, bounds),
        "n_symbols": textcols.per_row(SYMBOLS[data], bounds),
        "n_dup_lines": np.diff(line_bounds) - n_distinct,
        "n_repeat_words": textcols.per_row(covered(best, WINDOW), words),
        "covered_words": textcols.per_row(covered(best, SHORTEST), words),
        "longest_repeat": lengths,
    }


def verdicts(
    m: dict[str, np.ndarray], max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT
) -> tuple[np.ndarray, np.ndarray]:
    """Base failures, and the texts kept: no base failure, and repeats within both limits."""
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
    good = (m["covered_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_repeat)
    return base, ~base & good


STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def repetition_stats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_covered: float = MAX_COVERED,
    max_repeat: int = MAX_REPEAT,
) -> DataFrame:
    """One row per document: its id, word, symbol, line and repeat counts, and the two verdicts."""
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                m = measure(part.column("text"))
                base, kept = verdicts(m, max_covered, max_repeat)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, m.values()), pa.array(base), pa.array(kept)],
                    ["id", *m, "base_failed", "kept"],
                )

    return picked.mapInArrow(run, f"id {id_type}, {STATS}").withColumnRenamed("id", id_col)


def keep_quality(
    docs: DataFrame, text_col: str = "text", max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """The rows whose text passes, with all their columns."""

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, text_col):
                _, kept = verdicts(measure(part.column(text_col)), max_covered, max_repeat)
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
