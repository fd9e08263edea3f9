"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfwright.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, chunk string, phrase string, a long, size int, rank int, times int"


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        if found := re.findall(r"[^\x20\x09]+", piece):
            yield found


def by_brute_force(rows, least, first, share=100):
    sizes, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            sizes[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    f = {p: a for p, a in f.items() if a >= least}
    inside = Counter()
    for (lang, p), a in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(inside[lang, p[i : i + k]], a)
    out = []
    for (lang, p), a in f.items():
        if len(p) > 1 and not 100 * inside[lang, p] >= share * a:
            n = sizes[lang]
            score, _, l, r = min(
                ((1000 * a * n) // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))
            )
            out.append((lang, " ".join(p), a, l, r, n, score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranks = Counter()
    for lang, *rest in out:
        ranks[lang] += 1
        if ranks[lang] <= first:
            yield (lang, ranks[lang], *rest)


def fixture_rows():
    draw = random.Random(2)
    vocabulary = ["the", "The", "of", "é", "日本", "a\x00b", "x-y", "new", "york", "city", "ß", "'"]

    def sentence():
        return " ".join(draw.choices(vocabulary, range(12, 0, -1), k=draw.randrange(1, 12)))

    ends = [" ", "\t", ". ", "\n", "!?", ",", "\x0b"]
    texts = ["".join(sentence() + draw.choice(ends) for _ in range(draw.randrange(9))) for _ in range(80)]
    rows = [(draw.choice(["en", "en", "de", None, "und", ""]), t) for t in texts]
    rows += [("en", "new york city is big " * 30)] * 20 + [("en", "la " * 2000), ("en", None), (None, ""), ("fr", " .;\n ")]
    rows += [("de", " ".join(f"w{i % 700}" for i in range(3000)))]
    return rows


@pytest.mark.parametrize("least, first, spacing, share", [(3, 10**6, 4, 100), (3, 7, 32, 100), (2, 10**6, 1, 60)])
def test_counts_and_scores(spark, least, first, spacing, share):
    rows = fixture_rows()
    made = [(i % 9, t, lang, "c", "p", 1, 2, 3, 4) for i, (lang, t) in enumerate(rows)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(5)
    got = collocations.collocations(docs, least=least, first=first, spacing=spacing, share=share, bits=14)
    assert sorted(map(tuple, got.collect())) == sorted(by_brute_force(rows, least, first, share))


def test_a_full_filter_loses_and_adds_nothing(spark):
    rows = [r for r in fixture_rows() if r[0] == "en"]
    docs = spark.createDataFrame([(t, lang) for lang, t in rows], "text string, lang string")
    got = collocations.collocations(docs, least=2, first=10**6, bits=7)  # nearly all of the bits are set
    assert sorted(map(tuple, got.collect())) == sorted(by_brute_force(rows, 2, 10**6))


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_products_beyond_64_bits(spark):
    counts = [("en", 1, "a", 3 * 10**9), ("en", 1, "b", 5 * 10**9), ("en", 2, "a b", 2 * 10**9 + 1)]
    counts = spark.createDataFrame(counts, "lang string, size int, phrase string, a long")
    sizes = spark.createDataFrame([("en", 7 * 10**16)], "lang string, n long")
    (row,) = collocations.scored_phrases(counts, sizes).collect()
    assert row["score"] == 1000 * (2 * 10**9 + 1) * 7 * 10**16 // (15 * 10**18)


@pytest.mark.parametrize("spacing", [1, 3, 32])
def test_parse_owns_each_word_once(spacing):
    texts = [t for _, t in fixture_rows()]
    row, chunks, owned, shared = collocations.parsed(pa.array(texts, pa.string()), spacing)
    for i, text in enumerate(texts):
        found = []
        for at in np.flatnonzero(row == i):
            words = re.split(rb"[ \n]", chunks[at])
            assert len(words) == owned[at] + shared[at]
            found += words[: owned[at]]
        assert found == [w.encode() for p in pieces(text) for w in p]


def test_shared_passages_become_the_same_chunks():
    draw = random.Random(1)
    passage = " ".join(f"p{draw.randrange(900)}" for _ in range(600))
    texts = [f"some words {i} before {passage} and {i} after" for i in range(5)]
    row, chunks, _, _ = collocations.parsed(pa.array(texts, pa.string()), 16)
    common = set.intersection(*({c for c, r in zip(chunks, row) if r == i} for i in range(5)))
    assert sum(len(c.split()) for c in common) > 450
