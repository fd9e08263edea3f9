"""Parts of the corpus operators that need no session: splices, suffix arrays, patterns, tagger, trees, permutations."""

import gzip
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwright.llm import archives, kneser_ney, mixing, private_data, repetition, shingles, superkmers, tagger, textcols

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def measured(texts):
    return list(zip(*[v.tolist() for v in repetition.measure(pa.array(texts, pa.string())).values()]))


def counted(text):
    text, w = text or "", words(text)
    lines = [x for x in text.split("\n") if words(x)]

    def cover(k):
        seen = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
        return len({j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)})

    longest = max((k for k in range(1, len(w)) if cover(k)), default=0)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), cover(8), cover(5), longest


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t|#", max_size=60)), max_size=6))
@settings(max_examples=60, deadline=None)
def test_repeats_equal_brute_force(texts):
    assert measured(texts) == [counted(t) for t in texts]


def test_repeats_of_one_word_and_of_a_long_text():
    many = "la " * 3000
    assert measured([many])[0][4:] == (3000, 3000, 2999)
    base, kept = repetition.verdicts(repetition.measure(pa.array([many, " ".join(map(str, range(50))), "few words"])))
    assert base.tolist() == [True, False, True] and kept.tolist() == [False, True, False]


def test_splices_are_exact():
    tokens = pytest.importorskip("shelfwright.llm.tokens")
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        small = tokens.Counter(f.read(), chunk=60, overlap=20)
    rng = random.Random(4)
    bits = ["a", "the", "é", " ", "  ", "\n", "'s", "'ll", "'", "<|endoftext|>", "<|endof", "text|>", "12", "!!", "\xa0", "x" * 70, "日本", "　"]
    widened = 0
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 120)))
        ids, _, more = small.whole(text)
        widened += more
        assert ids == small.encode(text).ids, repr(text)
    assert widened


def test_patterns_equal_a_plain_search():
    rng = random.Random(2)
    bits = ["a", "é", "@", "b.c", "@x.y", "1", "12", "192.168.1.4", ".", "+1 555 555 5555", "4539148803436467", " ", "-", "(", ")", "+", "🙂", "256.1.1.1"]
    texts = [None, ""] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(800)]

    def plain(text):
        found = []
        for kind, pattern in enumerate((private_data.EMAIL, private_data.IP, private_data.CARD, private_data.PHONE)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text or "") if private_data.right(kind, m[0])]
        return sorted(found)

    assert private_data.Texts(pa.array(texts)).spans() == [plain(t) for t in texts]


def test_tagger_gradient():
    rng = np.random.default_rng(0)
    w = tagger.fresh(3, 1)
    x, y = rng.integers(0, tagger.CLASSES, (7, 4)), rng.integers(0, tagger.LABELS, (7, 4))
    _, grad = tagger.loss_and_gradient(w, x, y)
    for name, value in w.items():
        at = tuple(rng.integers(0, s) for s in value.shape)
        kept, ends = value[at], []
        for step in (1e-2, -1e-2):
            value[at] = kept + step
            ends.append(tagger.loss_and_gradient(w, x, y)[0])
        value[at] = kept
        assert abs((ends[0] - ends[1]) / 2e-2 - grad[name][at]) < 5e-3, name


def private_text(rng):
    syllables = ["an", "ble", "th", "ing", "or", "nd", "est", "ha"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    some = [
        lambda: f"{word()}.{rng.randint(10, 99)}@mail{rng.randint(0, 9)}.example.com",
        lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
        lambda: "".join(str(rng.randint(0, 9)) for _ in range(16)),
    ]
    return " ".join(rng.choice(some)() if rng.random() < 0.06 else word() for _ in range(150))


def test_tagger_on_held_out_windows():
    rng = random.Random(1)
    made = private_data.training_windows(pa.array([private_text(rng) for _ in range(250)]))
    x, y = (np.array([np.frombuffer(r[i], np.uint8) for r in made]).T for i in (0, 1))
    n = x.shape[1] * 2 // 3
    w = tagger.fit(x[:, :n], y[:, :n], rounds=90)
    guess, gold = tagger.decode(w, np.ascontiguousarray(x[:, n:])), y[:, n:]
    assert (guess == gold).mean() > 0.95
    hit = ((guess == gold) & (gold > 0)).sum()
    assert hit / (gold > 0).sum() > 0.9

    # whole texts: pattern spans stay, windows of any cut agree with one window over all
    text = private_text(rng)
    spans = private_data.all_spans(w, pa.array([text, None, ""]))
    assert [s[:3] for s in spans[0] if s[3]] == private_data.Texts(pa.array([text])).spans()[0]
    assert spans[1:] == [[], []]
    short = private_data.tagged(w, private_data.Texts(pa.array([text])), 200, 80)
    whole = private_data.tagged(w, private_data.Texts(pa.array([text])), 4000, 80)
    assert (short == whole).mean() > 0.98


@given(st.lists(st.lists(st.integers(0, 9), max_size=6), max_size=7))
@settings(max_examples=80, deadline=None)
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(archives.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_records_survive_the_round_trip():
    digest = __import__("hashlib").sha256(b"body \xc3\xa9").hexdigest()
    data = archives.record("http://a.b/c\r\nX: y", 7, 1_700_000_000, "body é".encode(), digest, None)
    assert archives.described(gzip.decompress(gzip.compress(data))) == ("7", 7, digest, "response", None)
    again = archives.record("http://a.b/c", 9, 1_700_000_000, "body é".encode(), digest, 7)
    assert archives.described(again) == ("9", 7, digest, "revisit", "7")
    with pytest.raises(ValueError):
        archives.described(data.replace(b"body", b"hody"))


@pytest.mark.parametrize("size", [1, 2, 3, 17, 100, 1000])
def test_permutations_take_each_block_once(size):
    image = mixing.permuted(np.arange(size), size, b"key")
    assert sorted(image.tolist()) == list(range(size))
    if size > 50:
        assert image.tolist() != mixing.permuted(np.arange(size), size, b"other").tolist()


def test_targets_are_shared_again():
    goals = mixing.targets([100, 100, 100, 0])
    assert math.isclose(sum(goals), 450) and all(g <= 2 * s for g, s in zip(goals, [100, 100, 100, 0]))
    assert goals == [200.0, 166.66666666666669, 83.33333333333334, 0.0] or goals[0] == 200.0


def test_packed_strings_and_counts_survive():
    arrays = [np.array([5, 9, 1 << 40]), np.array([], np.int64)]
    back, text = superkmers.unpack(superkmers.pack(arrays, b"one two"))
    assert [a.tolist() for a in back] == [a.tolist() for a in arrays] and text == b"one two"
    columns = [np.array([3, 9, 2], np.uint64), np.array([1, 1, 4], np.uint64)]
    assert [a.tolist() for a in kneser_ney.expand(kneser_ney.squeeze(columns))] == [c.tolist() for c in columns]


def test_stored_ngrams_are_found_and_small(tmp_path):
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 64, 100_000, np.uint64))
    counts = np.where(rng.random(len(keys)) < 0.01, rng.integers(1, 1 << 40, len(keys)), rng.integers(1, 4, len(keys)))
    kinds = [np.where(rng.random(len(keys)) < 0.02, rng.integers(1, 2000, len(keys)), 1 + j) for j in range(4)]
    unseen = np.setdiff1d(rng.integers(0, 1 << 64, 10_000, np.uint64), keys)
    for name, values, bits in (("gram3", [counts], 4), ("context3", kinds, 8)):
        for n in (len(keys), 1, 2):
            kneser_ney.save_buckets(str(tmp_path), name, n, keys[:n], [v[:n] for v in values], bits)
            found = kneser_ney.opened(str(tmp_path), name, n).at(keys[:n])
            assert [f.tolist() for f in found] == [v[:n].tolist() for v in values]
        assert all(not f.any() for f in kneser_ney.opened(str(tmp_path), name, len(keys)).at(unseen))
    assert (tmp_path / "gram3" / str(len(keys))).stat().st_size < 5.5 * len(keys)  # a plain hash alone takes eight bytes


def test_numbers_of_ngrams_are_distinct_whether_they_fit_or_not():
    ranks = np.random.default_rng(2).integers(0, 9, 500).astype(np.uint64)
    places = np.arange(2, 500)
    want = [tuple(ranks[i - 2 : i + 1].tolist()) for i in places]
    for kinds in (9, 1 << 22):
        numbers = kneser_ney.ordered_grams(ranks, kinds, places, 3).tolist()
        assert len(set(numbers)) == len(set(want)) == len(set(zip(numbers, want)))
        assert not kneser_ney.fits(kinds, 3) or [g for _, g in sorted(zip(numbers, want))] == sorted(want)


def test_shingle_sets_by_size():
    texts = [None, "", " \n", "one", "One two", "a b a b a", "É a"]
    for k in (2, 5):
        _, bounds = shingles.shingle_sets(pa.array(texts), k)
        want = []
        for t in texts:
            w = words((t or "").replace("O", "o"))
            want.append(len({tuple(w[i : i + k]) for i in range(len(w) - k + 1)}) if len(w) >= k else int(bool(w)))
        assert np.diff(bounds).tolist() == want


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "b" * 50, "", "c"])], ["text"])
    assert [p.num_rows for p in textcols.row_slices(batch, "text", 10)] == [2, 1, 2]
    assert not list(textcols.row_slices(batch.slice(0, 0), "text", 10))
