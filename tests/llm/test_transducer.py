"""The streaming encoder and decoder against the library, and its look-ahead against brute force."""

import hashlib
import random
import struct
import unicodedata
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwright.llm import queries, transducer

PATH = public_tokenizers.path("word_bpe_49k.json")
POOL = [
    "a", "b", "'s", "'", "'re", "'l", "l", "é", "é", "́", "̣", "Σ", "ΣΑΣ", "İ", "ß", " ", "  ", "\n", "\t", "　", "\x1c",
    "\x85", "1", "٣", "½", "😂", "🎉❤️", "中文", "가", "한", "<|endoftext|>", "<|startoftext|>", "<|end", "<|", "|>", "--", "!!",
    "_", "᫋", "᫁a", "\U00011935\U00011930", "͸", "Ω", "K", "ﬁ", "the", "ing", " hello", "\0",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def code():
    with open(PATH, encoding="utf-8") as f:
        return transducer.Codec(f.read())


@pytest.mark.parametrize("seed", range(3))
def test_streams_equal_the_library(code, library, seed):
    draw = random.Random(seed)
    for k in range(700):
        text = "".join(draw.choice(POOL) * draw.choice([1, 1, 2, 50 if k % 9 == 0 else 3]) for _ in range(draw.randrange(40)))
        want = library.encode(text, add_special_tokens=False).ids
        for block in (1, 3, 17, 1 << 16):
            assert list(transducer.encode(code, text, block)) == want, ascii(text)
        assert transducer.decode(code, array("I", want), block=3) == library.decode(want, skip_special_tokens=False)


def test_pre_tokens_without_end(code, library):
    draw = random.Random(4)
    letters = "".join(draw.choice("etaoinshr") for _ in range(20_000))
    for text in ("a" * 9_000, "haha" * 4_000 + "'s", "ab" * 3_000 + "!" * 9_000 + "x", "😂" * 3_000, "é" * 4_000, letters):
        want = library.encode(text, add_special_tokens=False).ids
        assert list(transducer.encode(code, text, 500)) == want
        word, most = transducer.Word(code), 0
        for c in unicodedata.normalize("NFC", text)[:6000]:
            word.feed(c)
            most = max(most, len(word.window))
        assert most <= code.merges.lookahead + 32 + 4  # the longest token, the last character's bytes


def random_rules(draw):
    made, rules = list("abc"), []
    while len(rules) < 14:
        pair = draw.choice(made), draw.choice(made)
        if "".join(pair) not in made and len("".join(pair)) < 9:
            rules.append(pair)
            made.append("".join(pair))
    return rules


def test_lookahead_suffices():
    draw = random.Random(7)
    least = 0
    for _ in range(300):
        rules = random_rules(draw)
        merges = transducer.Merges(rules, "")
        for _ in range(60):
            head = [draw.choice("abc") for _ in range(draw.randrange(30, 60))]
            one, other = (ends(merges, head + [draw.choice("abc") for _ in range(draw.randrange(12))]) for _ in range(2))
            differ = min((one ^ other) & set(range(len(head))), default=len(head))
            least = max(least, len(head) - differ)
            assert len(head) - differ <= merges.lookahead
    assert least > 5


def ends(merges, symbols):
    found, place = set(), 0
    slow = list(symbols)
    while True:  # rule by rule, leftmost first
        ranked = [(merges.ranks[p], i) for i, p in enumerate(zip(slow, slow[1:])) if p in merges.ranks]
        if not ranked:
            break
        i = min(ranked)[1]
        slow[i : i + 2] = [slow[i] + slow[i + 1]]
    assert merges.by_scan(list(symbols)) == slow == merges.by_heap(list(symbols))
    for token in slow:
        place += len(token)
        found.add(place)
    return found


def test_improper_lists_and_other_shapes_are_refused():
    with pytest.raises(ValueError, match="no earlier merge"):
        transducer.Merges([("ab", "c"), ("a", "b")], "")
    with pytest.raises(ValueError, match="same token"):
        transducer.Merges([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")], "")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError, match="shape"):
        transducer.Codec(f.read())


def test_plain_text_comes_back(code):
    text = "café 日本 😂😂 <|endoftext|>naïve x"
    ids = transducer.encode(code, text)
    for block in (1, 2, 100):
        plain = transducer.decode(code, ids, plain=True, block=block)
        assert plain.replace(" ", "") == text.replace(" ", "")
    assert transducer.decode(code, array("I"), plain=True) == ""
    assert transducer.decode(code, ids[2:3], plain=True).isprintable()


def test_query_equals_the_library(spark, library, tmp_path):
    texts = [None, "", " \n ", "Hello world's", "x" * 5000, "é" * 300, "same", "same", "<|endoftext|> a", "힣͸ b", "la " * 40_000]
    rows = [(i if i != 3 else None, t, "en", "n", 2, b"i", "d") for i, t in enumerate(texts)] + [(5, "é" * 300, "en", "n", 2, b"i", "d")]
    schema = "doc_id long, text string, lang string, n_tokens string, id long, ids binary, decoded string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op11_streaming_bpe"](spark, str(tmp_path)).collect()), key=repr)
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), *(hashlib.sha256(x).hexdigest() for x in (struct.pack(f"<{len(ids)}I", *ids), text.encode()))))
    assert got == sorted(want, key=repr)
    empty = spark.createDataFrame([], schema)
    assert transducer.encoded_texts(empty, PATH).count() == 0
