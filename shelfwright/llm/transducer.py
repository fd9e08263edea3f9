"""BPE with word ends as a streaming transducer of bounded look-ahead, and its decoding machine.

**Look-ahead.** Merges run in rank order, and every token is made by one rule whose parts are made by earlier rules
(``Merges`` refuses any other list). Let two strings agree on their first ``p`` symbols, and let ``D`` be the leftmost
place at which a boundary survives in one and not in the other. Only a rule of a higher rank can move ``D`` to the left:
after ``q = (a, b)`` closed the boundary ``D`` in one string, the next change is a rule ``(u, v)`` that either has ``a b``
at the left edge of ``v``, in the same string, or has ``v = a``, in the other one. Either way ``D`` moves by the length of ``a``.
The first change lies less than the length of its right part before ``p``. So the longest weighted path over the rules, in
rank order, bounds how far a change can reach (``Merges.lookahead``): a boundary further than that from the end of
what was read is final, and so is every token before it. What follows a final boundary is merged as if it stood alone.

**Stages**, each with a bounded state: special tokens are found in the raw text, with a held prefix; the text is put in
composed form up to a character that composes with nothing before it; it is cut into pre-tokens, of which at most the last
two are held; a pre-token longer than ``LONG`` is merged while it is still being read. Only a sequence of
combining marks, or of characters newer than Python's Unicode tables, without any ASCII blank, is held as long as it is.

**Decoding** takes ids as they come: without a decoder in the tokenizer's file, its tokens are joined by blanks, as the
library does; ``plain`` also gives the readable text, from bytes, holding back the bytes of an unfinished character.

Defined cases: NULL and empty texts have no tokens and decode to the empty text; repeated rows give repeated results; other
columns are ignored; an empty table gives an empty result. A tokenizer of another shape is refused.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfwright.llm import textcols

BLOCK = 65536  # code points fed at a time
LONG = 1024  # symbols of a pre-token from which it is merged while it is read
REMEMBERED = 1 << 18  # pre-tokens a worker remembers

_LOADED: dict[int, "Codec"] = {}


class Merges:
    """The merge list: ranks of pairs, and the look-ahead that suffices for it."""

    def __init__(self, rules: list[tuple[str, str]], end: str):
        self.end = end
        self.ranks = {tuple(rule): rank for rank, rule in enumerate(rules)}
        made: set[str] = set()
        touched: dict[str, int] = {}  # reach of a change at the left edge of a token
        beside: dict[str, int] = {}  # reach of a change after a token that is some rule's left part
        self.lookahead = 0
        for left, right in rules:
            for part in (left, right):
                if self.length(part) > 1 and part not in made:
                    raise ValueError("a merge uses a token that no earlier merge makes")
            if left + right in made:
                raise ValueError("two merges make the same token")
            made.add(left + right)
            reach = max(self.length(right) - 1, touched.get(right, 0), beside.get(right, 0))
            self.lookahead = max(self.lookahead, reach)
            beside[left] = max(beside.get(left, 0), reach + self.length(left))
            touched[left + right] = max(touched.get(left, 0), reach + self.length(left))

    def length(self, token: str) -> int:
        """Symbols in a token; the word end belongs to its last symbol."""
        return len(token) - len(self.end) * (self.end != "" and token.endswith(self.end) and len(token) > len(self.end))

    def merge(self, symbols: list[str]) -> list[str]:
        """The tokens of a symbol sequence, which is used up."""
        return self.by_scan(symbols) if len(symbols) <= 24 else self.by_heap(symbols)

    def by_scan(self, symbols: list[str]) -> list[str]:
        rank, none = self.ranks.get, len(self.ranks)
        tokens = symbols
        found = [rank(pair, none) for pair in zip(tokens, tokens[1:])]
        while found and (best := min(found)) < none:
            i = found.index(best)
            tokens[i] += tokens.pop(i + 1)
            del found[i]
            if i < len(found):
                found[i] = rank((tokens[i], tokens[i + 1]), none)
            if i:
                found[i - 1] = rank((tokens[i - 1], tokens[i]), none)
        return tokens

    def by_heap(self, symbols: list[str]) -> list[str]:
        rank = self.ranks.get
        tokens: list[str | None] = list(symbols)
        after = [*range(1, len(tokens)), -1]
        before = list(range(-1, len(tokens) - 1))
        heap = [(rank(pair), i) for i, pair in enumerate(zip(tokens, tokens[1:])) if pair in self.ranks]
        heapq.heapify(heap)
        while heap:
            wanted, i = heapq.heappop(heap)
            j = after[i]
            if tokens[i] is None or j < 0 or rank((tokens[i], tokens[j])) != wanted:
                continue  # a part of this pair went into another merge
            tokens[i] += tokens[j]
            tokens[j] = None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (found := rank((tokens[x], tokens[y]))) is not None:
                    heapq.heappush(heap, (found, x))
        return [t for t in tokens if t is not None]


def byte_signs() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    signs, spare = [], 256
    for b in range(256):
        printable = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b
        signs.append(chr(b if printable else spare))
        spare += not printable
    return signs


def settled(char: str) -> bool:
    """Whether a character never joins what stands before it in composed form."""
    return unicodedata.category(char)[0] != "M" and not unicodedata.combining(char) and not "ᅠ" <= char <= "ᇿ"


class Codec:
    """A tokenizer file's vocabulary, merges and pattern; encodes and decodes streams."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec = json.loads(source)
        model = spec["model"]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        shape = [
            model["type"] == "BPE" and not model.get("continuing_subword_prefix") and not model.get("ignore_merges"),
            not model.get("dropout"),
            [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"],
            [s["type"] for s in steps] == ["Split", "ByteLevel"],
            all(s.get("behavior", "Removed") == "Removed" and s.get("invert", True) for s in steps),
            not any(s.get("add_prefix_space") or s.get("use_regex") for s in steps),
            spec.get("decoder") is None and spec.get("post_processor") is None,
            not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]),
        ]
        if not all(shape):
            raise ValueError("a tokenizer of another shape")
        self.end = model.get("end_of_word_suffix") or ""
        self.merges = Merges([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], self.end)
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        self.signs = byte_signs()
        self.by_sign = {s: b for b, s in enumerate(self.signs)}
        pattern = steps[0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern, regex.V0)
        # the same classes within ASCII, for the faster matcher; None where the pattern has classes of another kind
        for kind, signs in ((r"\p{L}", "A-Za-z"), (r"\p{N}", "0-9"), (r"\s", r"\x09-\x0d\x20")):
            pattern = pattern.replace(kind, signs)
        inside = re.sub(r"\\x[0-9a-f]{2}", "", pattern)
        self.ascii_pattern = re.compile(pattern) if "\\" not in inside and "." not in inside else None
        self.marker = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.library = Tokenizer.from_str(source)  # for characters whose properties may differ between Unicode versions
        self.remembered = Remembered(self.piece)
        self.familiar: dict[str, bool] = {}

    def knows(self, text: str) -> bool:
        """Whether all characters have the same properties in all Unicode tables at hand."""
        if text.isascii():
            return True
        known = self.familiar
        for c in set(text):
            if c not in known:
                old = unicodedata.ucd_3_2_0.category(c) != "Cn"
                late = unicodedata.combining(c) or unicodedata.decomposition(c) or 0x11930 <= ord(c) <= 0x11938
                known[c] = old or not (late or unicodedata.category(c) == "Cn")
            if not known[c]:
                return False
        return True

    def symbols(self, data: bytes) -> list[str]:
        return list(map(self.signs.__getitem__, data))

    def closed(self, symbols: list[str]) -> tuple[int, ...]:
        """Ids of symbols that reach to the end of their pre-token."""
        if not symbols:
            return ()
        symbols[-1] += self.end
        return tuple(map(self.ids.__getitem__, self.merges.merge(symbols)))

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of a whole pre-token."""
        if len(text) > LONG:
            word = Word(self)
            return (*word.feed(text), *word.finish())
        return self.closed(self.symbols(text.encode()))

    def cut(self, text: str) -> list[str]:
        """All pre-tokens of a text."""
        fast = self.ascii_pattern and text.isascii()
        return (self.ascii_pattern if fast else self.pattern).findall(text)

    def pieces(self, found: list[str]) -> Iterator[int]:
        return chain.from_iterable(map(self.remembered.__getitem__, found))


class Remembered(dict):
    """Ids by pre-token; a bounded number of short ones is kept."""

    def __init__(self, piece):
        self.piece = piece

    def __missing__(self, text: str) -> tuple[int, ...]:
        found = self.piece(text)
        if len(text) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = found
        return found


class Word:
    """A pre-token of any length, merged as it is read."""

    def __init__(self, codec: Codec):
        self.codec, self.window = codec, []

    def feed(self, text: str) -> list[int]:
        """The tokens that nothing to come can change."""
        merges, out = self.codec.merges, []
        symbols = self.codec.symbols(text.encode())
        for at in range(0, len(symbols), LONG):
            self.window += symbols[at : at + LONG]
            final = len(self.window) - merges.lookahead
            if final <= 0:
                continue
            place = 0
            for token in merges.merge(list(self.window)):
                if place + len(token) >= final:
                    break
                out.append(self.codec.ids[token])
                place += len(token)
            self.window = self.window[place:]
        return out

    def finish(self) -> tuple[int, ...]:
        return self.codec.closed(self.window)


class Encoder:
    """Encodes one text block by block; ``feed`` and ``finish`` return the ids that have become final."""

    def __init__(self, codec: Codec, strange: bool = False):
        self.codec = codec
        self.strange = strange  # the text holds characters newer than the tables
        self.raw = ""  # may begin a special token
        self.loose = ""  # not yet in composed form
        self.held = ""  # the last pre-tokens
        self.word: Word | None = None  # a long pre-token under way
        self.kind = None  # pattern of what continues it

    def feed(self, block: str) -> array:
        out = array("I")
        text = self.raw + block
        place = 0
        for m in self.codec.marker.finditer(text):
            self.run(text[place : m.start()], True, out)
            out.append(self.codec.special[m.group()])
            place = m.end()
        rest = len(text)
        for mark in self.codec.special:  # a tail that may become a special token waits
            fits = (k for k in range(min(len(mark) - 1, len(text) - place), 0, -1) if text.endswith(mark[:k]))
            rest = min(rest, len(text) - next(fits, 0))
        self.run(text[place:rest], False, out)
        self.raw = text[rest:]
        return out

    def finish(self) -> array:
        out = array("I")
        self.run(self.raw, True, out)
        self.raw = ""
        return out

    def run(self, text: str, last: bool, out: array) -> None:
        """Text without special tokens; ``last`` where nothing follows it."""
        text = self.loose + text
        self.loose = ""
        cut = len(text)
        if not last:
            if self.strange:
                cut = max(text.rfind(blank) for blank in " \n\t\r")
            else:
                cut -= 1
                while cut > 0 and not settled(text[cut]):
                    cut -= 1
            cut = max(cut, 0)
            text, self.loose = text[:cut], text[cut:]
        if self.strange:
            self.by_library(text, out)
        else:
            self.split(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower(), last, out)

    def by_library(self, text: str, out: array) -> None:
        """The library's own normaliser and pre-tokenizer on text between blanks; the merges stay ours."""
        library, signs = self.codec.library, self.codec.by_sign
        for piece, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text)):
            out.extend(self.codec.remembered[bytes(signs[s] for s in piece).decode()])

    def split(self, text: str, last: bool, out: array) -> None:
        """Pre-tokens of text in composed form."""
        codec = self.codec
        if self.word:
            went_on = self.kind.match(text).end()
            out.extend(self.word.feed(text[:went_on]))
            if went_on == len(text) and not last:
                return
            out.extend(self.word.finish())
            self.word, text = None, text[went_on:]
        text, self.held = self.held + text, ""
        if last:
            out.extend(codec.pieces(codec.cut(text)))
            return
        found = list(codec.pattern.finditer(text))
        if found and len(found[-1].group()) > LONG and found[-1].end() == len(text):
            *found, open_one = found
            out.extend(codec.pieces([m.group() for m in found]))
            self.word = Word(codec)
            self.kind = LETTERS if LETTERS.match(open_one.group()).end() else SIGNS
            out.extend(self.word.feed(open_one.group()))
            return
        if len(found) > 2:
            self.held = text[found[-2].start() :]
            found = found[:-2]
            out.extend(codec.pieces([m.group() for m in found]))
        else:
            self.held = text


LETTERS = regex.compile(r"\p{L}*")
SIGNS = regex.compile(r"[^\s\p{L}\p{N}]*")


class Decoder:
    """Turns a stream of ids into text: joined tokens, or readable text with ``plain``."""

    def __init__(self, codec: Codec, plain: bool = False):
        self.codec, self.plain = codec, plain
        self.begun = False
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        names = [self.codec.names[i] for i in ids]
        if not names:
            return ""
        if not self.plain:
            text = (" " if self.begun else "") + " ".join(names)
            self.begun = True
            return text
        out = []
        for name in names:
            if name in self.codec.special:
                out.append(self.bytes.decode(b"", True) + name)
                self.bytes.reset()
                continue
            ends = bool(self.codec.end) and name.endswith(self.codec.end)
            signs = name.removesuffix(self.codec.end) if ends else name
            out.append(self.bytes.decode(bytes(self.codec.by_sign[s] for s in signs) + b" " * ends))
        return "".join(out)

    def finish(self) -> str:
        return self.bytes.decode(b"", True) if self.plain else ""


def codec(source: str) -> Codec:
    """The worker's codec of a tokenizer file, loaded once."""
    key = hash(source)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Codec(source)
    return _LOADED[key]


def encode(code: Codec, text: str, block: int = BLOCK) -> array:
    """Ids of a text, fed in blocks."""
    encoder = Encoder(code, strange=not code.knows(text))
    ids = array("I")
    if len(text) <= block and not code.marker.search(text):  # what is read is all there is
        encoder.raw = text
        return encoder.finish()
    for at in range(0, len(text), block):
        ids += encoder.feed(text[at : at + block])
    ids += encoder.finish()
    return ids


def decode(code: Codec, ids: array, plain: bool = False, block: int = BLOCK) -> str:
    """Text of ids, fed in blocks."""
    decoder = Decoder(code, plain)
    parts = [decoder.feed(ids[at : at + block]) for at in range(0, len(ids), block)]
    return "".join(parts) + decoder.finish()


def encoded_texts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", plain: bool = False
) -> DataFrame:
    """Id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` text of every text.

    The tokenizer file is read once on the driver and broadcast: its size does not depend on the data.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batches):
        code = codec(source.value)
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                found = [encode(code, text or "") for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([len(ids) for ids in found], pa.int64()),
                        pa.array([little_endian(ids) for ids in found], pa.binary()),
                        pa.array([decode(code, ids, plain) for ids in found], pa.string()),
                    ],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    shape = f"id {picked.schema['id'].dataType.simpleString()}, n_tokens long, ids binary, decoded string"
    return picked.mapInArrow(run, shape).withColumnRenamed("id", id_col)


def little_endian(ids: array) -> bytes:
    """The ids as little-endian unsigned 32-bit integers."""
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()
