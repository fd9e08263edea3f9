"""Exact token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

**Splicing.** A huge text is encoded chunk by chunk, each with offsets and overlapping the one before.
Two chunks are joined at a pre-token start ``p`` that both report, far enough from the cut edges
(``EDGE``, the longest look-ahead or special string). Such a point is proven: pre-tokens are found left
to right without looking back, so what follows ``p`` depends on the text from ``p`` on only; the left
chunk is true up to ``p`` because it is true from its own splice point on, and the right one is true after
``p`` because it starts anew there. Where the chunks have no such point in common, the overlap is
doubled, at last back to the splice point before, which is itself a proven start.

Texts up to a chunk are encoded whole, in batches. A tokenizer of another kind (normaliser, prefix space,
other pre-tokenizer, stripping special tokens) is never spliced: it encodes every text whole.

Defined cases: NULL and empty texts have 0 bytes and 0 tokens; repeated rows give repeated results;
other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwright.llm import textcols

CHUNK = 32768  # code points of a chunk, and the length above which a text is spliced
OVERLAP = 512
LIMIT = 512
EDGE = 16  # code points at a cut edge whose pre-tokens are not yet proven

_LOADED: dict[int, "Counter"] = {}


def starts_of(encoding) -> dict[int, int]:
    """Token index by offset, of each token that opens a pre-token."""
    words, offsets = encoding.word_ids, encoding.offsets
    return {
        offsets[i][0]: i for i in range(len(words)) if i == 0 or words[i] is None or words[i] != words[i - 1]
    }


def spliced(encode, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[list[int], int, int]:
    """Token ids of a text, the chunks that were encoded, and how often an overlap was widened."""
    n = len(text)
    left_from, left_to = 0, min(n, chunk)
    left = encode(text[:left_to])
    chunks, widened, ids, kept = 1, 0, [], 0
    proven = 0  # left is true from this place, which is its token number ``kept``
    while left_to < n:
        marks = starts_of(left)
        width = overlap
        while True:
            right_from = max(proven, left_to - width)
            right_to = min(n, max(right_from + chunk, left_to + width))
            right = encode(text[right_from:right_to])
            chunks += 1
            if right_from == proven:  # nothing of left is needed
                kept = 0
                break
            other = starts_of(right)
            common = [
                p
                for p in other
                if p >= EDGE and p + right_from <= left_to - EDGE and p + right_from - left_from in marks
            ]
            if common:
                at = max(common)
                proven = at + right_from
                ids += left.ids[kept : marks[proven - left_from]]
                kept = other[at]
                break
            width *= 2
            widened += 1
        left, left_from, left_to = right, right_from, right_to
    ids += left.ids[kept:]
    return ids, chunks, widened


class Counter:
    """Counts tokens with one tokenizer; lives as long as its worker."""

    def __init__(self, source: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        spec = json.loads(source)
        before = spec.get("pre_tokenizer") or {}
        self.divisible = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and all(
                not (t["lstrip"] or t["rstrip"] or t["single_word"])
                and not any(c.isspace() for c in t["content"])
                and len(t["content"]) < EDGE
                for t in spec.get("added_tokens", [])
            )
        )

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def whole(self, text: str) -> tuple[list[int], int, int]:
        if self.divisible and len(text) > self.chunk:
            return spliced(self.encode, text, self.chunk, self.overlap)
        return self.encode(text).ids, 1, 0

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, chunks and widened overlaps of each text."""
        texts = column.to_pylist()
        tokens, chunks, widened = (np.full(len(texts), k, np.int64) for k in (0, 1, 0))
        huge = np.array([self.divisible and len(t or "") > self.chunk for t in texts], bool)
        short = np.flatnonzero(~huge)
        found = self.tokenizer.encode_batch_fast([texts[i] or "" for i in short], add_special_tokens=False)
        tokens[short] = [len(e) for e in found]
        for i in np.flatnonzero(huge):
            ids, chunks[i], widened[i] = self.whole(texts[i])
            tokens[i] = len(ids)
        return tokens, chunks, widened


def counter(source: str, chunk: int, overlap: int) -> Counter:
    """The worker's counter for a tokenizer, loaded once."""
    key = hash((source, chunk, overlap))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Counter(source, chunk, overlap)
    return _LOADED[key]


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Id, UTF-8 bytes, tokens, encoded chunks and widened overlaps of every text.

    The tokenizer file is read once on the driver and broadcast: its size does not depend on the data.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batches):
        count = counter(source.value, chunk, overlap)
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                tokens, chunks, widened = count.counts(part.column("text"))
                n_bytes = np.diff(textcols.flat(part.column("text"))[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, (n_bytes, tokens, chunks, widened))],
                    ["id", "n_bytes", "n_tokens", "n_chunks", "n_widened"],
                )

    shape = f"id {picked.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, n_chunks long, n_widened long"
    return picked.mapInArrow(run, shape).withColumnRenamed("id", id_col)


def token_ids(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Id and token ids of every text, huge ones spliced."""
    with open(tokenizer_path, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    picked = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))

    def run(batches):
        count = counter(source.value, chunk, overlap)
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                ids = [count.whole(t or "")[0] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)
