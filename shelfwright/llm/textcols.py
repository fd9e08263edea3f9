"""Arrow text columns as flat byte arrays: rows, words, lines and their exact ids, all in numpy.

The helpers work on one slice of an Arrow batch at a time (``row_slices``), so memory follows the slice
and the longest single text, never the partition. NULL reads as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True  # [\x20\x09-\x0D]

SLICE_BYTES = 4 << 20


def row_slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``size`` bytes of text each, or one row."""
    if not batch.num_rows:
        return
    lengths = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)).astype(np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the n + 1 row bounds in them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z made a-z; all other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross a row bound."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends


def word_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the n + 1 row bounds in words."""
    starts, ends = runs(~SPACE[data], bounds)
    return starts, ends, np.searchsorted(starts, bounds)


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a binary column. Ranges are ascending and do not overlap."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if len(starts):
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts] = 1
        np.add.at(edge, ends, -1) if (lengths == 0).any() else np.subtract.at(edge, ends, 1)
        kept = data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    else:
        kept = data[:0]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))]
    )


def exact_ids(column: pa.Array) -> tuple[np.ndarray, int]:
    """Equal values get equal ids, from 0; and the number of ids."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def owner(bounds: np.ndarray) -> np.ndarray:
    """The row of each element, from row bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values by row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
