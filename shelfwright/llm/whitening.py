"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Vectors are read as whole numbers ``x = floor(256 c)``. The fit list holds each distinct ``x`` once, so a vector that
fills a third of the table counts once. Spark finds the distinct vectors (packed to bytes, combined before the shuffle), adds
up their number and sums, and then the scatter of ``x - S / n``, a triangle per task. The driver holds numbers by dimension
only: the scatter ``M``, its factor ``L`` with ``M = L L'``, and the rotated columns of ``L``. Those are orthogonal, so their
squared norms are the eigenvalues of ``M = n V`` and their directions the components. The rows are then projected where they lie.

Defined cases: a vector that is NULL, or holds a NULL, a NaN or an infinity, is dropped. A shorter vector reads as if zeros
followed. Numbers beyond 64 bits stop at their limits, as Spark's cast to long does. Copies of a row stay, each with its own
results; a NULL id stays. There are as many components as the scatter has directions, at most ``k``: an empty table, one
distinct vector, or vectors without entries give no rows. A deviation beyond 64 bits is NULL. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwright.session import durable

SCALE = 256
COMPONENTS = 4
ROWS = 4096  # vectors that a task holds as numbers at a time
SWEEPS = 60
LEAST, MOST = -(1 << 63), (1 << 63) - 1


@dataclass
class Whitening:
    """What was fitted: size and sums of the fit list, components (rows) with their eigenvalues, and the trace of V."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """The whitened coordinates of whole-number vectors, a row each."""
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([float(Decimal(s) / self.n) for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over the dimensions of ``(n x - S)^2``, exact."""
        largest = self.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, self.sums)) if x.size else 0
        if largest * largest * max(1, x.shape[1]) <= MOST:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        found = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d <= MOST else None for d in found]


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows remain; and their numbers, flat, with the n + 1 row bounds in them."""
    column = column.cast(pa.large_list(pa.float64()))
    remains = pc.is_valid(column).to_numpy(zero_copy_only=False).copy()
    lengths = np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
    numbers = column.flatten().to_numpy(zero_copy_only=False)  # NULL reads as NaN
    at = np.repeat(np.arange(len(column)), lengths)
    remains[at[~np.isfinite(numbers)]] = False
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * numbers[remains[at]])
    whole = np.where(np.abs(scaled) < 2.0**63, scaled, 0).astype(np.int64)
    whole[scaled >= 2.0**63] = MOST
    whole[scaled <= -(2.0**63)] = LEAST
    return remains, whole, np.concatenate([[0], np.cumsum(lengths[remains])])


def pack(numbers: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """One byte string a vector, equal for equal vectors: the width of its numbers, then these without trailing zeros."""
    out = []
    for start, stop in zip(bounds[:-1], bounds[1:]):
        row = numbers[start:stop]
        low, high = (int(row.min()), int(row.max())) if len(row) else (0, 0)
        width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
        out.append(bytes([width]) + row.astype(f"<i{width}").tobytes().rstrip(b"\0"))
    return out


def unpack(packed: list[bytes], d: int) -> np.ndarray:
    """The vectors of ``d`` numbers, a row each."""
    x = np.zeros((len(packed), d), np.int64)
    for width in (2, 4, 8):
        rows = [i for i, p in enumerate(packed) if p[0] == width]
        if rows:
            data = b"".join(packed[i][1:].ljust(d * width, b"\0") for i in rows)
            x[rows] = np.frombuffer(data, f"<i{width}").reshape(len(rows), d)
    return x


def entries(packed: bytes) -> int:
    """How many numbers a packed vector holds."""
    return -(-(len(packed) - 1) // packed[0])


def blocks(batches, column: int = 0) -> Iterator[list[bytes]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.column(column).slice(at, ROWS).to_pylist()


def fit_list(df: DataFrame, vector_col: str) -> DataFrame:
    """Each distinct vector once, packed, in the shared folder."""
    picked = df.select(df[vector_col].cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                _, numbers, bounds = whole_numbers(batch.column(0).slice(at, ROWS))
                yield pa.RecordBatch.from_arrays([pa.array(pack(numbers, bounds), pa.binary())], ["x"])

    return durable(picked.mapInArrow(run, "x binary").distinct())


def count_and_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of packed vectors, and their sum by dimension."""

    def run(batches):
        n, sums = 0, []
        for packed in blocks(batches):
            d = max(map(entries, packed), default=0)
            sums += [0] * (d - len(sums))
            x = unpack(packed, d)
            if x.size and max(abs(int(x.min())), abs(int(x.max()))) > MOST // ROWS:
                x = x.astype(object)
            for i, s in enumerate(x.sum(axis=0).tolist()):
                sums[i] += s
            n += len(packed)
        rows = [n, *sums]
        shape = pa.array(range(-1, len(sums)), pa.int32()), pa.array(map(Decimal, rows), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(list(shape), ["place", "total"])

    totals = vectors.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    found = {r["place"]: int(r["total"]) for r in totals.collect()}  # a row a dimension
    return found.get(-1, 0), [found[i] for i in range(len(found) - 1)]


def summed(vectors: DataFrame, d: int, size: int, add) -> np.ndarray:
    """The sum of ``add(x)``, a flat array of ``size``, over all blocks of vectors: added up in tasks, then by cell."""

    def run(batches):
        total = np.zeros(size)
        for packed in blocks(batches):
            total += add(unpack(packed, d))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["cell", "total"])

    cells = vectors.mapInArrow(run, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    out = np.zeros(size)
    for r in cells.collect():  # a row a cell of the triangle
        out[r["cell"]] = r["total"]
    return out


def pivoted_cholesky(m: np.ndarray) -> np.ndarray:
    """``L`` with ``L L' = m``, a column per pivot, largest first; triangular but for the order of its rows."""
    d = len(m)
    factor, left = np.zeros((d, d)), m.diagonal().copy()
    order: list[int] = []
    least = d * np.finfo(float).eps * left.max(initial=0)
    while len(order) < d:
        p = int(np.argmax(left))
        if left[p] <= least:
            break
        k = len(order)
        column = (m[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(left[p])
        column[order] = 0
        factor[:, k] = column
        left -= column**2
        order.append(p)
        left[order] = -np.inf
    return factor[:, : len(order)]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns rotated in pairs until all are orthogonal; each round turns disjoint pairs at once."""
    columns = factor.T.copy()
    r = len(columns)
    ring = list(range(r + r % 2))  # an odd one out rests against the place beyond the last
    for _ in range(SWEEPS):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = np.array([(a, b) for a, b in zip(ring[:half], ring[: half - 1 : -1]) if a < r and b < r], np.int64).reshape(-1, 2)
            ring[1:] = ring[-1:] + ring[1:-1]
            p, q = columns[pairs[:, 0]], columns[pairs[:, 1]]
            a, b, g = (p * p).sum(axis=1), (q * q).sum(axis=1), (p * q).sum(axis=1)
            live = np.abs(g) > np.finfo(float).eps * np.sqrt(a * b)
            if not live.any():
                continue
            turned = True
            pairs, p, q, a, b, g = (v[live] for v in (pairs, p, q, a, b, g))
            zeta = (b - a) / (2 * g)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            columns[pairs[:, 0]] = c[:, None] * p - s[:, None] * q
            columns[pairs[:, 1]] = s[:, None] * p + c[:, None] * q
        if not turned:
            break
    return columns.T


def fit_whitening(df: DataFrame, vector_col: str = "embedding", k: int = COMPONENTS) -> Whitening:
    """The first ``k`` components of the distinct vectors' covariance, and how white their projections are."""
    vectors = fit_list(df, vector_col)
    n, sums = count_and_sums(vectors)
    d = len(sums)
    model = Whitening(n, sums, np.zeros((0, d)), np.zeros(0), 0.0)
    if not (n and d):
        return model
    upper = np.triu_indices(d)

    def scatter(x):
        c = model.centred(x)
        return (c.T @ c)[upper]

    m = np.zeros((d, d))
    m[upper] = summed(vectors, d, len(upper[0]), scatter)
    m += np.triu(m, 1).T
    columns = one_sided_jacobi(pivoted_cholesky(m))
    squares = (columns**2).sum(axis=0)
    first = np.argsort(-squares, kind="stable")[:k]
    model.trace = float(m.trace()) / n
    model.eigenvalues = squares[first] / n
    model.components = (columns[:, first] / np.sqrt(squares[first])).T
    r = len(first)

    def moments(x):
        w = model.project(x)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    if r:
        found = summed(vectors, d, r + r * r, moments) / n
        covariance = found[r:].reshape(r, r) - np.outer(found[:r], found[:r])
        model.identity_error = float(np.abs(covariance - np.eye(r)).max())
    return model


def whitened(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each remaining row and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``."""
    picked = df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("v"))
    d, r = len(model.sums), len(model.eigenvalues)
    explained = model.eigenvalues / model.trace if r else model.eigenvalues

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows if r else 0, ROWS):
                part = batch.slice(at, ROWS)
                remains, numbers, bounds = whole_numbers(part.column("v"))
                x = unpack(pack(numbers, bounds), d)
                n = len(x)
                ids = part.column("id").filter(pa.array(remains)).take(pa.array(np.repeat(np.arange(n), r)))
                deviation = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), r)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * r, model.n, np.int64)),
                        deviation,
                        pa.array(model.project(x).ravel()),
                        pa.array(np.tile(explained, n)),
                        pa.array(np.full(n * r, model.identity_error)),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    shape = f"id {picked.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return picked.mapInArrow(run, shape).withColumnRenamed("id", id_col)
