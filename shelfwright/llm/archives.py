"""WARC archives and their capture index.

**Writing.** Pages with equal payloads of at least ``MIN_REVISIT`` bytes are found by digest; the one with the
smallest id is a ``response``, the others are ``revisit`` records that refer to it. Each task appends records
(one gzip member each) to archive files of bounded size in the shared folder, and returns one index run per
file, sorted by URL key, time and id. The runs are made durable at once. File names are new for each attempt and
only the runs of finished tasks are kept, so a repeated task leaves at most an unused file.

**Index merge.** The runs are dealt out by ranges of (URL key, time, id), so that one hot URL spreads over many
ranges; each range merges its parts of the runs with a loser tree. Ranges are sized by rows, and hold index
rows only, never payloads. The ranges in order are the capture history of all URLs.

**Reading** follows the index: records are fetched by file and offset, parsed, and their digests checked.

Defined cases: a NULL payload is an empty one and a response; a NULL URL has the key ''; pages that repeat an id
and a payload are responses alike if the id is the smallest; a NULL id never is the smallest; captures with equal
keys, times and ids keep the order of their files; no pages, no archives.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm import textcols
from shelfwright.llm.files import file_system, new_folder, write_file
from shelfwright.session import durable

MIN_REVISIT = 100
FILE_BYTES = 32 << 20  # payload bytes of an archive file
RANGE_ROWS = 100_000  # index rows that one merge holds

INDEX = "url_key string, time long, page string, run string, seq long, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """The host's labels in reverse, then the rest: ``https://a.b.com/x?y`` gives ``com,b,a)/x?y``."""
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)([^#]*)"
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, parts, 1)), r"\.")), ",")
    return F.coalesce(F.when(F.regexp_like(url, F.lit(parts)), F.concat(host, F.lit(")"), F.regexp_extract(url, parts, 2))).otherwise(url), F.lit(""))


def with_first(pages: DataFrame) -> DataFrame:
    """``pages`` (page, payload, ...) with ``digest``, and ``first``: the page whose payload this one repeats."""
    pages = pages.withColumn("digest", F.sha2("payload", 256))
    again = (
        pages.filter(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("page").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
    )
    joined = pages.join(again, F.col("digest") == F.col("_digest"), "left")
    return joined.withColumn("first", F.when(~F.col("page").eqNullSafe(F.col("_first")), F.col("_first"))).drop(
        "_digest", "_first", "_n"
    )


def named(page: object) -> str:
    return f"<urn:x-page:{'' if page is None else page}>"


def record(url: str, page: object, time: int, payload: bytes, digest: str, first: object) -> bytes:
    """One WARC record. ``time`` is in seconds."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if first is None else http
    date = str(pa.scalar(time, pa.timestamp("s"))).replace(" ", "T") + "Z"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {named(page)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url:
        lines.append(f"WARC-Target-URI: {''.join(c for c in url if c >= ' ')}")
    if first is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {named(first)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    headers = {p[0]: p[1] for p in pairs if len(p) == 2}
    return headers, rest[: int(headers["Content-Length"])]


def described(data: bytes) -> tuple:
    """(page, payload bytes, digest, type, page referred to) of a record; its digest is checked."""
    headers, block = parse(data)
    kind, digest, size = headers["WARC-Type"], headers["WARC-Payload-Digest"].split(":", 1)[1], int(headers["X-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")

    def page(name):
        return headers[name].removeprefix("<urn:x-page:").removesuffix(">") or None if name in headers else None

    return page("WARC-Record-ID"), size, digest, kind, page("WARC-Refers-To")


def write_archives(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, time: Column, folder: str | None = None
) -> DataFrame:
    """Write a record per page; the durable index runs, in the columns of ``INDEX``."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    rows = with_first(
        pages.select(
            F.col(id_col).alias("page"),
            F.coalesce(F.col(url_col), F.lit("")).alias("url"),
            url_key(F.col(url_col)).alias("url_key"),
            F.coalesce(time.cast("long"), F.lit(0)).alias("time"),
            F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"),
        )
    ).select("page", "url", "url_key", "time", "payload", "digest", "first")

    def run(batches):
        parts, entries, size, held = [], [], 0, 0

        def flush():
            nonlocal parts, entries, size, held
            name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            write_file(name, b"".join(parts))
            entries.sort(key=order)
            table = [[*e[:2], e[2] if e[2] is None else str(e[2]), name, i, name, *e[3:]] for i, e in enumerate(entries)]
            parts, entries, size, held = [], [], 0, 0
            names = [c.split()[0] for c in INDEX.split(", ")]
            types = [pa.int64() if c.endswith("long") else pa.string() for c in INDEX.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table), types)], names)

        for batch in batches:
            for part in textcols.row_slices(batch, "payload"):
                for r in part.to_pylist():
                    data = gzip.compress(record(r["url"], r["page"], r["time"], r["payload"], r["digest"], r["first"]), 6, mtime=0)
                    entries.append((r["url_key"], r["time"], r["page"], size, len(data)))
                    parts.append(data)
                    size += len(data)
                    held += len(r["payload"])
                    if held >= FILE_BYTES:
                        yield flush()
        if entries:
            yield flush()

    return durable(rows.mapInArrow(run, INDEX))


def order(entry: tuple) -> tuple:
    """Sort key of (url_key, time, page, ...): a missing id last, ids by value."""
    return entry[0].encode(), entry[1], entry[2] is None, entry[2] if entry[2] is not None else 0


class LoserTree:
    """Merges sorted runs; each inner node keeps the loser of its match, the winner goes up.

    Taking the smallest costs one match per level, against the losers on the way from its leaf.
    """

    END = ((1,),)  # above all keys, which are wrapped as ((0, ...),)

    def __init__(self, runs: list[Iterable], key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.size = max(1, len(runs))
        self.items = [None] * self.size
        self.keys = [self.END] * self.size
        for i in range(len(runs)):
            self.advance(i)
        self.losers = [0] * self.size
        self.winner = self.play(1) if self.size > 1 else 0

    def advance(self, i: int) -> None:
        self.items[i] = item = next(self.runs[i], None)
        self.keys[i] = self.END if item is None else ((0, self.key(item), i),)

    def play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self.play(2 * node), self.play(2 * node + 1)
        first, self.losers[node] = (a, b) if self.keys[a] < self.keys[b] else (b, a)
        return first

    def __iter__(self) -> Iterator:
        while self.runs and self.keys[self.winner] != self.END:
            i = self.winner
            yield self.items[i]
            self.advance(i)
            node = (i + self.size) // 2
            while node:
                if self.keys[self.losers[node]] < self.keys[i]:
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.winner = i


def merge_runs(runs: DataFrame, id_type: str = "long") -> DataFrame:
    """All runs as one capture history: partitions are ascending ranges, each in order of (url_key, time, id)."""
    n = max(runs.sparkSession.sparkContext.defaultParallelism, runs.count() // RANGE_ROWS + 1)
    page = F.col("page").cast(id_type)
    dealt = (
        runs.withColumn("_page", page)
        .repartitionByRange(n, F.col("url_key"), F.col("time"), F.col("_page").asc_nulls_last(), F.col("run"))
        .sortWithinPartitions("run", "seq")
    )
    names = dealt.columns

    def merge(batches):
        parts: dict[str, list] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                parts.setdefault(row[3], []).append(row)
        if schema is None:
            return
        block = []
        for row in LoserTree([parts[k] for k in sorted(parts)], lambda r: order((r[0], r[1], r[-1]))):
            block.append(row)
            if len(block) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)
                block = []
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block), schema)], schema=schema)

    return dealt.mapInArrow(merge, dealt.schema).select(*[c for c in names if c != "_page"])


def read_captures(index: DataFrame, id_type: str = "long") -> DataFrame:
    """Read the archives by an index: one row per capture, in its order, as found in the record itself."""
    shape = (
        "page string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
        "url_key string, time long, file string, offset long"
    )

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                files, offsets, lengths = (part.column(c).to_pylist() for c in ("file", "offset", "length"))
                found: list = [None] * part.num_rows
                opened, handle = None, None
                for i in sorted(range(part.num_rows), key=lambda i: (files[i], offsets[i])):
                    if files[i] != opened:
                        if handle:
                            handle.close()
                        system, path = file_system(files[i])
                        opened, handle = files[i], system.open_input_file(path)
                    found[i] = described(gzip.decompress(handle.read_at(lengths[i], offsets[i])))
                if handle:
                    handle.close()
                types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                columns += [part.column(c) for c in ("url_key", "time", "file", "offset")]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in shape.split(", ")])

    read = index.mapInArrow(run, shape)
    for c in ("page", "refers_to"):
        read = read.withColumn(c, F.col(c).cast(id_type))
    return read


def capture_history(pages: DataFrame, id_col: str, url_col: str, payload_col: str, time: Column, folder: str | None = None) -> DataFrame:
    """Write the pages to archives, merge the index runs, and read the records back in history order."""
    id_type = pages.schema[id_col].dataType.simpleString()
    runs = write_archives(pages, id_col, url_col, payload_col, time, folder)
    return read_captures(merge_runs(runs, id_type), id_type)
