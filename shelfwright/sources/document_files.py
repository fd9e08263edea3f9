"""A source and a sink for folders of very many small documents.

A file per task would drown the scheduler, a file per split the planner, and the names of all files the driver. So names are
rows: a task reads those of a folder as they come, all tasks ask for sizes (``listing``), and the files are dealt so that all tasks read about as
much (``dealt``): the largest first, each to the task that has the least, where opening a file counts as ``OPEN_COST`` bytes. The
driver knows the number of files and their bytes. A task reads its files one by one. A file that cannot be read becomes a row with its
``problem`` and no content.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from shelfwright.session import durable, spread
from shelfwright.sources import files

FORMAT = "document_files"
RAW = "collection string, slug string, path string, content binary, problem string"
LISTING = "collection string, name string, size long, changed long"
ENDINGS = (".yaml", ".yml")
OPEN_COST = 64 << 10
TASK_BYTES = 64 << 20
BATCH_BYTES = 4 << 20


@dataclass
class Share(InputPartition):
    """The files of one task: collection and name."""

    names: list[tuple[str, str]]


def balanced(sizes: list[int], task_bytes: int = TASK_BYTES, least_tasks: int = 1) -> list[list[int]]:
    """Places of ``sizes`` in groups of about equal weight: as many as the bytes ask for, or at least ``least_tasks`` as
    long as there is a file for each."""
    count = _tasks(len(sizes), sum(sizes), task_bytes, least_tasks)
    groups: list[list[int]] = [[] for _ in range(count)]
    for i, g in _each_to_the_lightest(sizes, [(0, g) for g in range(count)]):
        groups[g].append(i)
    return groups


def _tasks(files_: int, size: int, task_bytes: int, least_tasks: int) -> int:
    return min(files_, max(least_tasks, -(-(size + files_ * OPEN_COST) // task_bytes)))


def _each_to_the_lightest(sizes: list[int], loads: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Places of ``sizes``, the largest first, each with the group that takes it. ``loads``, a heap of weights and groups, goes on."""
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        weight, g = loads[0]
        heapq.heapreplace(loads, (weight + sizes[i] + OPEN_COST, g))
        yield i, g


class DocumentReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.collections = options["collections"].split(",")
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))
        self.least_tasks = int(options.get("leastTasks", 1))

    def partitions(self) -> list[Share]:
        names, sizes = [], []
        for collection in self.collections:
            for found in files.listed(f"{self.root}/{collection}"):
                if found.base_name.endswith(ENDINGS) and not found.base_name.startswith((".", "_")):
                    names.append((collection, found.base_name))
                    sizes.append(found.size)
        shares = balanced(sizes, self.task_bytes, self.least_tasks)
        return [Share(sorted(names[i] for i in share)) for share in shares] or [Share([])]

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for collection, name in share.names:
            content, problem = None, None
            try:
                content = files.read_file(f"{self.root}/{collection}/{name}")
            except OSError as error:
                problem = " ".join(str(error).split()) or type(error).__name__
            rows.append((collection, name.rpartition(".")[0], f"{collection}/{name}", content, problem))
            held += len(content or b"")
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
    names = ["collection", "slug", "path", "content", "problem"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


class DocumentFiles(DataSource):
    """``spark.read.format("document_files").option("collections", "a,b").load(root)``, once registered: for folders whose
    names the driver can hold. ``read_files`` takes folders of any size."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> DocumentReader:
        return DocumentReader(self.options)


def read_files(spark: SparkSession, root: str, collections: list[str], task_bytes: int = TASK_BYTES) -> DataFrame:
    """``(collection, slug, path, content, problem)`` of every document; a collection without a folder has none.

    The folders are listed now, and the files read by whatever runs over them."""
    listed = durable(listing(spark, root, collections))
    return read_named(dealt(listed, task_bytes, spark.sparkContext.defaultParallelism), root)


def listing(spark: SparkSession, root: str, collections: list[str]) -> DataFrame:
    """``(collection, name, size, changed)`` of every document, without its content; ``changed`` is in nanoseconds.

    A task for each folder reads its names, and all tasks ask for what the names do not tell. A folder that the driver sees and
    a task does not is an error; a file that is gone by then is left to the reading, which notes its problem."""
    folders = [c for c in collections if files.is_folder(f"{root}/{c}")]

    def names(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                for part in files.listed_in_parts(f"{root}/{folders[i]}"):
                    yield _listed((folders[i], *f) for f in part if f[0].endswith(ENDINGS) and not f[0].startswith((".", "_")))

    def known(batches):
        for batch in batches:
            rows = [tuple(r.values()) for r in batch.to_pylist()]
            yield _listed(r if r[2] is not None else (*r[:2], *(files.stat(f"{root}/{r[0]}/{r[1]}") or (0, 0))) for r in rows)

    named = spark.range(0, len(folders), 1, max(1, len(folders))).mapInArrow(names, LISTING)
    return spread(named, "collection", "name").mapInArrow(known, LISTING)


def _listed(rows: Iterable[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["collection", "name", "size", "changed"])


def dealt(listed: DataFrame, task_bytes: int = TASK_BYTES, least_tasks: int = 1) -> DataFrame:
    """The rows of a listing in as many partitions as ``balanced`` makes groups, of about equal weight.

    Each task deals its own rows to all partitions and holds a weight for each of these; tasks begin with different ones."""
    files_, size = listed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    count = max(1, _tasks(files_, size, task_bytes, least_tasks))

    def run(batches):
        first = TaskContext.get().partitionId()
        loads = [(turn, (first + turn) % count) for turn in range(count)]  # a byte apart, so that they are taken in this order
        for batch in batches:
            groups = dict(_each_to_the_lightest(batch.column("size").to_pylist(), loads))
            yield batch.append_column("part", pa.array([groups[i] for i in range(batch.num_rows)], pa.int32()))

    return listed.mapInArrow(run, f"{LISTING}, part int").repartitionById(count, "part").drop("part")


def read_named(names: DataFrame, root: str) -> DataFrame:
    """``RAW`` rows of the documents named by ``(collection, name)``."""
    reader = DocumentReader({"path": root, "collections": ""})

    def run(batches):
        for batch in batches:
            yield from reader.read(Share([(r["collection"], r["name"]) for r in batch.to_pylist()]))

    return names.select("collection", "name").mapInArrow(run, RAW)


def write_files(docs: DataFrame, root: str) -> int:
    """Write ``(collection, slug, content)`` as one file per row, from all tasks; the number of files.

    Rows are dealt anew, as a table in one file would have one task write them all. A task that is run again writes the same files again, each under another name first.
    """
    picked = docs.select(F.col("collection").cast("string"), F.col("slug").cast("string"), F.col("content").cast("binary"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if not row["slug"] or "/" in row["slug"] or row["slug"].startswith((".", "_")):
                    raise ValueError(f"not a file name: {row['slug']!r}")
                files.write_file(f"{root}/{row['collection']}/{row['slug']}{ENDINGS[0]}", row["content"] or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    written = spread(picked, "collection", "slug").mapInArrow(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
