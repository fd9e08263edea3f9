"""Mixing sources to target weights, in blocks of a fixed number of words.

1. **Pack.** The texts of a source, in id order, are one stream of words, cut into blocks of ``block`` words.
   Stream positions are running sums within ranges of (source, id), plus the sums of the ranges before, so
   a hot source is spread over many ranges.
2. **Draw.** The mix has as many slots as its targets need, in output shards of ``shard`` slots. Each shard
   draws its source counts from a multinomial over the targets, seeded by (seed, shard). What a source is drawn
   beyond its quota goes to the sources drawn below theirs, so that the totals are exact.
3. **Map.** The slots of a source are numbered over the shards; pass ``j // blocks`` uses a pseudorandom
   permutation of the source's block numbers seeded by (seed, source, pass), so a pass takes each block once.
4. **Join** slots and blocks by (source, block number).

Targets: sources by code point, NULL last, weigh ``weights`` in turn and share ``total`` times all words;
no target exceeds ``most`` times its source, and what is cut is shared again by weight. No block, hence no
text, is taken more than ``most`` times.

Defined cases: NULL and blank texts have size 0 and are never taken; a NULL source is one source; rows that repeat
an id are packed one after the other; other columns are ignored; an empty table, or one without words, gives
an empty mix. The driver holds one row per source (sources are few), nothing per document, block or slot.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwright.session import durable

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
TOTAL = 1.5
MOST = 2
BLOCK = 64
SHARD = 1024
SUPER = 1000  # shards whose counts are summed before the running sum over all
SEED = 17


def targets(sizes: list[int], weights: tuple = WEIGHTS, total: float = TOTAL, most: float = MOST) -> list[float]:
    """Target words of each source, in order; the excess over ``most`` times a size is shared again by weight."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    left, open_ = total * sum(sizes), set(range(len(sizes)))
    found = [0.0] * len(sizes)
    while open_:
        unit = left / sum(weight[i] for i in open_)
        full = {i for i in open_ if weight[i] * unit >= most * sizes[i]}
        if not full:
            for i in open_:
                found[i] = weight[i] * unit
            break
        for i in full:
            found[i] = float(most * sizes[i])
            left -= found[i]
        open_ -= full
    return found


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, hash of the text) of each document."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col(text_col)).alias("hash"),
    )


def packed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size, hash, start): the place of each document in its source's stream. Durable."""
    sizes = sized(docs, id_col, text_col, source_col)
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["source", "id", "size", "hash"]
    dealt = sizes.repartitionByRange(n, *order).sortWithinPartitions(*order)
    id_type = dealt.schema["id"].dataType.simpleString()

    def run(batches):
        source, total, first = None, 0, True
        for batch in batches:
            here = batch.column("source").to_pylist()
            size = batch.column("size").to_pylist()
            start = []
            for s, k in zip(here, size):
                if first or s != source:
                    source, total, first = s, 0, False
                start.append(total)
                total += k
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "source", "size", "hash", "part")), pa.array(start, pa.int64())],
                ["id", "source", "size", "hash", "part", "start"],
            )

    local = durable(
        dealt.withColumn("part", F.spark_partition_id()).mapInArrow(
            run, f"id {id_type}, source string, size long, hash long, part int, start long"
        )
    )
    # one row per range and source: as many as ranges and sources together
    before = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sums = local.groupBy(F.col("part").alias("p"), F.col("source").alias("s")).agg(F.sum("size").alias("words"))
    sums = sums.select("p", "s", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"))
    return local.join(sums, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "id", "source", "size", "hash", (F.col("start") + F.col("ahead")).alias("start")
    )


def source_table(sizes: DataFrame, block: int = BLOCK, weights: tuple = WEIGHTS, total: float = TOTAL, most: float = MOST) -> list[dict]:
    """Per source, by code point with NULL last: source, words, target, blocks and slots of the mix."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("words")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    goals = targets([r["words"] for r in rows], weights, total, most)
    table = []
    for r, goal in zip(rows, goals):
        blocks = math.ceil(r["words"] / block)
        # a slot brings as many words as the source's blocks have on average
        slots = min(int(most * blocks), round(goal * blocks / r["words"])) if r["words"] else 0
        table.append({"source": r["source"], "words": r["words"], "target": goal, "blocks": blocks, "slots": slots})
    return table


def drawn(spark: SparkSession, quotas: list[int], shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, of, first, n): the slots ``first ..`` of source number ``of`` that a shard takes.

    Multinomial draws per shard, then exact quotas: the last slots of an overdrawn source pass, in order, to the
    underdrawn ones.
    """
    total = sum(quotas)
    if not total:
        return spark.createDataFrame([], "shard long, of int, first long, n long")
    shards = math.ceil(total / shard)
    shares = np.array(quotas, float) / max(total, 1)

    def draw(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            counts = np.array(
                [
                    np.random.default_rng([seed, int(i)]).multinomial(min(shard, total - int(i) * shard), shares)
                    for i in ids
                ]
            ).reshape(len(ids), len(quotas))
            at, of = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(of.astype(np.int32)), pa.array(counts[at, of].astype(np.int64))],
                ["shard", "of", "n"],
            )

    rows = durable(spark.range(shards).mapInArrow(draw, "shard long, of int, n long"))
    rows = rows.withColumn("super", F.floor(F.col("shard") / SUPER))
    inner = Window.partitionBy("of", "super").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("o").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy(F.col("of").alias("o"), F.col("super").alias("u")).agg(F.sum("n").alias("m"))
    ahead = ahead.select("o", "u", F.coalesce(F.sum("m").over(outer), F.lit(0)).alias("ahead"))
    placed = rows.join(ahead, (F.col("of") == F.col("o")) & (F.col("super") == F.col("u"))).select(
        "shard", "of", "n", (F.coalesce(F.sum("n").over(inner), F.lit(0)) + F.col("ahead")).alias("first")
    )
    quota = F.array(*[F.lit(int(q)).cast("long") for q in quotas])
    limit = F.get(quota, F.col("of"))
    within = F.greatest(F.lit(0), F.least(F.col("n"), limit - F.col("first")))
    placed = durable(placed.select("shard", "of", "first", within.alias("n"), (F.col("n") - within).alias("over")))

    got = {r["of"]: r["m"] for r in placed.groupBy("of").agg(F.sum(F.col("n")).alias("m")).collect()}
    lacks = [(i, got.get(i, 0), q - got.get(i, 0)) for i, q in enumerate(quotas) if q > got.get(i, 0)]
    kept = placed.filter("n > 0").select("shard", "of", "first", "n")
    if not lacks:
        return kept
    # slots passed on: about the square root of all slots, in the last shards of the overdrawn sources
    single = placed.filter("over > 0").select("shard", "of", F.explode(F.sequence(F.lit(1), F.col("over"))).alias("k"))
    rank = F.row_number().over(Window.orderBy("of", "shard", "k")) - 1
    ends = np.cumsum([k for _, _, k in lacks]).tolist()
    steps = F.array(
        *[
            F.struct(F.lit(e - k).cast("long").alias("lo"), F.lit(e).cast("long").alias("hi"), F.lit(i).alias("of"), F.lit(g).cast("long").alias("base"))
            for e, (i, g, k) in zip(ends, lacks)
        ]
    )
    passed = single.withColumn("r", rank).withColumn(
        "to", F.get(F.filter(steps, lambda s: (F.col("r") >= s["lo"]) & (F.col("r") < s["hi"])), F.lit(0))
    )
    passed = passed.select(
        "shard", F.col("to.of").alias("of"), (F.col("to.base") + F.col("r") - F.col("to.lo")).alias("first"), F.lit(1).cast("long").alias("n")
    )
    return kept.unionByName(passed)


def permuted(index: np.ndarray, size: int, key: bytes) -> np.ndarray:
    """Images of ``index`` under a pseudorandom permutation of 0 .. size - 1.

    A four-round Feistel network over the least even number of bits; images beyond ``size`` are mapped
    again until they fall below it (cycle walking).
    """
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.sha256(key).digest(), np.uint64)

    def once(x):
        left, right = x >> np.uint64(half), x & mask
        for k in keys[:4]:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    image = once(index.astype(np.uint64))
    out = np.flatnonzero(image >= size)
    while len(out):
        image[out] = once(image[out])
        out = out[image[out] >= size]
    return image.astype(np.int64)


def slots(spark: SparkSession, table: list[dict], shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, slot, of, block): one row per slot of the mix, with the block that it takes."""
    spans = drawn(spark, [t["slots"] for t in table], shard, seed)
    each = spans.select("shard", "of", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))
    blocks = [t["blocks"] for t in table]
    names = [str(t["source"]) if t["source"] is not None else "\0" for t in table]

    def map_slots(batches):
        for batch in batches:
            of, slot = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("of", "slot"))
            block = np.zeros(len(of), np.int64)
            count = np.array(blocks, np.int64)[of]
            turn = slot // count
            for s, t in np.unique(np.stack([of.astype(np.int64), turn]), axis=1).T.tolist():
                at = np.flatnonzero((of == s) & (turn == t))
                block[at] = permuted(slot[at] % blocks[s], blocks[s], f"{seed}/{t}/{names[s]}".encode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("shard", "slot", "of")), pa.array(block)], ["shard", "slot", "of", "block"]
            )

    return each.mapInArrow(map_slots, "shard long, slot long, of int, block long")


def number_of(source: Column, table: list[dict]) -> Column:
    """The source's number in the table."""
    known = F.create_map(*[F.lit(x) for i, t in enumerate(table) if t["source"] is not None for x in (t["source"], i)])
    none = next((i for i, t in enumerate(table) if t["source"] is None), None)
    value = F.try_element_at(known, source) if any(t["source"] is not None for t in table) else F.lit(None)
    return F.when(source.isNull(), F.lit(none)).otherwise(value).cast("int")


def overlaps(placed: DataFrame, block: int) -> DataFrame:
    """(id, of, block, at, lo, hi): the words lo .. hi - 1 of a document that a block holds, from its place ``at``."""
    stop = F.col("start") + F.col("size")
    cut = placed.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((stop - 1) / block)))
    )
    lo = F.greatest(F.lit(0), F.col("block") * block - F.col("start"))
    hi = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start"))
    return cut.select("id", "of", "block", (F.col("start") + lo - F.col("block") * block).alias("at"), lo.alias("lo"), hi.alias("hi"))


def taken_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = SEED,
    **targets_of,
) -> DataFrame:
    """Per document: id, size, source_size, target (its source's) and the words that the mix takes."""
    placed = packed(docs, id_col, text_col, source_col)
    table = source_table(placed, block, **targets_of)
    placed = durable(placed.withColumn("of", number_of(F.col("source"), table)).withColumn("row", F.monotonically_increasing_id()))
    uses = slots(docs.sparkSession, table, shard, seed).groupBy(F.col("of").alias("o"), F.col("block").alias("b")).agg(F.count("*").alias("uses"))
    parts = overlaps(placed.withColumn("id", F.col("row")), block)
    took = (
        # counts by slot grow with the corpus and Spark underrates them: never broadcast
        parts.join(uses.hint("merge"), (F.col("of") == F.col("o")) & (F.col("block") == F.col("b")))
        .groupBy(F.col("id").alias("r"))
        .agg(F.sum((F.col("hi") - F.col("lo")) * F.col("uses")).alias("taken"))
    )

    def of_source(name, kind):
        values = F.array(*[F.lit(t[name]).cast(kind) for t in table]) if table else F.array().cast(f"array<{kind}>")
        return F.get(values, F.col("of")).alias("source_size" if name == "words" else name)

    return placed.join(took, F.col("row") == F.col("r"), "left").select(
        F.col("id").alias(id_col),
        "size",
        of_source("words", "long"),
        of_source("target", "double"),
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = SEED,
    **targets_of,
) -> DataFrame:
    """The mix itself: one row per slot with shard, slot, source, block, the ids in the block, and its words."""
    placed = packed(docs, id_col, text_col, source_col)
    table = source_table(placed, block, **targets_of)
    placed = durable(placed.withColumn("of", number_of(F.col("source"), table)))
    words = F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(WORD), F.lit(0))
    # one copy of each text per key, so that rows that repeat an id join once each
    texts = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).cast("string").alias("_source"),
        F.xxhash64(F.col(text_col)).alias("_hash"),
        F.col(text_col).cast("string").alias("_text"),
    ).dropDuplicates(["_id", "_source", "_hash"])
    same = placed["id"].eqNullSafe(texts["_id"]) & placed["source"].eqNullSafe(texts["_source"]) & (placed["hash"] == texts["_hash"])
    there = placed.filter("size > 0").join(texts, same).select("id", "of", "start", "size", words.alias("words"))
    first, stop = F.col("start"), F.col("start") + F.col("size")

    def piece(b: Column) -> Column:
        lo, hi = F.greatest(F.lit(0), b * block - first), F.least(F.col("size"), (b + 1) * block - first)
        return F.struct(
            b.alias("block"),
            F.struct(
                (first + lo).alias("at"),
                F.col("id"),
                (hi - lo).alias("n"),
                F.array_join(F.slice("words", (lo + 1).cast("int"), (hi - lo).cast("int")), " ").alias("text"),
            ).alias("piece"),
        )

    cut = F.transform(F.sequence(F.floor(first / block), F.floor((stop - 1) / block)), piece)
    blocks = (
        there.select("of", F.explode_outer(cut).alias("c"))
        .groupBy(F.col("of").alias("o"), F.col("c.block").alias("b"))
        .agg(F.array_sort(F.collect_list("c.piece")).alias("pieces"))
    )
    return (
        slots(docs.sparkSession, table, shard, seed)
        .join(blocks.hint("merge"), (F.col("of") == F.col("o")) & (F.col("block") == F.col("b")))
        .select(
            "shard",
            "slot",
            F.get(F.array(*[F.lit(t["source"]).cast("string") for t in table] or [F.lit(None).cast("string")]), F.col("of")).alias(source_col),
            "block",
            F.transform("pieces", lambda x: x["id"]).alias(f"{id_col}s"),
            F.array_join(F.transform("pieces", lambda x: x["text"]), " ").alias(text_col),
            F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + x["n"]).alias("n_words"),
        )
    )
