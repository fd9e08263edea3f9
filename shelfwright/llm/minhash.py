"""Near-duplicate documents: MinHash with tensored banding, candidates verified on full sets.

Two small collections of ``halves`` half keys are computed, each half key from ``width`` minhashes. Table (i, j)
is keyed by half key i of the first collection and j of the second, so ``halves ** 2`` tables of
``2 * width`` minhashes come from ``2 * halves * width`` minhashes instead of ``halves ** 2 * 2 * width``. Texts of
similarity s share a table with probability (1 - (1 - s ** width) ** halves) ** 2: at 0.8 with the defaults, 0.9996.

1. Documents with equal sets become one (by a 128-bit fingerprint of the set, and its size).
2. Tables (i, i): each document of a bucket is paired with one leader, drawn at random per bucket.
3. All tables: the documents of a bucket are paired with one leader of another component, drawn anew per bucket and round:
   as many pairs as rows. Rounds go on, ``ROUNDS`` at most, while each takes a quarter of the rows away; a bucket
   inside one component makes no pair.
4. All tables: in each bucket that still holds several components, any two documents of different components meet. A
   pair goes on only if set sizes and parity bits (a bound of the symmetric difference) leave the similarity possible.
   Both bounds are exact, so no document that shares a bucket with a similar one stays unlinked. A bucket of more
   than ``BLOCK`` documents is dealt out as pairs of blocks.

Pairs are verified on the exact shingle sets of the whole texts: linked where
100 * intersection >= ``percent`` * union. Components come from alternating stars.

Only buckets with several components are looked at again, so all tables are dealt out once. Ids are integers.

Defined cases: NULL, empty and wordless texts have an empty set and are linked with nothing; a text of fewer words
than a shingle has one shingle; rows that repeat an id are separate texts, each compared, and their links are the
id's; a row with a NULL id is never linked, and keeps a NULL component; other columns are ignored, or kept by
``drop_near_copies``, which also keeps one of the rows that repeat both id (NULL or not) and text.

Inside, a node is a number of a distinct set; (``doc``, ``hash``) are the id and the text's hash of one row with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm import textcols
from shelfwright.llm.components import components, gathered, settled
from shelfwright.llm.shingles import scrambled, shingle_sets
from shelfwright.session import durable

SHINGLE = 5
PERCENT = 80
HALVES = 12
WIDTH = 3
SEED = 5
BROADCAST_IDS = 500_000  # ids small enough to send to all tasks
ROUNDS = 8  # rounds of random leaders over all tables at most, before all documents of a bucket meet
TASK_ROWS = 2_000_000  # rows of all tables that a task deals out
PARITY_WORDS = 16  # 64-bit words of parity bits of a set
BLOCK = 2_000  # documents of a bucket that meet in one group


def half_keys(values: np.ndarray, bounds: np.ndarray, halves: int, width: int, seed: int) -> np.ndarray:
    """Two collections of half keys of each set: an array (2, halves, sets). Empty sets get the hashes of nothing."""
    n = len(bounds) - 1
    full = np.flatnonzero(np.diff(bounds) > 0)
    rng = np.random.default_rng(seed)
    short = (values >> np.uint64(32)).astype(np.uint32)
    keys = np.zeros((2, halves, n), np.uint64)
    for side in range(2):
        for i in range(halves):
            total = np.full(n, i, np.uint64)
            for _ in range(width):
                a, b = rng.integers(1, 1 << 32, 2, dtype=np.uint32)
                least = np.zeros(n, np.uint32)
                if len(full):
                    mixed = (short ^ b) * (a | np.uint32(1))
                    mixed ^= mixed >> np.uint32(15)
                    least[full] = np.minimum.reduceat(mixed * np.uint32(0x2C1B3C6D), bounds[:-1][full])
                total = scrambled(total * np.uint64(0x9E3779B97F4A7C15) + least)
            keys[side, i] = total
    return keys


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, hash) of each row."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))


def texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(x, text) of some nodes (x, doc, hash), one row each."""
    found = hashed(docs, id_col, text_col).join(nodes, (F.col("id") == F.col("doc")) & (F.col("hash") == nodes["h"]))
    return found.select("x", "text").dropDuplicates(["x"])


def node_texts(docs: DataFrame, ids: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(x, text) of the nodes in ``ids``, whose column is x."""
    at = members.select(F.col("id").alias("node"), "doc", F.col("hash").alias("h"))
    nodes = few_or_all(ids.join(at, F.col("x") == F.col("node")).select("x", "doc", "h"), BROADCAST_IDS)
    return texts_of(docs, nodes, id_col, text_col)


def signatures(
    docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, halves: int = HALVES, width: int = WIDTH, seed: int = SEED
) -> DataFrame:
    """(id, hash, n, f1, f2, first, second): hash of the text, set size, set fingerprint, collections of half keys. Durable."""
    picked = hashed(docs, id_col, text_col)

    def listed(side: np.ndarray) -> pa.Array:
        flat = np.ascontiguousarray(side.T).view(np.int64).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(side.shape[1] + 1, dtype=np.int32) * halves), pa.array(flat))

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                values, bounds = shingle_sets(part.column("text"), shingle)
                first, second = half_keys(values, bounds, halves, width, seed)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(scrambled(values + np.uint64(salt)), out=total[1:])
                    sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("hash"), pa.array(np.diff(bounds)), *map(pa.array, sums), listed(first), listed(second)],
                    ["id", "hash", "n", "f1", "f2", "first", "second"],
                )

    id_type = picked.schema["id"].dataType.simpleString()
    return durable(
        picked.mapInArrow(run, f"id {id_type}, hash long, n long, f1 long, f2 long, first array<long>, second array<long>")
    )


def keyed(members: DataFrame, tables: list[tuple[int, int]]) -> DataFrame:
    """(key, id, comp): each member once per table. Members are few and their rows many, so they are spread first."""
    tasks = max(members.sparkSession.sparkContext.defaultParallelism, -(-members.count() * len(tables) // TASK_ROWS))
    members = members.repartition(tasks, "id")
    keys = F.array(*[F.xxhash64(F.lit(i), F.lit(j), F.get("first", F.lit(i)), F.get("second", F.lit(j))) for i, j in tables])
    return members.select(F.explode_outer(keys).alias("key"), "id", "comp")


def shuffled_id(seed: int) -> Column:
    """The node with bits flipped as the bucket's key says: its minimum is a random member, and flips back."""
    return F.col("id").bitwiseXOR(F.xxhash64(F.lit(seed), "key").bitwiseAND(F.lit((1 << 62) - 1)))


def few_or_all(df: DataFrame, limit: int) -> DataFrame:
    """A durable copy, marked for broadcast while it has at most ``limit`` rows."""
    df = durable(df)
    rows = df.count()
    return F.broadcast(gathered(df, rows)) if rows <= limit else gathered(df, rows)


def leader_pairs(rows: DataFrame, seed: int) -> DataFrame:
    """(a, b): the members of each bucket with the bucket's leader."""
    lead = rows.groupBy(F.col("key").alias("k")).agg(F.min(shuffled_id(seed)).alias("lead"), F.count("*").alias("size"))
    met = rows.join(lead.filter("size > 1"), F.col("key") == F.col("k"))
    flip = shuffled_id(seed).bitwiseXOR(F.col("id"))
    return ordered(met.select("id", F.col("lead").bitwiseXOR(flip).alias("other")).filter("id <> other"))


def crowded_rows(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component. Durable."""
    spread = rows.groupBy(F.col("key").alias("q")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    crowded = few_or_all(spread.filter("lo <> hi").select("q"), BROADCAST_IDS)
    return settled(rows.join(crowded, F.col("key") == F.col("q"), "left_semi"))


def star_pairs(rows: DataFrame, seed: int) -> DataFrame:
    """(a, b): in each bucket, the members that are not of its leader's component with the leader, drawn anew for each seed."""
    lead = rows.groupBy(F.col("key").alias("k")).agg(F.min(F.struct(shuffled_id(seed).alias("lead"), "comp")).alias("first"))
    met = rows.join(lead, F.col("key") == F.col("k")).filter(F.col("comp") != F.col("first.comp"))
    flip = shuffled_id(seed).bitwiseXOR(F.col("id"))
    return ordered(met.select("id", F.col("first.lead").bitwiseXOR(flip).alias("other")))


def parity_bits(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per set, whether an odd number of its members fall on each bit: an array (sets, PARITY_WORDS).

    The bits in which two sets differ are at most as many as the members that only one of them has.
    """
    bits = scrambled(values) % np.uint64(64 * PARITY_WORDS)
    words = np.zeros((len(bounds) - 1) * PARITY_WORDS, np.uint64)
    places = textcols.owner(bounds) * PARITY_WORDS + (bits >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(words, places, np.uint64(1) << (bits & np.uint64(63)))
    return words.reshape(-1, PARITY_WORDS)


def outlines(docs: DataFrame, ids: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, n, bits) of some nodes: set size and parity bits. Durable."""
    texts = node_texts(docs, ids, members, id_col, text_col)

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text"):
                values, bounds = shingle_sets(part.column("text"), shingle)
                bits = parity_bits(values, bounds).view(np.uint8).reshape(-1, 8 * PARITY_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [part.column("x"), pa.array(np.diff(bounds)), pa.array([b.tobytes() for b in bits], pa.binary())],
                    ["id", "n", "bits"],
                )

    return settled(texts.mapInArrow(run, "id long, n long, bits binary"))


def pairs_in_groups(table: pa.Table, percent: int) -> pa.RecordBatch:
    """(a, b) for the documents of each group that differ in component and may be similar enough. Groups are in a row."""
    group, comp, ids, n, side = (table.column(c).to_numpy() for c in ("group", "comp", "id", "n", "side"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, PARITY_WORDS)
    found = []
    at, step = np.arange(len(group)), 1
    while True:
        at = at[: np.searchsorted(at, len(group) - step)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        # side is -1 in a group of one block; of two blocks, only documents of different blocks meet
        apart = (side[at] != side[at + step]) | (side[at] < 0)
        x, y = n[at], n[at + step]
        close = apart & (comp[at] != comp[at + step]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        i = at[close]
        total = n[i] + n[i + step]
        differ = np.bitwise_count(bits[i] ^ bits[i + step]).sum(axis=1, dtype=np.int64)
        i = i[(100 + percent) * differ <= (100 - percent) * total]
        found.append(np.stack([np.minimum(ids[i], ids[i + step]), np.maximum(ids[i], ids[i + step])], axis=1))
        step += 1
    both = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, i]), pa.int64()) for i in (0, 1)], ["a", "b"])


def all_pairs(rows: DataFrame, outlined: DataFrame, percent: int) -> DataFrame:
    """(a, b): any two documents of different components in a bucket, without those that cannot be similar enough."""
    size = rows.groupBy(F.col("key").alias("k")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    whole = rows.join(size, F.col("key") == F.col("k")).withColumn("own", F.pmod(F.xxhash64(F.lit(1), "id"), "blocks"))
    with_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = whole.select("key", "id", "comp", "own", with_block.alias("other")).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).cast("long").alias("side"), "id", "comp",
    )
    full = dealt.join(outlined, "id").select(
        "group", "side", F.col("comp").cast("long").alias("comp"), F.col("id").cast("long").alias("id"), "n", "bits"
    )
    by_group = full.repartition("group").sortWithinPartitions("group")

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            group = held.column("group").to_numpy()
            # the last group may go on in the next batch
            done = int(np.searchsorted(group, group[-1]))
            if done:
                yield pairs_in_groups(held.slice(0, done), percent)
                held = held.slice(done)
        if held is not None:
            yield pairs_in_groups(held, percent)

    return settled(by_group.mapInArrow(run, "a long, b long").distinct())


def of_close_sizes(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs whose set sizes can still reach the similarity. Durable."""
    sizes = members.select("id", "n")
    both = pairs.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("x")), "a").join(
        sizes.select(F.col("id").alias("b"), F.col("n").alias("y")), "b"
    )
    return settled(both.filter(100 * F.least("x", "y") >= percent * F.greatest("x", "y")).select("a", "b"))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("x")).union(pairs.select("b")).distinct()
    texts = node_texts(docs, ids, members, id_col, text_col)
    left = texts.select(F.col("x").alias("i"), F.col("text").alias("text_a"))
    right = texts.select(F.col("x").alias("j"), F.col("text").alias("text_b"))
    both = pairs.join(left, F.col("a") == F.col("i")).join(right, F.col("b") == F.col("j")).select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            for part in textcols.row_slices(batch, "text_a"):
                coded = [part.column(c).dictionary_encode() for c in ("text_a", "text_b")]
                sets = [shingle_sets(c.dictionary, shingle) for c in coded]
                keep = np.zeros(part.num_rows, bool)
                for r, (i, j) in enumerate(zip(*[c.indices.to_pylist() for c in coded])):
                    if i is None or j is None:
                        continue
                    x, y = (v[b[k] : b[k + 1]] for (v, b), k in zip(sets, (i, j)))
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep[r] = shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return settled(both.mapInArrow(run, pairs.schema))


def relabelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the components that new links make. Durable."""
    comps = members.select("id", "comp")
    ends = (
        links.join(comps.select(F.col("id").alias("a"), F.col("comp").alias("x")), "a")
        .join(comps.select(F.col("id").alias("b"), F.col("comp").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    labels = components(ends)
    moved = members.join(labels, F.col("comp") == F.col("node"), "left")
    return settled(moved.withColumn("comp", F.coalesce("label", "comp")).drop("node", "label"))


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    halves: int = HALVES,
    width: int = WIDTH,
    seed: int = SEED,
) -> DataFrame:
    """Per document: id, n_shingles, component_id (the smallest id linked with it, directly or not), kept."""
    sign = signatures(docs, id_col, text_col, shingle, halves, width, seed)
    whole = sign.filter("n > 0 AND id IS NOT NULL")
    sets = whole.groupBy(F.col("n").alias("m"), F.col("f1").alias("g1"), F.col("f2").alias("g2")).agg(F.min("id").alias("rep"))
    sets = settled(sets.withColumn("node", F.monotonically_increasing_id()))
    same = (F.col("n") == F.col("m")) & (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2"))
    copied = settled(whole.select("id", "n", "f1", "f2").join(sets, same).select("id", "node").distinct())
    members = settled(
        whole.join(sets, same & (F.col("id") == F.col("rep")))
        .select(F.col("node").alias("id"), F.col("id").alias("doc"), "hash", "n", "first", "second", F.col("node").alias("comp"))
        .dropDuplicates(["id"])
    )
    # an id that several sets share links them
    several = copied.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    links = copied.join(several, "id").filter("a <> node").select("a", F.col("node").alias("b"))

    pairs = of_close_sizes(leader_pairs(keyed(members, [(i, i) for i in range(halves)]), seed), members, percent)
    members = relabelled(members, verified(pairs, docs, members, id_col, text_col, shingle, percent).unionByName(links))
    rows = crowded_rows(keyed(members, [(i, j) for i in range(halves) for j in range(halves)]))
    left = rows.count()
    for turn in range(1, ROUNDS + 1 if left else 1):
        pairs = of_close_sizes(star_pairs(rows, seed + turn), members, percent)
        members = relabelled(members, verified(pairs, docs, members, id_col, text_col, shingle, percent))
        rows = crowded_rows(rows.drop("comp").join(members.select("id", "comp"), "id").select("key", "id", "comp"))
        before, left = left, rows.count()
        if 4 * left > 3 * before or not left:
            break
    if left:
        outlined = outlines(docs, rows.select(F.col("id").alias("x")).distinct(), members, id_col, text_col, shingle)
        links = verified(all_pairs(rows, outlined, percent), docs, members, id_col, text_col, shingle, percent)
        members = relabelled(members, links)

    # the component of an id: the smallest id with any set of its component
    linked = settled(copied.join(members.select(F.col("id").alias("m"), "comp"), F.col("node") == F.col("m")).select(F.col("id").alias("i"), "comp").distinct())
    least = linked.groupBy(F.col("comp").alias("c")).agg(F.min("i").alias("least"))
    labels = linked.join(least, F.col("comp") == F.col("c")).select("i", "least")
    label = F.coalesce("least", "id")
    return sign.join(labels, F.col("id") == F.col("i"), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), label.alias("component_id"), label.eqNullSafe(F.col("id")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with the smallest id of their component, with all their columns."""
    found = settled(near_components(docs, id_col, text_col, **options).select(F.col(id_col).alias("_id"), "n_shingles", "kept"))
    gone = few_or_all(found.filter("NOT kept").select(F.col("_id").alias("_gone")).distinct(), BROADCAST_IDS)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("of"), F.xxhash64(text_col).alias("h"), F.xxhash64(F.lit(1), text_col).alias("g"))
    rows = rows.join(gone, F.col("of") == F.col("_gone"), "left_anti")
    repeated = found.filter("kept AND n_shingles > 0").groupBy("_id").count().filter("count > 1").select("_id")
    repeated = few_or_all(repeated, BROADCAST_IDS)
    if not repeated.isEmpty():
        again = F.col("of").eqNullSafe(F.col("_id"))
        texts = rows.join(repeated, again, "left_semi").groupBy("of", "h", "g").agg(F.first("row").alias("row"))
        rows = rows.join(repeated, again, "left_anti").select("row").unionByName(texts.select("row"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
