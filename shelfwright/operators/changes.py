"""Snapshot diff, change-sets and their application.

The diff runs on published rows, so that applying the change-set to the old tables gives the same
tables as a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions.keys import content_hash, opaque_id
from shelfwright.operators.ordered import with_row_number
from shelfwright.session import durable

ADDED, MODIFIED, DELETED = "added", "modified", "deleted"
MOST_ROUNDS = 64
CHECKSUM_WIDTH = 4096
MOST_SENT = 1_000_000  # small groups that differ, as two numbers each, sent to all tasks


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join on keys that may be NULL; the key columns of ``left`` stay, those of ``right`` go."""
    names = {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, renamed in names.items():
        same = same & left[k].eqNullSafe(right[renamed])
    joined = left.join(right, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def classify(base: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, op)`` of every row that was added, modified or deleted. Only keys and fingerprints
    are shuffled. NULL is a key value like any other."""

    def fingerprint(df: DataFrame, side: str) -> DataFrame:
        values = sorted(c for c in df.columns if c not in keys)
        named = [F.col(k).alias(f"_{side}_{k}") for k in keys]
        return df.select(*named, content_hash(*values).alias(f"_{side}"), F.lit(True).alias(f"_in_{side}"))

    old, new = fingerprint(base, "old"), fingerprint(current, "new")
    same = F.lit(True)
    for k in keys:
        same = same & old[f"_old_{k}"].eqNullSafe(new[f"_new_{k}"])
    both = old.join(new, same, "full_outer")
    op = (
        F.when(F.col("_in_old").isNull(), F.lit(ADDED))
        .when(F.col("_in_new").isNull(), F.lit(DELETED))
        .when(F.col("_old") != F.col("_new"), F.lit(MODIFIED))
    )
    key = [F.when(F.col("_in_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(f"_new_{k}")).alias(k) for k in keys]
    return both.select(*key, op.alias("op")).where(F.col("op").isNotNull())


def _checksums(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Rows and four sums of row hashes by group. Sums of 32 bits neither overflow nor cancel out."""
    row = F.to_json(F.struct(*values))
    parts = []
    for seed in (0, 1):
        h = F.xxhash64(F.lit(seed), row)
        parts += [h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)]
    sums = [F.sum(part).alias(f"_sum{i}") for i, part in enumerate(parts)]
    return df.groupBy(*group).agg(F.count("*").alias("_rows"), *sums)


def _differing(base: DataFrame, current: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """The groups whose checksums are not the same on both sides."""
    old, new = _checksums(base, group, values), _checksums(current, group, values)
    sums = [c for c in old.columns if c not in group]
    renamed = new.withColumnsRenamed({c: f"_new{c}" for c in sums})
    equal = F.lit(True)
    for c in sums:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_new{c}"))
    return old.join(renamed, group, "full_outer").where(~equal).select(*group)


def classify_sparse(base: DataFrame, current: DataFrame, keys: list[str], width: int = CHECKSUM_WIDTH) -> DataFrame:
    """``classify`` for snapshots that hardly differ: equal stretches of keys are never shuffled.

    A checksum tree of two levels over hashed keys: ``width`` groups, and ``width`` in each group that differs. Sums are
    combined before they are shuffled, so a task sends at most ``width`` rows, or ``width`` for each group that differs. The rows of
    the small groups that differ are all that goes to the join; both tables are read three times instead.
    """
    values = sorted(base.columns)
    place = F.xxhash64(F.lit("place"), *keys)
    marked = [
        df.select(*values, F.pmod(place, F.lit(width)).alias("_top"), F.pmod(F.shiftright(place, 32), F.lit(width)).alias("_low"))
        for df in (base, current)
    ]
    top = durable(_differing(*marked, ["_top"], values))  # at most ``width`` rows, so it may be sent to all tasks
    inside = [df.join(F.broadcast(top), "_top", "left_semi") for df in marked]
    low = durable(_differing(*inside, ["_top", "_low"], values))
    small = low.count() <= MOST_SENT
    low = F.broadcast(low) if small else low
    rows = [df.join(low, ["_top", "_low"], "left_semi").select(*values) for df in (inside if small else marked)]
    return classify(*rows, keys)


def change_set(base: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, op, payload)``: the new row for additions and changes, NULL for deletions."""
    ops = classify(base, current, keys)
    values = [c for c in current.columns if c not in keys]
    rows = current.select(*keys, F.struct(*values).alias("payload"))
    return matched(ops, rows, keys, "left")


def apply_changes(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Base rows that are untouched plus the new rows of the change-set."""
    kept = matched(base, changes.select(*keys), keys, "left_anti")
    new = changes.where(F.col("op") != DELETED).select(*keys, "payload.*")
    return kept.unionByName(new.select(*base.columns))


def replace_children(children: DataFrame, new: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children of touched parents are dropped and replaced by ``new``; the others stay."""
    touched = parents.select(key).distinct()
    return children.join(touched, key, "left_anti").unionByName(new.join(touched, key, "left_semi"))


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Children without those of deleted parents."""
    return children.join(deleted.select(key).distinct(), key, "left_anti")


def changed_ids(base: DataFrame, current: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """Entities present in both snapshots whose id is not the same. NULL is a key value like any other."""
    old = base.select(*keys, F.col(id_).alias("old_id"))
    new = current.select(*keys, F.col(id_).alias("new_id"))
    return matched(old, new, keys, "inner").where(
        F.col("old_id").isNotNull() & ~F.col("old_id").eqNullSafe(F.col("new_id"))
    )


def deleted_ids(base: DataFrame, changes: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """Ids of deleted entities, resolved from the old snapshot; NULL ids are left for a warning."""
    gone = changes.where(F.col("op") == DELETED).select(*keys)
    return matched(gone, base.select(*keys, id_), keys, "inner")


def apply_order(collection: Column, order: list[str] = fixed.COLLECTIONS) -> Column:
    """Rank of a collection when changes are applied: owners before what they own."""
    return F.array_position(F.array(*[F.lit(c) for c in order]), collection)


def numbered_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``_repeat``, their number among the rows of their key by content. Rows are numbered over the whole table in
    slices, so the rows of one key (those without one, say) are spread over many tasks; a key's first number is
    an aggregate."""
    numbered = with_row_number(df.withColumn("_content", content_hash(*df.columns)), [*keys, "_content"], "_number")
    first = numbered.groupBy(*keys).agg(F.min("_number").alias("_first"))
    repeat = (F.col("_number") - F.col("_first") + 1).cast("int")
    return matched(numbered, first, keys, "inner").withColumn("_repeat", repeat).drop("_content", "_number", "_first")


def assign_ids(df: DataFrame, id_: str, parts: list[str]) -> DataFrame:
    """Rows with every missing id filled in; ``assigned`` tells which.

    Ids come from the natural key, of which any part may be NULL. Rows that repeat a natural key are
    numbered, by their content, and the number is one more part from the second row on. When an id is already taken the salt is
    raised for the colliding rows only; each round is cut with a checkpoint, and ``MOST_ROUNDS`` rounds without an end are an error.
    """
    missing = df.where(F.coalesce(id_, F.lit("")) == "")
    kept = df.where(F.coalesce(id_, F.lit("")) != "").withColumn("assigned", F.lit(False))
    taken = kept.select(F.col(id_).alias("_taken"))
    missing = durable(numbered_repeats(missing, parts))
    again = F.when(F.col("_repeat") > 1, F.col("_repeat").cast("string"))
    key = [*[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts], again]
    rank = F.struct(*parts, "_repeat")
    filled = None
    for salt in range(MOST_ROUNDS):
        candidate = missing.withColumn(id_, opaque_id(*key, salt=salt))
        free = candidate.join(taken, F.col(id_) == F.col("_taken"), "left_anti")
        # within a round candidates differ unless the hash collides; the first in key order keeps the id
        winners = free.groupBy(F.col(id_).alias("_id")).agg(F.min(rank).alias("_winner"))
        won = durable(free.join(winners, (F.col(id_) == F.col("_id")) & rank.eqNullSafe(F.col("_winner")), "left_semi"))
        filled = won if filled is None else filled.unionByName(won)
        missing = durable(matched(missing, won.select(*parts, "_repeat"), [*parts, "_repeat"], "left_anti"))
        if missing.isEmpty():
            return kept.unionByName(filled.drop("_repeat").withColumn("assigned", F.lit(True)))
        taken = taken.unionByName(won.select(F.col(id_).alias("_taken")))
    raise RuntimeError(f"ids of some rows collide after {MOST_ROUNDS} salts")


def rekey(df: DataFrame, id_: str, parts: list[str]) -> DataFrame:
    """``(old_id, new_id)`` for every entity."""
    return df.select(
        F.col(id_).alias("old_id"), opaque_id(*[F.col(p).cast("string") for p in parts]).alias("new_id")
    )


def remap(df: DataFrame, reference: str, mapping: DataFrame) -> DataFrame:
    """References rewritten through the mapping; one that is not mapped stays as it is."""
    return (
        df.join(mapping, F.col(reference) == F.col("old_id"), "left")
        .withColumn(reference, F.coalesce("new_id", reference))
        .drop("old_id", "new_id")
    )
