"""Referential integrity and vocabulary reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions.text import option_list


def dangling(df: DataFrame, reference: list[str], targets: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose reference is given but has no target."""
    known = targets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).distinct()
    condition = F.lit(True)
    for i, column in enumerate(reference):
        condition = condition & (F.col(column) == F.col(f"_k{i}"))
    given = df.where(F.col(reference[-1]).isNotNull())
    return given.join(known, condition, "left_anti")


def reconcile(vocabulary: DataFrame, term: str, grouped: DataFrame, member: str, group: str) -> DataFrame:
    """``(term, status)`` for every term that is not assigned to exactly one group.

    ``unmapped``: in the vocabulary but in no group; ``orphan``: grouped but unknown;
    ``multi_mapped``: in more than one group.
    """
    uses = grouped.groupBy(F.col(member).alias("_member")).agg(
        F.count_distinct(group).alias("_groups")
    )
    both = vocabulary.select(F.col(term).alias("_term")).distinct().join(
        uses, F.col("_term") == F.col("_member"), "full_outer"
    )
    status = (
        F.when(F.col("_member").isNull(), F.lit("unmapped"))
        .when(F.col("_term").isNull(), F.lit("orphan"))
        .when(F.col("_groups") > 1, F.lit("multi_mapped"))
    )
    return both.select(F.coalesce("_term", "_member").alias("term"), status.alias("status")).where(
        F.col("status").isNotNull()
    )


def multi_mapped(grouped: DataFrame, member: str, group: str) -> DataFrame:
    """Members assigned to more than one group, with the first and last group in order."""
    return (
        grouped.groupBy(member)
        .agg(
            F.count_distinct(group).alias("groups"),
            F.min(group).alias("first_group"),
            F.max(group).alias("last_group"),
        )
        .where(F.col("groups") > 1)
    )


def known_members(grouped: DataFrame, member: str, vocabulary: DataFrame, term: str) -> DataFrame:
    """Group members that the vocabulary knows; a group left without any disappears."""
    known = vocabulary.select(F.col(term).alias(member)).distinct()
    return grouped.join(known, member, "left_semi")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys used more than once, with the number of uses."""
    given = df.where(F.col(keys[-1]).isNotNull())
    return given.groupBy(*keys).agg(F.count("*").alias("uses")).where(F.col("uses") > 1)


def options_shown(options: DataFrame, option: str, limit: int = fixed.OPTION_LIST_LIMIT) -> Column:
    """The option list of a whole vocabulary, as a value to put into messages. No more than
    ``limit`` options are ever gathered."""
    first = options.select(option).orderBy(option).limit(limit).agg(F.collect_list(option).alias("_first"))
    total = options.agg(F.count("*")).scalar()
    return first.select(option_list(F.col("_first"), total, limit)).scalar()


def options_by_group(
    pairs: DataFrame, group: str, option: str, limit: int = fixed.OPTION_LIST_LIMIT
) -> DataFrame:
    """``(group, shown)``: the option list of each group. The rank limit is applied before the
    shuffle, so a group with very many options sends only its first ones."""
    distinct = pairs.select(group, option).distinct()
    rank = F.row_number().over(Window.partitionBy(group).orderBy(option))
    first = distinct.withColumn("_rank", rank).where(F.col("_rank") <= limit)
    first = first.groupBy(group).agg(F.collect_list(option).alias("_first"))
    totals = distinct.groupBy(group).agg(F.count("*").alias("_total"))
    return first.join(totals, group).select(
        group, option_list(F.col("_first"), F.col("_total"), limit).alias("shown")
    )
