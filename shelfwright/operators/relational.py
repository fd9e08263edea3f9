"""Lookups, pages, counted listings and membership views: the shapes consumers query with."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def page(df: DataFrame, order: list, size: int, offset: int = 0) -> DataFrame:
    """One page in a total order. Spark keeps only the first ``offset + size`` rows per task."""
    return df.orderBy(*order).offset(offset).limit(size)


def count_by(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    """Rows per key, most frequent first, key as tie-break."""
    counted = df.groupBy(key).agg(F.count("*").alias(name))
    return counted.orderBy(F.desc(name), key)


def top_with_remainder(df: DataFrame, order: list, size: int, name: str = "remaining") -> DataFrame:
    """First ``size`` rows, each with the number of rows that were left out."""
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).limit(size).withColumn(
        name, F.greatest(total - F.lit(size), F.lit(0)).cast("bigint")
    )


def with_owner(products: DataFrame, owner_key: str, owners: DataFrame, key: str) -> DataFrame:
    """Left join to the owner; products without a known owner keep NULL owner columns."""
    return products.join(owners, F.col(owner_key) == F.col(key), "left")


def members(
    entities: DataFrame, key: str, bridge: DataFrame, bridge_key: str, member: str, *direct: str
) -> DataFrame:
    """``(key, member)`` from a bridge table and from columns of the entity itself, each pair once."""
    listed = bridge.select(F.col(bridge_key).alias(key), F.col(member))
    own = entities.select(key, F.explode(F.array(*direct)).alias(member)).where(
        F.col(member).isNotNull()
    )
    return listed.unionByName(own).distinct()


def union_collections(**collections: DataFrame) -> DataFrame:
    """All collections as one table with a ``collection`` column; absent columns become NULL."""
    parts = [df.withColumn("collection", F.lit(name)) for name, df in collections.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row per key. Combines map-side, so a hot key costs one row per task."""
    newest = F.max(F.struct(*order, *[c for c in df.columns if c not in {key, *order}])).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*").select(*df.columns)


def numbers_of(df: DataFrame, **measures: Column) -> DataFrame:
    """One row of named aggregates."""
    return df.agg(*[column.alias(name) for name, column in measures.items()])
