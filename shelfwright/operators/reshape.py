"""Nested documents to flat tables. None of these shuffle: each row is taken apart where it lies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.keys import child_key


def explode_list(df: DataFrame, keys: list[str], values: Column, name: str) -> DataFrame:
    """``keys`` with one row per list element."""
    return df.select(*keys, F.explode(values).alias(name))


def explode_children(
    df: DataFrame, key: str, children: str, fields: dict[str, str | Column], row_key: str | None = None
) -> DataFrame:
    """One row per struct in ``children``: the key, a position, and the wanted fields.

    ``fields`` maps output names to a field name, or to a column over ``child``. With ``row_key`` a
    key derived from parent and position is added.
    """
    flat = df.select(F.col(key), F.posexplode(children).alias("pos", "child"))
    columns = [
        (F.col(f"child.{source}") if isinstance(source, str) else source).alias(name)
        for name, source in fields.items()
    ]
    if row_key:
        columns.insert(0, child_key(F.col(key), F.lit(children), F.col("pos")).alias(row_key))
    return flat.select(key, "pos", *columns)


def explode_map(
    df: DataFrame, keys: list[str | Column], entries: str, key_name: str, value_name: str
) -> DataFrame:
    return df.select(*keys, F.explode(entries).alias(key_name, value_name))


def with_map_entry(df: DataFrame, keys: list[str], list_: Column, map_: Column, name: str, entry: str):
    """One row per list element with the map's value of the same key, NULL when there is none."""
    exploded = df.select(*keys, F.explode(list_).alias(name), map_.alias("_map"))
    return exploded.withColumn(entry, F.try_element_at("_map", F.col(name))).drop("_map")


def replace_alias(values: Column, aliases: Column) -> Column:
    """List with every alias replaced by its canonical term, each term once."""
    return F.array_distinct(
        F.transform(values, lambda v: F.coalesce(F.try_element_at(aliases, v), v))
    )


def alias_map(aliases: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for item in aliases.items() for part in item])


def search_document(
    df: DataFrame, key: str, name: str, owner_name: str, categories: Column, description: str
) -> DataFrame:
    """Text fields of an entity that are searched; missing parts are empty."""
    empty = F.lit("")
    return df.select(
        F.col(key),
        F.col(name).alias("name"),
        F.coalesce(F.col(owner_name), empty).alias("manufacturer_name"),
        F.coalesce(F.array_join(categories, " "), empty).alias("categories"),
        F.coalesce(F.col(description), empty).alias("description"),
    )
