"""Per-locale overlays over base rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def overlay_columns(
    base: DataFrame, translated: DataFrame, on: list[str], columns: list[str]
) -> DataFrame:
    """Base rows with each column taken from the translation where that has a value."""
    renamed = translated.select(*on, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = base.join(renamed, on, "left")
    for column in columns:
        joined = joined.withColumn(column, F.coalesce(F.col(f"_{column}"), F.col(column)))
    return joined.drop(*[f"_{c}" for c in columns])


def overlay_replace(base: DataFrame, localised: DataFrame, key: str) -> DataFrame:
    """Localised rows stand in for *all* base rows of the same entity; other entities keep theirs."""
    covered = localised.select(key).distinct()
    return localised.unionByName(base.join(covered, key, "left_anti"))
