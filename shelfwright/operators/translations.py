"""Checks and counts over per-locale translations, given as one row per entity and locale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unknown_fields(fields: Column, allowed: list[str]) -> Column:
    return F.array_except(fields, F.array(*[F.lit(a) for a in allowed]))


def unapproved(rows: DataFrame, locale: str, locales: DataFrame, code: str) -> DataFrame:
    """Rows in a locale that is not approved."""
    return rows.join(locales.select(F.col(code).alias(locale)), locale, "left_anti")


def translation_stats(rows: DataFrame, key: list[str], locale: str, locales: DataFrame, code: str):
    """Entities with translations, translations, locales, locales that are not approved."""
    approved = locales.select(F.col(code).alias("_code")).distinct()
    per_locale = rows.groupBy(locale).agg(F.count("*").alias("_n"))
    by_locale = per_locale.join(approved, F.col(locale) == F.col("_code"), "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_translations"),
        F.count("*").alias("locales_used"),
        F.count_if(F.col("_code").isNull()).alias("unapproved_locales"),
    )
    return rows.agg(F.count_distinct(*key).alias("files_with_translations")).select(
        "files_with_translations",
        by_locale.select("total_translations").scalar().alias("total_translations"),
        by_locale.select("locales_used").scalar().alias("locales_used"),
        by_locale.select("unapproved_locales").scalar().alias("unapproved_locales"),
    )
