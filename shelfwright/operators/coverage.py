"""Which formats have identifiers, and where they are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions.identifiers import invalid_identifiers
from shelfwright.functions.text import rounded_percent


def analysis(df: DataFrame, keys: list[str], formats: str, identifiers: str) -> DataFrame:
    """Per entry: formats, identifiers, whether it has any, which are missing, which are invalid."""
    listed = F.coalesce(F.col(formats), F.array().cast("array<string>"))
    given = F.coalesce(F.col(identifiers), F.create_map().cast("map<string,string>"))
    return df.select(
        *keys,
        listed.alias("formats"),
        given.alias("identifiers"),
        (F.size(given) > 0).alias("has_identifiers"),
        missing_formats(listed, given).alias("missing_formats"),
        invalid_identifiers(given).alias("invalid_identifiers"),
    )


def missing_formats(
    formats: Column, identifiers: Column, exempt: str = fixed.FORMAT_WITHOUT_IDENTIFIER
) -> Column:
    """Formats without a key among the identifiers; repeats are kept."""
    return F.filter(
        formats, lambda f: ~F.map_contains_key(identifiers, f) & (f != F.lit(exempt))
    )


def coverage_by_format(entries: DataFrame, exempt: str = fixed.FORMAT_WITHOUT_IDENTIFIER) -> DataFrame:
    """Entries per format and how many have a non-empty identifier for it."""
    per_format = entries.select(F.explode("formats").alias("format"), "identifiers").where(
        F.col("format") != exempt
    )
    held = F.coalesce(F.try_element_at("identifiers", F.col("format")), F.lit("")) != ""
    counted = per_format.groupBy("format").agg(
        F.count("*").alias("entries_with_format"),
        F.count_if(held).alias("entries_with_identifier"),
    )
    return counted.withColumn(
        "coverage_percent",
        rounded_percent(F.col("entries_with_identifier"), F.col("entries_with_format")),
    )


def coverage_summary(entries: DataFrame) -> DataFrame:
    with_any = F.count_if("has_identifiers")
    return entries.agg(
        F.count("*").alias("total"),
        with_any.alias("with_identifiers"),
        F.count_if(~F.col("has_identifiers")).alias("without_identifiers"),
        rounded_percent(with_any, F.count("*")).alias("coverage_percent"),
        F.coalesce(F.sum(F.size("invalid_identifiers")), F.lit(0)).cast("bigint").alias(
            "invalid_identifiers"
        ),
    )


def priority(
    entries: DataFrame,
    urgent: list[str] = fixed.URGENT_FORMATS,
    exempt: str = fixed.FORMAT_WITHOUT_IDENTIFIER,
) -> DataFrame:
    """Urgency of entries that have no identifier at all; the others get none."""
    has_urgent = F.exists("formats", lambda f: f.isin(urgent))
    has_other = F.exists("formats", lambda f: f != exempt)
    level = (
        F.when(has_urgent & (F.size("missing_formats") > 0), F.lit("high"))
        .when(has_other, F.lit("medium"))
        .otherwise(F.lit("low"))
    )
    return entries.where(~F.col("has_identifiers")).withColumn("priority", level)
