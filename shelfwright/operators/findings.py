"""Findings: coded results of validation rules, as one long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwright import fixed_values as fixed

COLUMNS = ["collection", "slug", "tier", "code", "path", "message", "suggestion"]

# tiers in the order they are checked; only the first failing one is reported per document
PARSE, SHAPE, OWNER, LINEAGE, CATEGORIES = 1, 2, 3, 4, 5
OUTSIDE_TIERS = 0


def finding(
    df: DataFrame,
    *,
    tier: int,
    code: str,
    path: str | Column,
    message: str | Column,
    collection: str | Column = "collection",
    slug: str | Column = "slug",
    suggestion: Column | None = None,
) -> DataFrame:
    """Rows of ``df`` as findings."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    as_text = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(
        as_column(collection).alias("collection"),
        as_column(slug).cast("string").alias("slug"),
        F.lit(tier).alias("tier"),
        F.lit(code).alias("code"),
        as_text(path).alias("path"),
        as_text(message).alias("message"),
        (F.lit(None).cast("string") if suggestion is None else suggestion).alias("suggestion"),
    )


def all_findings(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def first_tier(findings: DataFrame) -> DataFrame:
    """Findings of the first failing tier of each document, and those outside the tiers.

    The window holds the findings of one document, which come from one row.
    """
    per_document = Window.partitionBy("collection", "slug")
    ranked = F.when(F.col("tier") > OUTSIDE_TIERS, F.col("tier"))
    return (
        findings.withColumn("_first", F.min(ranked).over(per_document))
        .where((F.col("tier") == OUTSIDE_TIERS) | (F.col("tier") == F.col("_first")))
        .drop("_first")
    )


def per_document(findings: DataFrame) -> DataFrame:
    """One row per document with its findings in order. A document has as many as its row gave."""
    entry = F.struct("tier", "code", "path", "message", "suggestion")
    return findings.groupBy("collection", "slug").agg(
        F.array_sort(F.collect_list(entry)).alias("findings")
    )


def code_registry(spark) -> DataFrame:
    return spark.createDataFrame(fixed.FINDING_CODES, "code string, title string, anchor string")


def with_titles(findings: DataFrame, docs_base: str = "findings.md") -> DataFrame:
    """Findings with title and documentation link of their code."""
    titled = findings.join(code_registry(findings.sparkSession), "code", "left")
    return titled.withColumn("docs", F.concat(F.lit(docs_base + "#"), "anchor")).drop("anchor")


def valid_counts(entities: DataFrame, findings: DataFrame) -> DataFrame:
    """Documents per collection, and how many of them have no finding."""
    flagged = findings.select("collection", F.col("slug").alias("_slug")).distinct()
    marked = entities.select("collection", F.col("slug").cast("string").alias("slug")).join(
        flagged.withColumn("_bad", F.lit(1)).withColumnRenamed("_slug", "slug"),
        ["collection", "slug"],
        "left",
    )
    return marked.groupBy("collection").agg(
        F.count("*").alias("documents"), F.count_if(F.col("_bad").isNull()).alias("valid")
    )
