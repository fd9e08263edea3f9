"""Quality reports over the documents: freshness, identifier coverage, link health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.urls import extract_urls
from shelfwright.operators import changes as cdc, coverage, freshness as fresh, health
from shelfwright.operators.relational import union_collections
from shelfwright.sources import documents as src


def _entries(docs: DataFrame) -> DataFrame:
    columns = ["slug", "path", "name", "prices", "verification"]
    return union_collections(
        **{c: src.typed(docs, c).select(*columns) for c in ("software", "hardware")}
    )


def entry_freshness(docs: DataFrame, as_of: Column) -> DataFrame:
    rows = _entries(docs).select(
        "collection", "slug", "name",
        F.col("verification.lastVerified").alias("day"), F.col("verification.status").alias("status"),
    )
    return fresh.entry_freshness(rows, ["collection", "slug", "name", "day", "status"], "day", "status", as_of)


def price_freshness(docs: DataFrame, as_of: Column) -> DataFrame:
    prices = _entries(docs).select("collection", "slug", "name", F.posexplode("prices").alias("pos", "price"))
    rows = prices.select(
        "collection", "slug", "name", "pos", F.col("price.asOf").alias("day"), "price.amount", "price.currency"
    )
    return fresh.price_freshness(rows, ["collection", "slug", "name", "pos", "day"], "day", as_of)


def freshness_summary(docs: DataFrame, as_of: Column) -> DataFrame:
    return fresh.freshness_summary(entry_freshness(docs, as_of), price_freshness(docs, as_of))


def identifier_analysis(docs: DataFrame) -> DataFrame:
    """One row per software entry; see :mod:`shelfwright.operators.coverage` for what follows."""
    return coverage.analysis(src.typed(docs, "software"), ["slug", "name"], "formats", "identifiers")


def links(docs: DataFrame) -> DataFrame:
    """``(file, url)`` of every URL of every document, each once per document."""
    return extract_urls(src.readable(docs).select(F.col("path").alias("file"), "doc"), ["file"], "doc")


def link_health(docs: DataFrame, cache: DataFrame, as_of: Column) -> DataFrame:
    """Every link with its verdict; documents that cannot be read count as one broken link each."""
    judged = health.classify_links(links(docs), cache, as_of)
    unreadable = docs.where(F.col("error").isNotNull()).select(
        F.col("path").alias("file"),
        F.lit("(yaml parse error)").alias("url"),
        F.lit(None).cast("int").alias("status"),
        F.lit(False).alias("format_error"),
        F.lit(False).alias("redirected"),
        "error",
        F.lit(False).alias("needs_check"),
        F.lit(True).alias("broken"),
    )
    return judged.unionByName(unreadable)


def changed_documents(base: DataFrame, current: DataFrame) -> DataFrame:
    """Documents that are new or differ from the older snapshot, for checks of what changed only."""
    keys = ["collection", "slug"]
    content = lambda docs: docs.select(*keys, "json", "error")
    changed = cdc.classify(content(base), content(current), keys)
    return current.join(changed.where(F.col("op") != cdc.DELETED), keys, "left_semi")
