"""Link health over a table of check results, and the cache of those results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions.dates import age_days
from shelfwright.functions.urls import video_url_error
from shelfwright.operators.relational import latest_per_key


def ttl_days(status: Column) -> Column:
    """How long a result stays valid. A NULL status is a failed request."""
    ttl = fixed.TTL_DAYS
    return (
        F.when(status.isNull(), F.lit(ttl["network_error"]))
        .when(status.between(200, 299), F.lit(ttl["success"]))
        .when(status.between(300, 399), F.lit(ttl["redirect"]))
        .when(status.between(400, 499), F.lit(ttl["client_error"]))
        .otherwise(F.lit(ttl["server_error"]))
    )


def is_expired(checked: Column, ttl: Column, as_of: Column) -> Column:
    return age_days(checked, as_of) > ttl


def is_broken(status: Column, format_error: Column | None = None) -> Column:
    """Failed request, bad format, or a status of 400 and above."""
    failed = status.isNull() | (status >= 400)
    return failed if format_error is None else F.coalesce(format_error, F.lit(False)) | failed


def cached_status(status: Column, format_error: Column) -> Column:
    """Status to store: a format error is kept like a failed request."""
    return F.when(~F.coalesce(format_error, F.lit(False)), status)


def outcome(status: Column) -> Column:
    return (
        F.when(status.between(200, 299), F.lit("success"))
        .when(status.between(300, 399), F.lit("redirect"))
        .otherwise(F.lit("error"))
    )


def put_results(cache: DataFrame, results: DataFrame) -> DataFrame:
    """Cache after new results came in: the latest check per URL, with its time to live."""
    stamped = results.withColumn("ttl_days", ttl_days(F.col("status")))
    return latest_per_key(cache.unionByName(stamped), "url", ["last_checked"])


def prune(cache: DataFrame, as_of: Column) -> DataFrame:
    return cache.where(~is_expired(F.col("last_checked"), F.col("ttl_days"), as_of))


def lookup(urls: DataFrame, cache: DataFrame, as_of: Column) -> DataFrame:
    """URLs with their latest cached result; ``needs_check`` where there is none that is still valid."""
    latest = latest_per_key(cache, "url", ["last_checked"])
    fresh = prune(latest, as_of).withColumn("_hit", F.lit(True))
    joined = urls.join(fresh, "url", "left")
    return joined.withColumn("needs_check", F.col("_hit").isNull()).drop("_hit")


def broken(cache: DataFrame, as_of: Column) -> DataFrame:
    return prune(latest_per_key(cache, "url", ["last_checked"]), as_of).where(is_broken(F.col("status")))


def cache_stats(cache: DataFrame, as_of: Column) -> DataFrame:
    expired = is_expired(F.col("last_checked"), F.col("ttl_days"), as_of)
    kind = outcome(F.col("status"))
    return cache.agg(
        F.count("*").alias("total_entries"),
        F.count_if(~expired & (kind == "success")).alias("success_count"),
        F.count_if(~expired & (kind == "error")).alias("error_count"),
        F.count_if(~expired & (kind == "redirect")).alias("redirect_count"),
        F.count_if(expired).alias("expired_count"),
    )


def classify_links(links: DataFrame, cache: DataFrame, as_of: Column) -> DataFrame:
    """One row per document and URL with its verdict.

    The format test comes first and needs no request; every distinct URL is looked up once and the
    result is joined back to the documents that use it.
    """
    used = links.select("file", "url").distinct()
    checked = lookup(used.select("url").distinct(), cache, as_of)
    error = video_url_error(F.col("url"))
    bad_format = error.isNotNull()
    return used.join(checked, "url").select(
        "file",
        "url",
        F.when(~bad_format, F.col("status")).alias("status"),
        bad_format.alias("format_error"),
        (~bad_format & F.col("redirects_to").isNotNull()).alias("redirected"),
        F.coalesce(error, F.col("error_message")).alias("error"),
        (~bad_format & F.col("needs_check")).alias("needs_check"),
        (bad_format | (~F.col("needs_check") & is_broken(F.col("status")))).alias("broken"),
    )


def link_stats(classified: DataFrame) -> DataFrame:
    """Files, URLs, broken and redirected ones; a broken redirect counts as broken only."""
    return classified.agg(
        F.count_distinct("file").alias("files_checked"),
        F.count("*").alias("urls_checked"),
        F.count_if("broken").alias("broken"),
        F.count_if(~F.col("broken") & F.col("redirected")).alias("redirected"),
    )
