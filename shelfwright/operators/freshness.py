"""How long ago entries and prices were verified."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions.dates import instant, whole_days
from shelfwright.functions.text import is_blank

NEVER, MALFORMED, STALE, FRESH = "never", "malformed", "stale", "fresh"


def freshness(date: Column, as_of: Column, limit_days: int) -> tuple[Column, Column]:
    """``(bucket, age in days)`` of a date given as text. A date that cannot be read is malformed;
    one in the future has a negative age and is fresh."""
    age = whole_days(instant(date), as_of)
    bucket = (
        F.when(is_blank(date), F.lit(NEVER))
        .when(instant(date).isNull(), F.lit(MALFORMED))
        .when(age > limit_days, F.lit(STALE))
        .otherwise(F.lit(FRESH))
    )
    return bucket, F.when(~is_blank(date), age)


def entry_freshness(
    df: DataFrame, keys: list[str], date: str, status: str, as_of: Column,
    limit_days: int = fixed.ENTRY_STALE_DAYS,
) -> DataFrame:
    bucket, age = freshness(F.col(date), as_of, limit_days)
    return df.select(
        *keys,
        bucket.alias("bucket"),
        age.alias("age_days"),
        F.coalesce(F.col(status) == "discontinued", F.lit(False)).alias("discontinued"),
    )


def price_freshness(
    prices: DataFrame, keys: list[str], date: str, as_of: Column,
    limit_days: int = fixed.PRICE_STALE_DAYS,
) -> DataFrame:
    """One row per price."""
    bucket, age = freshness(F.col(date), as_of, limit_days)
    return prices.select(*keys, "amount", "currency", bucket.alias("bucket"), age.alias("age_days"))


def freshness_summary(entries: DataFrame, prices: DataFrame) -> DataFrame:
    """The seven counters as one row."""

    def part(df: DataFrame, kind: str) -> DataFrame:
        flag = F.col("discontinued") if kind == "entry" else F.lit(False)
        return df.select(F.lit(kind).alias("kind"), "bucket", flag.alias("discontinued"))

    both = part(entries, "entry").unionByName(part(prices, "price"))
    is_entry, is_price = F.col("kind") == "entry", F.col("kind") == "price"
    bucket = F.col("bucket")
    return both.agg(
        F.count_if(is_entry).alias("total_entries"),
        F.count_if(is_entry & (bucket == NEVER)).alias("never_verified"),
        F.count_if(is_entry & (bucket == STALE)).alias("stale_entries"),
        F.count_if(is_price & (bucket == STALE)).alias("stale_prices"),
        F.count_if(is_price & (bucket == NEVER)).alias("never_priced"),
        F.count_if(is_entry & F.col("discontinued")).alias("discontinued"),
        F.count_if(bucket == MALFORMED).alias("malformed_dates"),
    )
