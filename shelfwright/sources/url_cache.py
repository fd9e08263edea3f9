"""Stored results of link checks: a table of JSON lines with a format version in every row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwright import fixed_values as fixed

SCHEMA = (
    "url string, last_checked timestamp, status int, redirects_to string, error_message string, "
    "ttl_days double"
)
_STORED = SCHEMA + ", version int, last_updated timestamp, _broken string"


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cached checks; rows of another version or that cannot be read are not there, and neither is
    anything when there is no cache."""
    try:
        stored = (
            spark.read.schema(_STORED)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_broken")
            .json(path)
        )
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    usable = (F.col("version") == fixed.URL_CACHE_VERSION) & F.col("_broken").isNull()
    return stored.where(usable & F.col("url").isNotNull()).select(*names)


def write_cache(cache: DataFrame, path: str, as_of: Column) -> None:
    """Save the cache with its version and the time of the update. ``path`` must be a new folder:
    the cache being saved may still be read from the old one."""
    stamped = cache.withColumn("version", F.lit(fixed.URL_CACHE_VERSION)).withColumn("last_updated", as_of)
    stamped.write.mode("error").json(path)
