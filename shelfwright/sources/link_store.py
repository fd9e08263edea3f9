"""The link cache in buckets of URLs, of which an update rewrites those that it touches.

The manifest names the folder of each bucket. New results go to new folders of their buckets; all others stay as they are, and
readers see the whole update or none of it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfwright.operators import health
from shelfwright.session import durable
from shelfwright.sources import manifests

BUCKETS = 256


def _bucket(url: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(count)).cast("int")


def _rows(spark: SparkSession, state: dict, wanted: list[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(state["schema"]))
    paths = [p for b, p in state["buckets"].items() if wanted is None or int(b) in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, folder: str) -> DataFrame | None:
    """All cached results; None where nothing was cached yet."""
    state = manifests.current(folder)
    return _rows(spark, state) if state else None


def look_up(spark: SparkSession, folder: str, urls: DataFrame, as_of: Column) -> DataFrame:
    """``urls`` with their cached results, out of the buckets that these are in."""
    state = manifests.current(folder)
    wanted = urls.select(_bucket(F.col("url"), state["count"]).alias("b")).distinct().collect()  # at most the buckets
    return health.lookup(urls, _rows(spark, state, [r["b"] for r in wanted]), as_of)


def put(folder: str, results: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Take in new results (``url``, ``last_checked``, ``status``, more columns); the buckets that were written."""
    spark = results.sparkSession
    last = manifests.current(folder)
    count = last["count"] if last else buckets
    results = durable(results.where(F.col("url").isNotNull()))
    touched = results.select(_bucket(F.col("url"), count).alias("b")).distinct().collect()  # at most the buckets
    touched = sorted(r["b"] for r in touched)
    if last:
        cache = _rows(spark, last, touched)
    else:
        cache = results.withColumn("ttl_days", health.ttl_days(F.col("status"))).where(F.lit(False))
    new = health.put_results(cache, results).select(*cache.columns)
    path = manifests.new_name(folder, "links")
    new.withColumn("_bucket", _bucket(F.col("url"), count)).repartition("_bucket").write.partitionBy("_bucket").parquet(path)
    kept = last["buckets"] if last else {}
    state = {
        "count": count,
        "schema": last["schema"] if last else cache.schema.json(),
        "buckets": {**kept, **{str(b): f"{path}/_bucket={b}" for b in touched}},
    }
    manifests.commit(folder, state, last)
    return touched
