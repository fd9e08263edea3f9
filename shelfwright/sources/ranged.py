"""Tables in key ranges, with the first and last key of each file beside them.

``repartitionByRange`` gives each file a range of its own (a hot key goes on by the next columns of the order), and a small
table notes it, so a look-up by key or by prefix opens the files it meets and no other. Files hold what their order says and
are never changed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfwright.sources.manifests import new_name

#: the last key that begins with a prefix, as far as keys are text
LAST = "\U0010ffff"


def write_ranged(df: DataFrame, folder: str, name: str, order: list[str]) -> dict:
    """Write ``df`` in ranges of ``order``; where it lies, for a manifest."""
    path = new_name(folder, name)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    ranges = file_ranges(stored, order[0])
    ranges.coalesce(1).write.parquet(f"{path}-ranges")
    return {"path": path, "ranges": f"{path}-ranges", "schema": df.schema.json()}


def file_ranges(stored: DataFrame, key: str) -> DataFrame:
    """``(file, low, high, n)`` of a table of files.

    The first and last text of a group are found by sorting its rows, so the rows of a key are counted before, by hashing.
    """
    keys = stored.groupBy(F.col("_metadata.file_name").alias("file"), F.col(key).alias("key")).agg(F.count("*").alias("n"))
    return keys.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("n").alias("n"))


def ranges_of(spark: SparkSession, entry: dict) -> DataFrame:
    """``(file, low, high, n)`` of every file."""
    return spark.read.parquet(entry["ranges"])


def read_ranged(spark: SparkSession, entry: dict, spans: list[tuple] | None = None) -> DataFrame:
    """The rows of the table; with ``spans``, of the files whose range meets one of these (first key, last key)."""
    schema = StructType.fromJson(json.loads(entry["schema"]))
    if spans is None:
        return spark.read.schema(schema).parquet(entry["path"])
    meets = F.lit(False)
    for low, high in spans:
        meets = meets | ((F.col("low") <= F.lit(high)) & (F.col("high") >= F.lit(low)))
    names = [r["file"] for r in ranges_of(spark, entry).where(meets).select("file").collect()]  # names of the files to open
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{entry['path']}/{name}" for name in names])


def prefix_span(prefix: str) -> tuple[str, str]:
    return prefix, prefix + LAST
