"""A stored term index that is kept up to date in segments.

A segment holds the postings of some documents in ranges of terms, and the ids of the documents that it replaces or removes. The
first holds everything; an update writes one for the documents that changed, and touches no other file. A reader takes a
posting if no later segment names its document. Terms and prefixes open only the files whose range of terms they meet.

When the later segments have grown to a share of the first one, ``compact`` writes everything anew; before that it only
joins the later ones to a single one. Documents without an id cannot be replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwright.operators.search import plain_postings
from shelfwright.sources import manifests, ranged

ORDER = ["term", "doc", "field"]
SHARE = 0.25  # of the first segment's postings


def _rows(spark: SparkSession, entry: dict) -> int:
    return ranged.ranges_of(spark, entry).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]


def _segment(folder: str, postings: DataFrame, gone: DataFrame | None) -> dict:
    spark = postings.sparkSession
    data = ranged.write_ranged(postings.select(*ORDER), folder, "postings", ORDER)
    found = {"data": data, "rows": _rows(spark, data), "gone": None}
    if gone is not None:
        found["gone"] = manifests.new_name(folder, "gone")
        gone.select("doc").where(F.col("doc").isNotNull()).distinct().write.parquet(found["gone"])
    return found


def create(postings: DataFrame, folder: str) -> dict:
    """Store postings ``(term, doc, field)`` as a new index, or in place of the one in the folder."""
    return manifests.commit(folder, {"segments": [_segment(folder, postings, None)]}, manifests.current(folder))


def update(folder: str, changed: DataFrame, removed: DataFrame, doc: str, fields: list[str], build=plain_postings) -> dict:
    """Add a segment with the postings of ``changed`` documents; theirs and those of ``removed`` before it count no more.
    ``build`` is what built the index."""
    last = manifests.current(folder)
    touched = changed.select(F.col(doc).alias("doc")).unionByName(removed.select(F.col(doc).alias("doc")))
    segments = [*last["segments"], _segment(folder, build(changed, doc, fields), touched)]
    return manifests.commit(folder, {"segments": segments}, last)


def _gone(spark: SparkSession, segments: list[dict]) -> DataFrame | None:
    """``(doc, _since)``: the last segment that names each document."""
    parts = [
        spark.read.parquet(s["gone"]).select("doc", F.lit(i).alias("_since")) for i, s in enumerate(segments) if s["gone"]
    ]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).groupBy("doc").agg(F.max("_since").alias("_since"))


def _alive(spark: SparkSession, segments: list[dict], spans: list[tuple] | None = None) -> DataFrame:
    parts = [
        ranged.read_ranged(spark, s["data"], spans).withColumn("_segment", F.lit(i)) for i, s in enumerate(segments)
    ]
    postings = reduce(DataFrame.unionByName, parts)
    gone = _gone(spark, segments)
    if gone is not None:
        postings = postings.join(gone, "doc", "left").where(
            F.col("_since").isNull() | (F.col("_segment") >= F.col("_since"))
        )
    return postings.select(*ORDER)


def read(spark: SparkSession, folder: str, terms: list[str] | None = None, prefix: str | None = None) -> DataFrame:
    """The postings ``(term, doc, field)`` of the index; with ``terms`` or ``prefix`` those of these terms alone."""
    segments = manifests.current(folder)["segments"]
    if terms is None and prefix is None:
        return _alive(spark, segments)
    spans = [(t, t) for t in sorted(set(terms or []))] + ([ranged.prefix_span(prefix)] if prefix is not None else [])
    wanted = F.col("term").isin(sorted(set(terms or [])))
    if prefix is not None:
        wanted = wanted | F.startswith("term", F.lit(prefix))
    return _alive(spark, segments, spans).where(wanted)


def compact(spark: SparkSession, folder: str, share: float = SHARE) -> dict:
    """Fewer segments with the same postings."""
    last = manifests.current(folder)
    first, *later = last["segments"]
    if not later:
        return last
    if sum(s["rows"] for s in later) >= share * first["rows"]:
        segments = [_segment(folder, _alive(spark, last["segments"]), None)]
    elif len(later) > 1:
        named = reduce(DataFrame.unionByName, [spark.read.parquet(s["gone"]) for s in later])
        segments = [first, _segment(folder, _alive(spark, later), named)]
    else:
        return last
    return manifests.commit(folder, {"segments": segments}, last)
