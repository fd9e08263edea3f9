"""Term search over text fields, with and without a stored index.

A posting is one row ``(term, doc, field)``; each document contributes each term once per field, so
building the index needs no shuffle. Relevance is never asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright.functions.stemming import fold, search_forms, stem
from shelfwright.functions.text import has_token, token_list, tokens

BUCKETS = 256


def has_all_terms(text: Column, terms: list[str]) -> Column:
    """Every term occurs somewhere in the text: a scan, without an index and without a shuffle."""
    return reduce(lambda found, term: found & has_token(text, term), terms, F.lit(True))


def has_prefix(text: Column, prefix: str) -> Column:
    return has_token(text, prefix, prefix=True)


def plain_postings(docs: DataFrame, doc: str, fields: list[str]) -> DataFrame:
    """``(term, doc, field)`` of the tokens as they are."""
    per_field = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.array_distinct(tokens(F.col(f))).alias("terms"))
            for f in fields
        ]
    )
    return (
        docs.select(F.col(doc).alias("doc"), F.explode(per_field).alias("part"))
        .select("doc", "part.field", F.explode("part.terms").alias("term"))
        .select("term", "doc", "field")
    )


def stemmed_postings(docs: DataFrame, doc: str, fields: list[str]) -> DataFrame:
    """Postings by search form. Distinct tokens of a row go through one Arrow function and come back as
    distinct forms, so nothing is shuffled."""
    per_field = F.array(
        *[
            F.struct(F.lit(f).alias("field"), search_forms(F.array_distinct(tokens(F.col(f)))).alias("terms"))
            for f in fields
        ]
    )
    return (
        docs.select(F.col(doc).alias("doc"), F.explode(per_field).alias("part"))
        .select("doc", "part.field", F.explode("part.terms").alias("term"))
        .select("term", "doc", "field")
    )


def query_terms(text: str, stemmed: bool = True) -> list[str]:
    """The terms of a query, in the form that a stemmed or a plain index holds them."""
    return [stem(fold(word)) if stemmed else word for word in token_list(text)]


def write_index(postings: DataFrame, path: str) -> None:
    """Store postings by term bucket, in balanced ranges of bucket, term and document: a word found
    everywhere is spread over many tasks, rare ones share a file."""
    bucketed = postings.withColumn("bucket", _bucket(F.col("term")))
    ranged = bucketed.repartitionByRange("bucket", "term", "doc").sortWithinPartitions("bucket", "term")
    ranged.write.mode("overwrite").partitionBy("bucket").parquet(path)


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def matching_docs(postings: DataFrame, terms: list[str], prefix: bool = False) -> DataFrame:
    """Documents that hold all terms, in whatever fields. With ``prefix`` the last term is the start of a token."""
    exact, start = (terms[:-1], terms[-1]) if prefix else (terms, None)
    exact = sorted(set(exact))
    wanted = F.col("term").isin(exact)
    if start is not None:
        wanted = wanted | F.startswith("term", F.lit(start))
    elif "bucket" in postings.columns:  # a stored index: read the folders of these terms only
        wanted = wanted & F.col("bucket").isin([_bucket(F.lit(term)) for term in exact])
    # a term that is asked for and also starts with the prefix counts for both
    asked = F.array_compact(
        F.array(
            F.when(F.col("term").isin(exact), F.col("term")),
            F.when(F.startswith("term", F.lit(start)), F.lit("")) if start is not None else F.lit(None).cast("string"),
        )
    )
    hits = postings.where(wanted).select("doc", F.explode(asked).alias("asked")).distinct()
    return (
        hits.groupBy("doc")
        .agg(F.count("*").alias("_terms"))
        .where(F.col("_terms") == len(exact) + (start is not None))
        .select("doc")
    )


def replace_docs(
    postings: DataFrame, changed: DataFrame, removed: DataFrame, doc: str, fields: list[str], build=plain_postings
) -> DataFrame:
    """Postings after some documents changed and others went away; the rest is left alone. ``build`` is what
    built the index, ``plain_postings`` or ``stemmed_postings``; a stored index keeps its buckets."""
    touched = changed.select(F.col(doc).alias("doc")).unionByName(
        removed.select(F.col(doc).alias("doc"))
    )
    kept = postings.join(touched.distinct(), "doc", "left_anti")
    new = build(changed, doc, fields)
    if "bucket" in postings.columns:
        new = new.withColumn("bucket", _bucket(F.col("term")))
    return kept.unionByName(new.select(*kept.columns))
