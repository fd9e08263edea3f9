"""Source documents: one file per entity, in one directory per collection."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwright import fixed_values as fixed, schemas
from shelfwright.session import durable
from shelfwright.sources import document_files, manifests

_PARSED = "collection string, slug string, path string, json string, error string"


# The plain scalars of the YAML 1.2 core schema; everything else is text.
_SCALARS = {
    "null": (r"^(?:~|null|Null|NULL|)$", ["~", "n", "N", ""]),
    "bool": (r"^(?:true|True|TRUE|false|False|FALSE)$", list("tTfF")),
    "int": (r"^(?:[-+]?[0-9]+|0o[0-7]+|0x[0-9a-fA-F]+)$", list("-+0123456789")),
    "float": (
        r"^(?:[-+]?(?:\.[0-9]+|[0-9]+(?:\.[0-9]*)?)(?:[eE][-+]?[0-9]+)?)$",
        list("-+.0123456789"),
    ),
}


def _loader():
    """Safe loader that keeps dates and yes/no as text and takes a key given twice as an error."""
    base = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

    class Loader(base):
        pass

    Loader.yaml_implicit_resolvers = {}
    for name, (pattern, first) in _SCALARS.items():
        Loader.add_implicit_resolver(f"tag:yaml.org,2002:{name}", re.compile(pattern), first)

    def integer(loader, node):
        body = loader.construct_scalar(node)
        return int(body, 0) if body[:2] in ("0o", "0x") else int(body)

    def mapping(loader, node):
        keys = [str(loader.construct_object(key, deep=True)) for key, _ in node.value]
        seen = set()
        for key, (key_node, _) in zip(keys, node.value):
            if key in seen or seen.add(key):
                raise yaml.constructor.ConstructorError(
                    None, None, f"duplicate key {key!r}", key_node.start_mark
                )
        return {
            key: loader.construct_object(value, deep=True) for key, (_, value) in zip(keys, node.value)
        }

    Loader.add_constructor("tag:yaml.org,2002:int", integer)
    Loader.add_constructor("tag:yaml.org,2002:map", mapping)
    return Loader


# An object on one line, without escapes and without what YAML takes for a line break, a mark or no character.
_ONE_LINE = re.compile(
    "\\{[ -\\[\\]-~\u00a0-\u2027\u202a-\ud7ff\ue000-\ufefe\uff00-\ufffd\U00010000-\U0010ffff]*\\}"
)
_MOST_OPEN = 64  # brackets, so that neither parser meets its own limit of depth
_LONGEST_KEY = 255  # characters; YAML ends at 1024


def _object(pairs: list[tuple]) -> dict:
    held = dict(pairs)
    if len(held) < len(pairs) or max(map(len, held), default=0) > _LONGEST_KEY:
        raise ValueError("left to the YAML parser")
    return held


def _no_number(name: str):
    raise ValueError(f"{name} is text in YAML")


_JSON = json.JSONDecoder(object_pairs_hook=_object, parse_constant=_no_number)


def _from_json(content: str):
    """The value of a document that is JSON and means the same in YAML, several times as fast; None for any other."""
    if not _ONE_LINE.fullmatch(content) or content.count("{") + content.count("[") > _MOST_OPEN:
        return None
    try:
        return _JSON.decode(content)
    except ValueError:
        return None


def _to_json(content: str | bytes, loader) -> tuple[str | None, str | None]:
    try:
        if not isinstance(content, str):
            content = bytes(content).decode("utf-8", errors="replace")
        value = _from_json(content)
        if value is None:
            value = yaml.load(content, Loader=loader)
        return json.dumps(value, ensure_ascii=False, allow_nan=False), None
    except Exception as problem:  # whatever is wrong with a document becomes a finding
        return None, " ".join(str(problem).split()) or type(problem).__name__


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    loader = _loader()
    for batch in batches:
        unread = batch["problem"].notna()
        parsed = [
            (None, problem) if failed else _to_json(content, loader)
            for content, problem, failed in zip(batch["content"], batch["problem"], unread)
        ]
        out = batch.drop(columns=["content", "problem"])
        out["json"] = [p[0] for p in parsed]
        out["error"] = [p[1] for p in parsed]
        yield out


def read_raw(spark: SparkSession, root: str, collections: list[str] = fixed.COLLECTIONS) -> DataFrame:
    """``(collection, slug, path, content, problem)``; a collection without a directory has no rows."""
    return document_files.read_files(spark, root, collections)


def parse(raw: DataFrame) -> DataFrame:
    """Documents as JSON text and VARIANT; one that cannot be read keeps its error instead."""
    if "problem" not in raw.columns:
        raw = raw.withColumn("problem", F.lit(None).cast("string"))
    columns = ["collection", "slug", "path", "content", "problem"]
    parsed = raw.select(*columns).mapInPandas(_parse_batches, _PARSED)
    return parsed.withColumn("doc", F.try_parse_json("json"))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    return parse(read_raw(spark, root))


def store_documents(docs: DataFrame, path: str) -> DataFrame:
    """Write parsed documents by collection and read them from there: every plan over them scans the
    documents several times, and the folder of a collection is all that a plan for it has to read."""
    docs.write.mode("overwrite").partitionBy("collection").parquet(path)
    stored = docs.sparkSession.read.schema(docs.schema).parquet(path)
    return stored.select(*docs.columns)


def refresh(spark: SparkSession, root: str, folder: str, collections: list[str] = fixed.COLLECTIONS) -> dict:
    """Bring the parsed documents in ``folder`` up to date with the files below ``root``; the new manifest.

    A file of the same size and time of change is not opened; one that was only touched is read and compared by its content's
    hash; the others are parsed. ``read`` and ``parsed`` count them. ``refreshed`` gives the documents.
    """
    last = manifests.current(folder)
    listed = durable(document_files.listing(spark, root, collections))
    known = spark.read.schema(_STATE).parquet(last["path"]) if last else spark.createDataFrame([], _STATE)
    name = ["collection", "name"]
    kept = known.join(listed, [*name, "size", "changed"], "left_semi")
    asked = listed.join(kept.select(*name), name, "left_anti").repartition(*name)
    raw = document_files.read_named(asked, root)
    raw = raw.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("hash", F.sha2("content", 256))
    raw = durable(raw.join(asked, name))
    same = known.select(*name, "hash", "json", "error")
    touched = raw.join(same, [*name, "hash"]).select(*kept.columns)
    new = raw.join(same, [*name, "hash"], "left_anti")
    parsed = parse(new).drop("doc").withColumn("name", F.element_at(F.split("path", "/"), -1))
    parsed = parsed.join(new.select(*name, "size", "changed", "hash"), name).select(*kept.columns)
    path = manifests.new_name(folder, "documents")
    kept.unionByName(touched).unionByName(parsed).write.partitionBy("collection").parquet(path)
    return manifests.commit(folder, {"path": path, "read": raw.count(), "parsed": new.count()}, last)


_STATE = "name string, slug string, path string, size long, changed long, hash string, json string, error string, collection string"


def refreshed(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    """The documents of the last refresh, or of the one with a number."""
    stored = spark.read.schema(_STATE).parquet(manifests.current(folder, number)["path"])
    return stored.select("collection", "slug", "path", "json", "error", F.try_parse_json("json").alias("doc"))


def readable(docs: DataFrame) -> DataFrame:
    """Documents that could be read; the others are left to the findings."""
    return docs.where(F.col("error").isNull() & F.schema_of_variant("doc").startswith("OBJECT"))


def text_at(doc: Column, path: str) -> Column:
    """Text at a path; a list of paragraphs is joined by blank lines."""
    node = F.try_variant_get(doc, path, "variant")
    as_list = F.array_join(F.try_variant_get(doc, path, "array<string>"), "\n\n")
    return F.when(F.startswith(F.schema_of_variant(node), F.lit("ARRAY")), as_list).otherwise(
        F.try_variant_get(doc, path, "string")
    )


def typed(docs: DataFrame, collection: str) -> DataFrame:
    """The documents of one collection with their fields as columns."""
    rows = readable(docs).where(F.col("collection") == collection)
    fields = F.from_json("json", schemas.DOCUMENTS[collection])
    texts = [text_at(F.col("doc"), f"$.{name}").alias(name) for name in schemas.TEXTS[collection]]
    return rows.select("collection", "slug", "path", "doc", fields.alias("_f"), *texts).select(
        "collection", "slug", "path", "doc", "_f.*", *schemas.TEXTS[collection]
    )


def translations(docs: DataFrame) -> DataFrame:
    """``(collection, slug, id, locale, content)`` with one row per document and locale."""
    held = F.try_variant_get("doc", "$.translations", "variant")
    rows = readable(docs).select(
        "collection", "slug", F.try_variant_get("doc", "$.id", "string").alias("id"), held.alias("held")
    )
    rows = rows.where(F.startswith(F.schema_of_variant("held"), F.lit("OBJECT")))
    opened = rows.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("held").outer()))
    return opened.select(
        "collection", "slug", "id", F.col("key").alias("locale"), F.col("value").alias("content")
    )


def owner_ids(docs: DataFrame) -> DataFrame:
    """``(slug, id)`` of the manufacturers that have an id."""
    id_ = F.try_variant_get("doc", "$.id", "string")
    owners = readable(docs).where(F.col("collection") == "manufacturers").select("slug", id_.alias("id"))
    return owners.where(F.coalesce("id", F.lit("")) != "")
