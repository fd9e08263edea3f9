"""Documents to the published tables, and change-sets between two published snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed, schemas
from shelfwright.functions.keys import child_key
from shelfwright.functions.text import is_blank
from shelfwright.operators import changes as cdc, reshape
from shelfwright.operators.lineage import resolve_parent
from shelfwright.operators.relational import latest_per_key, with_owner
from shelfwright.sources import documents as src
from shelfwright.sources.vocabularies import Vocabulary

_VERSION = {
    "name": "name", "release_date": "releaseDate", "release_date_year_only": "releaseDateYearOnly",
    "pre_release": "preRelease", "unofficial": "unofficial", "url": "url", "description": "description",
}
_PRICE = {"amount": "amount", "currency": "currency"}
_LINK = {
    "type": "type", "title": "title", "url": "url", "video_id": "videoId", "provider": "provider",
    "description": "description",
}
_PORT = {
    "name": "name", "signal_flow": "signalFlow", "category": "category", "type": "type",
    "connection": "connection", "max_connections": "maxConnections", "position": "position",
    "column_position": "columnPosition", "row_position": "rowPosition", "description": "description",
}
_REVISION = {
    "name": "name", "release_date": "releaseDate", "release_date_year_only": "releaseDateYearOnly",
    "url": "url", "description": "description",
}
_FLAGS = {"release_date_year_only", "pre_release", "unofficial"}
_FILLED = {"max_connections": 1}


def _shaped(df: DataFrame, table: str) -> DataFrame:
    """Columns of the published table, in order and type: absent flags are 0, absent counts 1."""
    columns = []
    for field in schemas.table_schema(table):
        value = F.col(field.name)
        if field.name in _FLAGS:
            value = F.coalesce(value, F.lit(False)) if dict(df.dtypes)[field.name] == "boolean" else value
        if field.name in _FILLED:
            value = F.coalesce(value, F.lit(_FILLED[field.name]))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def _with_ids(rows: DataFrame) -> DataFrame:
    """Fail where a document has no id: publishing without one would break every reference to it."""
    problem = F.concat(F.lit("missing id in "), F.col("path"), F.lit("; assign ids first"))
    checked = F.when(is_blank(F.col("id")), F.raise_error(problem)).otherwise(F.col("id"))
    return rows.withColumn("id", checked)


def publish(docs: DataFrame, vocabulary: Vocabulary, version: str, as_of: Column) -> dict[str, DataFrame]:
    """All published tables as DataFrames. ``docs`` is read several times: cache it or store it."""
    spark = docs.sparkSession
    aliases = reshape.alias_map(vocabulary.aliases)
    owners = _with_ids(src.typed(docs, "manufacturers"))
    names = owners.select(
        F.col("slug").alias("_owner"), F.col("id").alias("manufacturer_id"), F.col("name").alias("_owner_name")
    )
    locales = vocabulary.locale_frame(spark)
    approved = src.translations(docs).join(locales.select(F.col("code").alias("locale")), "locale", "left_semi")

    stamped = lambda df: df.withColumn("created_at", as_of).withColumn("updated_at", as_of)
    tables: dict[str, DataFrame] = {}

    parents = resolve_parent(owners, "slug", "parentCompany", "id", "parent_company_id")
    tables["manufacturers"] = stamped(parents.withColumnRenamed("companyName", "company_name"))
    tables["manufacturer_search_terms"] = _list(owners, "manufacturer_id", "searchTerms", "term")
    content = _content(approved, "manufacturers", "manufacturer_id")
    tables["manufacturer_translations"] = content.where(
        ~is_blank(F.col("description")) | ~is_blank(F.col("website"))
    )

    for collection in ("software", "hardware"):
        products = _with_ids(src.typed(docs, collection))
        key = f"{collection}_id"
        conformed = with_owner(products, "manufacturer", names, "_owner").select(
            "*",
            reshape.replace_alias(F.col("categories"), aliases).alias("_categories"),
            *[
                F.coalesce(F.try_element_at(aliases, F.nullif(F.col(c), F.lit(""))), F.nullif(F.col(c), F.lit(""))).alias(f"_{c}")
                for c in ("primaryCategory", "secondaryCategory")
            ],
        )
        tables[collection] = stamped(
            conformed.select(
                "id", "name", "manufacturer_id", "website", "description", "details", "specs",
                F.nullif("supersedes", F.lit("")).alias("supersedes_id"),
                F.col("releaseDate").alias("release_date"),
                F.col("releaseDateYearOnly").alias("release_date_year_only"),
                F.col("_primaryCategory").alias("primary_category"),
                F.col("_secondaryCategory").alias("secondary_category"),
            )
        )
        tables[f"{collection}_categories"] = _list(conformed, key, "_categories", "category")
        tables[f"{collection}_search_terms"] = _list(products, key, "searchTerms", "term")
        for kind, fields in (("versions", _VERSION), ("prices", _PRICE), ("links", _LINK)):
            tables[f"{collection}_{kind}"] = _children(products, key, kind, fields)
        tables[f"{collection}_fts"] = reshape.search_document(
            conformed, "id", "name", "_owner_name", F.col("_categories"), "description"
        )
        content = _content(approved, collection, key)
        tables[f"{collection}_translations"] = content.where(
            ~is_blank(F.col("description")) | ~is_blank(F.col("details"))
            | ~is_blank(F.col("specs")) | ~is_blank(F.col("website"))
        )
        tables[f"{collection}_links_localized"] = _localised_links(approved, collection, key)
        if collection == "software":
            tables["software_formats"] = reshape.with_map_entry(
                products, [F.col("id").alias(key)], F.array_distinct("formats"), F.col("identifiers"), "format", "identifier"
            )
            tables["software_platforms"] = _list(products, key, "platforms", "platform")
        else:
            tables.update(_hardware_parts(products, approved))

    tables["locales"] = locales.withColumn("enabled", F.lit(1))
    tables["category_translations"] = spark.createDataFrame([], schemas.table_schema("category_translations"))
    tables["dataset_meta"] = meta(spark, version, as_of)
    tables["schema_migrations"] = spark.createDataFrame(
        fixed.SCHEMA_MIGRATIONS, "version int, description string, breaking_change int"
    ).withColumn("applied_at", as_of)
    return {name: _shaped(tables[name], name) for name in schemas.TABLES}


def _list(rows: DataFrame, key: str, values: str, name: str) -> DataFrame:
    """Flattened list; an entity holds each value once, as the key of the table demands."""
    return reshape.explode_list(rows, [F.col("id").alias(key)], F.array_compact(F.array_distinct(values)), name)


def _children(rows: DataFrame, key: str, kind: str, fields: dict[str, str]) -> DataFrame:
    keyed = rows.select(F.col("id").alias(key), kind)
    return reshape.explode_children(keyed, key, kind, fields, row_key="id")


def _hardware_parts(products: DataFrame, approved: DataFrame) -> dict[str, DataFrame]:
    ports = _children(products, "hardware_id", "io", _PORT)
    nested = {kind: kind for kind in ("io", "versions", "prices", "links")}
    revisions = _children(products, "hardware_id", "revisions", {**_REVISION, **nested})
    parts = {"hardware_io": ports, "hardware_revisions": revisions}
    for kind, fields in (("io", _PORT), ("versions", _VERSION), ("prices", _PRICE), ("links", _LINK)):
        parts[f"hardware_revision_{kind}"] = _children(revisions, "revision_id", kind, fields)
    known = ports.select("hardware_id", F.col("name").alias("original_name")).distinct()
    named = port_translations(approved).withColumnRenamed("id", "hardware_id")
    named = named.join(known, ["hardware_id", "original_name"], "left_semi")
    # one row per port name and locale; the last one given stands
    last = F.max(F.struct("pos", "translated_name", "translated_description")).alias("_last")
    parts["hardware_io_translations"] = (
        named.groupBy("hardware_id", "locale", "original_name").agg(last).select("*", "_last.*")
    )
    return parts


def port_translations(rows: DataFrame) -> DataFrame:
    """``(collection, slug, id, locale, pos, original_name, …)`` of the translated ports."""
    listed = F.try_variant_get("content", "$.io", f"array<struct<{schemas.PORT_TRANSLATION}>>")
    opened = rows.select("collection", "slug", "id", "locale", F.posexplode(listed).alias("pos", "port"))
    return opened.select(
        "collection", "slug", "id", "locale", "pos",
        F.col("port.originalName").alias("original_name"),
        F.col("port.name").alias("translated_name"),
        F.col("port.description").alias("translated_description"),
    )


def _content(approved: DataFrame, collection: str, key: str) -> DataFrame:
    rows = approved.where(F.col("collection") == collection)
    fields = [
        src.text_at(F.col("content"), f"$.{name}").alias(name)
        for name in ("description", "details", "specs", "website")
    ]
    return rows.select(F.col("id").alias(key), "locale", *fields)


def _localised_links(approved: DataFrame, collection: str, key: str) -> DataFrame:
    links = F.try_variant_get("content", "$.links", f"array<struct<{schemas.LINK}>>")
    rows = approved.where(F.col("collection") == collection).select(
        F.col("id").alias(key), "locale", F.posexplode(links).alias("pos", "child")
    )
    fields = [F.col(f"child.{source}").alias(name) for name, source in _LINK.items()]
    row_key = child_key(F.col(key), F.lit("links"), F.col("locale"), F.col("pos"))
    return rows.select(row_key.alias("id"), key, "locale", *fields)


def meta(spark, version: str, as_of: Column) -> DataFrame:
    stamp = as_of.cast("string")
    entries = F.array(
        F.struct(F.lit("version").alias("key"), F.lit(version).alias("value")),
        F.struct(F.lit("created_at").alias("key"), stamp.alias("value")),
        F.struct(F.lit("updated_at").alias("key"), stamp.alias("value")),
    )
    return spark.range(1).select(F.explode(entries).alias("e")).select("e.*")


def stamp_meta(dataset_meta: DataFrame, version: str, as_of: Column) -> DataFrame:
    """Metadata after a change-set was applied."""
    new = meta(dataset_meta.sparkSession, version, as_of).where(F.col("key") != "created_at")
    both = dataset_meta.withColumn("_at", F.lit(1)).unionByName(new.withColumn("_at", F.lit(2)))
    return latest_per_key(both, "key", ["_at"]).select("key", "value")


# ---------------------------------------------------------------- change-sets

# the columns that name a row, for the tables without an id of their own
ROW_KEYS = {
    "manufacturer_search_terms": ["manufacturer_id", "term"],
    "software_categories": ["software_id", "category"],
    "software_search_terms": ["software_id", "term"],
    "software_formats": ["software_id", "format"],
    "software_platforms": ["software_id", "platform"],
    "hardware_categories": ["hardware_id", "category"],
    "hardware_search_terms": ["hardware_id", "term"],
    "locales": ["code"],
    "category_translations": ["locale", "category_key"],
    "manufacturer_translations": ["manufacturer_id", "locale"],
    "software_translations": ["software_id", "locale"],
    "hardware_translations": ["hardware_id", "locale"],
    "hardware_io_translations": ["hardware_id", "locale", "original_name"],
    "dataset_meta": ["key"],
    "schema_migrations": ["version"],
}
# time stamps say when a row was written, not what it says
NOT_COMPARED = ["created_at", "updated_at", "applied_at"]


def row_keys(table: str) -> list[str]:
    return ROW_KEYS.get(table, ["id"])


def diff_tables(base: dict[str, DataFrame], current: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Operations per table that turn the old snapshot into the new one. Children are rows like any
    other here, so a change of a child alone is a change too."""
    changes = {}
    for table in schemas.TABLES:
        keys = row_keys(table)
        compared = lambda df: df.drop(*NOT_COMPARED)
        ops = cdc.classify(compared(base[table]), compared(current[table]), keys)
        values = [c for c in current[table].columns if c not in keys]
        payload = F.struct(*values) if values else F.struct(F.lit(True).alias("present"))
        changes[table] = cdc.matched(ops, current[table].select(*keys, payload.alias("payload")), keys, "left")
    return changes


def apply_tables(base: dict[str, DataFrame], changes: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: cdc.apply_changes(base[t], changes[t], row_keys(t)) for t in schemas.TABLES}


def change_counts(changes: dict[str, DataFrame]) -> DataFrame:
    """Changes per table and operation, in the order they must be applied."""
    parts = None
    for rank, (table, df) in enumerate(changes.items()):
        counted = df.groupBy("op").agg(F.count("*").alias("changes"))
        row = counted.select(F.lit(rank).alias("rank"), F.lit(table).alias("table"), "op", "changes")
        parts = row if parts is None else parts.unionByName(row)
    return parts.orderBy("rank", "op").drop("rank")
