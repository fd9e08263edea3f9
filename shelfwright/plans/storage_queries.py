"""What is written and read again: document files, snapshots in key ranges, index segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwright.operators import search
from shelfwright.plans import (
    document_queries as packed,
    publish as pub,
    report_queries as reports,
    reports as doc_reports,
    search_queries as plain,
    validate as val,
)
from shelfwright.plans.registry import query
from shelfwright.sources import document_files, documents as src, index_store, link_store, tables as store

_new_folder = packed._new_folder

# ---------------------------------------------------------------- documents as files

_FILES = """
    WITH owners AS (SELECT 'owner-' || s_suppkey AS slug, 'm' || s_suppkey AS id, s_name AS name FROM supplier),
    files AS (SELECT 'unit-' || p_partkey AS slug, 'h' || p_partkey AS id, p_name AS name, p_size AS size,
                'owner-' || (p_partkey % (SELECT count(*) FROM supplier)) AS manufacturer FROM part)
"""


def _documents_from_files(t) -> DataFrame:
    """Suppliers as owners and parts as hardware, a file each: some cannot be parsed, some have a number for an id."""
    n = t.supplier.agg(F.count("*")).scalar()
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    port = lambda name, flow: F.struct(F.lit(name).alias("name"), F.lit(flow).alias("signalFlow"), size.alias("maxConnections"))
    unit = F.struct(
        F.concat(F.lit("h"), key).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("owner-"), (F.col("p_partkey") % n).cast("string")).alias("manufacturer"),
        F.array(F.lit("promo")).alias("categories"),
        F.array(port("in", "input"), port("out", "output")).alias("io"),
    )
    body = F.to_json(unit)
    numbered = F.regexp_replace(body, '"id":"h([0-9]+)"', '"id":$1')
    body = F.when(size % 11 == 0, F.lit("name: [")).when(size % 9 == 0, numbered).otherwise(body)
    units = t.part.select(
        F.lit("hardware").alias("collection"), F.concat(F.lit("unit-"), key).alias("slug"), body.alias("content")
    )
    supplier = F.col("s_suppkey").cast("string")
    owner = F.struct(F.concat(F.lit("m"), supplier).alias("id"), F.col("s_name").alias("name"))
    owners = t.supplier.select(
        F.lit("manufacturers").alias("collection"),
        F.concat(F.lit("owner-"), supplier).alias("slug"),
        F.to_json(owner).alias("content"),
    )
    folder = _new_folder(t, "documents")
    document_files.write_files(owners.unionByName(units), folder)
    return src.store_documents(src.read_documents(t.spark, folder), f"{folder}-parsed")


@query(
    _FILES
    + """
    SELECT 'hardware' AS collection, slug, CASE WHEN size % 11 = 0 THEN 'E110' ELSE 'E199' END AS code
    FROM files WHERE size % 11 = 0 OR size % 9 = 0
    """
)
def file_problems(t):
    docs = _documents_from_files(t)
    found = val.parse_findings(docs).unionByName(val.id_findings(docs), allowMissingColumns=True)
    return found.select("collection", "slug", "code")


@query(
    _FILES
    + """
    SELECT f.id, f.name, o.id AS manufacturer_id FROM files f LEFT JOIN owners o ON f.manufacturer = o.slug
    WHERE size % 11 <> 0 AND size % 9 <> 0
    """
)
def published_hardware(t):
    docs = _documents_from_files(t)
    tables = pub.publish(docs, packed.VOCABULARY, "1", F.lit("2024-01-01").cast("timestamp"))
    return tables["hardware"].select("id", "name", "manufacturer_id").where(F.startswith("id", F.lit("h")))


@query(
    _FILES
    + """
    SELECT id AS hardware_id, unnest(['in', 'out']) AS name, unnest(['input', 'output']) AS signal_flow,
      size::INTEGER AS max_connections
    FROM files WHERE size % 11 <> 0 AND size % 9 <> 0
    """
)
def published_ports(t):
    docs = _documents_from_files(t)
    ports = pub.publish(docs, packed.VOCABULARY, "1", F.lit("2024-01-01").cast("timestamp"))["hardware_io"]
    return ports.select("hardware_id", "name", "signal_flow", "max_connections").where(F.startswith("hardware_id", F.lit("h")))


# ---------------------------------------------------------------- snapshots


@query(
    f"""
    WITH {packed._DOCS}
    SELECT DISTINCT p.id, p.name FROM (SELECT id, name, unnest(categories) AS c FROM products) p
    WHERE c IN ('small', 'economy')
    """
)
def snapshot_look_up(t):
    """Products of a category, out of a stored snapshot: the bridge by its look-up column."""
    tables = packed._published(t)
    folder = _new_folder(t, "published")
    store.write_tables({name: tables[name] for name in ("software", "software_categories")}, folder)
    members = store.look_up(t.spark, folder, "software_categories", "economy")
    products = store.read_tables(t.spark, folder)["software"]
    return products.join(members, F.col("id") == F.col("software_id")).select("id", "name")


# ---------------------------------------------------------------- index segments


def _maintained(t, fields: list[str], build) -> str:
    """An index over all documents that then follows the changes of ``index_maintenance``."""
    documents = t.documents.select("doc_id", "text", "source")
    folder = _new_folder(t, "index")
    index_store.create(build(documents, "doc_id", fields), folder)
    labelled = documents.join(t.labels, "doc_id")
    removed = labelled.where(F.col("quality") == 0)
    changed = labelled.where((F.col("toxic") == 1) & (F.col("quality") != 0)).withColumn(
        "text", F.concat(F.lit("withdrawn "), "text")
    )
    index_store.update(folder, changed, removed, "doc_id", fields, build)
    return folder


_AFTER = """WITH after AS (
      SELECT d.doc_id, d.source, CASE WHEN l.toxic = 1 THEN 'withdrawn ' || d.text ELSE d.text END AS text
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(l.quality, 1) <> 0)"""


@query(
    f"""
    {_AFTER}
    SELECT term, count(*)::BIGINT AS docs FROM (SELECT DISTINCT doc_id, unnest({plain._TOKENS}) AS term FROM after) GROUP BY term
    """
)
def stored_index(t):
    folder = _maintained(t, ["text"], search.plain_postings)
    return index_store.read(t.spark, folder).groupBy("term").agg(F.count("*").alias("docs"))


@query(plain._stemmed_sql().replace("FROM documents", "FROM after").replace("WITH fields", f"{_AFTER},\n    fields", 1))
def stored_index_stemmed(t):
    folder = _maintained(t, ["text", "source"], search.stemmed_postings)
    return index_store.read(t.spark, folder).groupBy("term").agg(F.count("*").alias("docs"))


@query(
    f"""
    {_AFTER},
    held AS (SELECT doc_id, {plain._TOKENS} AS terms FROM after)
    SELECT doc_id FROM held
    WHERE list_contains(terms, 'that') AND len(list_filter(terms, lambda t: starts_with(t, 'wit'))) > 0
    """
)
def stored_index_prefix(t):
    folder = _maintained(t, ["text"], search.plain_postings)
    postings = index_store.read(t.spark, folder, ["that"], "wit")
    return search.matching_docs(postings, ["that", "wit"], prefix=True).withColumnRenamed("doc", "doc_id")


# ---------------------------------------------------------------- the link cache


@query(f"WITH {reports._LATEST} SELECT url, event_id, status, ttl_days FROM latest")
def stored_cache_latest(t):
    """The results of all events, taken in by two updates."""
    folder = _new_folder(t, "links")
    results = reports._results(t)
    for part in (0, 1):
        link_store.put(folder, results.where(F.col("event_id") % 2 == part), buckets=32)
    return link_store.read(t.spark, folder).select("url", "event_id", "status", "ttl_days")


# ---------------------------------------------------------------- incremental reading


@query(
    """
    SELECT 'owner-' || s_suppkey AS slug, s_name || CASE WHEN s_suppkey % 7 = 0 THEN ' renamed' ELSE '' END AS name
    FROM supplier WHERE s_suppkey % 7 = 0
    """
)
def incremental_documents(t):
    """The documents that a second reading finds changed; no other file is opened for it."""
    supplier = F.col("s_suppkey").cast("string")

    def written(rows, name):
        doc = F.struct(F.concat(F.lit("m"), supplier).alias("id"), name.alias("name"))
        files = rows.select(
            F.lit("manufacturers").alias("collection"),
            F.concat(F.lit("owner-"), supplier).alias("slug"),
            F.to_json(doc).alias("content"),
        )
        document_files.write_files(files, folder)

    folder = _new_folder(t, "documents")
    stored = f"{folder}-state"
    written(t.supplier, F.col("s_name"))
    src.refresh(t.spark, folder, stored)
    written(t.supplier.where(F.col("s_suppkey") % 7 == 0), F.concat("s_name", F.lit(" renamed")))
    src.refresh(t.spark, folder, stored)
    old, new = (src.refreshed(t.spark, stored, n) for n in (1, 2))
    changed = doc_reports.changed_documents(old, new)
    return changed.select("slug", F.try_variant_get("doc", "$.name", "string").alias("name"))
