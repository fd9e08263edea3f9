"""Publish and validate over documents packed from the tables: suppliers as owners, parts as products."""

import uuid

from pyspark.sql import functions as F

from shelfwright.operators import findings as fd
from shelfwright.plans import publish as pub, validate as val
from shelfwright.plans.registry import query
from shelfwright.session import shared_folder, spread
from shelfwright.sources import documents as src
from shelfwright.sources.vocabularies import Vocabulary

VOCABULARY = Vocabulary(
    categories=("economy", "standard", "promo"), aliases={"small": "economy"}, formats=("au", "clap"), platforms=("mac",)
)

_DOCS = """
    owners AS (SELECT 'owner-' || s_suppkey AS slug, 'm' || s_suppkey AS id, s_name AS name FROM supplier),
    n AS (SELECT count(*) AS n FROM supplier),
    products AS (
      SELECT 'part-' || p_partkey AS slug, 'p' || p_partkey AS id, p_name AS name,
        CASE WHEN p_size % 10 > 0 THEN 'owner-' || (p_partkey % n) ELSE 'owner-' || (p_partkey + 1000000) END AS manufacturer,
        [lower(p_type), 'promo', CASE WHEN p_size % 3 = 0 THEN 'promo' ELSE 'small' END] AS categories,
        [CASE WHEN p_size % 2 = 0 THEN 'au' ELSE 'clap' END, 'au'] AS formats,
        CASE WHEN p_size % 7 = 0 THEN 'p' || (p_partkey * 2) ELSE 'p0' END AS supersedes
      FROM part, n)
"""


def _new_folder(t, name: str) -> str:
    return f"{shared_folder(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _documents(t):
    """The packed documents, read by the library's own parser: by all tasks, however few files the tables are, and once."""
    n = t.supplier.agg(F.count("*")).scalar()
    key, size = F.col("p_partkey"), F.col("p_size")
    own = F.when(size % 10 > 0, key % n).otherwise(key + 1000000)
    product = F.struct(
        F.concat(F.lit("p"), key.cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("owner-"), own.cast("string")).alias("manufacturer"),
        F.array(F.lower("p_type"), F.lit("promo"), F.when(size % 3 == 0, "promo").otherwise("small")).alias("categories"),
        F.array(F.when(size % 2 == 0, "au").otherwise("clap"), F.lit("au")).alias("formats"),
        F.concat(F.lit("p"), F.when(size % 7 == 0, key * 2).otherwise(F.lit(0)).cast("string")).alias("supersedes"),
    )
    owner = F.struct(F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))

    def packed(df, collection, slug, doc):
        return df.select(
            F.lit(collection).alias("collection"),
            slug.alias("slug"),
            F.concat(F.lit(f"{collection}/"), slug).alias("path"),
            F.encode(F.to_json(doc), "UTF-8").alias("content"),
        )

    products = packed(t.part, "software", F.concat(F.lit("part-"), key.cast("string")), product)
    owners = packed(t.supplier, "manufacturers", F.concat(F.lit("owner-"), F.col("s_suppkey").cast("string")), owner)
    parsed = src.parse(spread(owners.unionByName(products), "collection", "slug"))
    return src.store_documents(parsed, _new_folder(t, "packed"))


def _published(t):
    return pub.publish(_documents(t), VOCABULARY, "1", F.lit("2024-01-01").cast("timestamp"))


@query(f"WITH {_DOCS} SELECT id, name, NULL::VARCHAR AS parent_company_id FROM owners")
def published_owners(t):
    return _published(t)["manufacturers"].select("id", "name", "parent_company_id")


@query(
    f"""
    WITH {_DOCS}
    SELECT p.id, p.name, o.id AS manufacturer_id, p.supersedes AS supersedes_id
    FROM products p LEFT JOIN owners o ON p.manufacturer = o.slug
    """
)
def published_products(t):
    return _published(t)["software"].select("id", "name", "manufacturer_id", "supersedes_id")


@query(
    f"""
    WITH {_DOCS}
    SELECT DISTINCT id AS software_id, CASE WHEN c = 'small' THEN 'economy' ELSE c END AS category
    FROM (SELECT id, unnest(categories) AS c FROM products)
    """
)
def published_categories(t):
    return _published(t)["software_categories"].select("software_id", "category")


@query(f"WITH {_DOCS} SELECT DISTINCT id AS software_id, unnest(formats) AS format FROM products")
def published_formats(t):
    return _published(t)["software_formats"].select("software_id", "format")


@query(
    f"""
    WITH {_DOCS},
    used AS (SELECT slug, generate_subscripts(categories, 1)::INTEGER - 1 AS i, unnest(categories) AS c FROM products),
    found AS (
      SELECT slug, 2 AS tier, 'E104' AS code FROM used WHERE c NOT IN ('economy', 'standard', 'promo', 'small')
      UNION ALL SELECT slug, 3, 'E200' FROM products WHERE manufacturer NOT IN (SELECT slug FROM owners)
      UNION ALL SELECT slug, 4, 'E199' FROM products WHERE supersedes NOT IN (SELECT id FROM products)
      UNION ALL SELECT slug, 5, 'E202' FROM (SELECT *, row_number() OVER (
        PARTITION BY slug, CASE WHEN c = 'small' THEN 'economy' ELSE c END ORDER BY i) AS k FROM used) WHERE k > 1)
    SELECT 'software' AS collection, slug, tier, code, count(*)::BIGINT AS findings
    FROM (SELECT *, min(tier) OVER (PARTITION BY slug) AS first FROM found) WHERE tier = first GROUP BY slug, tier, code
    """
)
def validated_documents(t):
    """The first failing tier of each document; cycles, which stand outside the tiers, are left to their own query."""
    found = val.validate(_documents(t), VOCABULARY).where(F.col("tier") != fd.OUTSIDE_TIERS)
    return found.groupBy("collection", "slug", "tier", "code").agg(F.count("*").alias("findings"))
