"""Snapshots of the orders and what changed between them.

The older snapshot lacks the newest orders, the newer one has dropped the oldest, and urgent orders
that are still pending have a new price.
"""

from pyspark.sql import functions as F

from shelfwright.functions import text
from shelfwright.operators import changes as cdc, relational as rel
from shelfwright.plans.reference_queries import _IDS, documents_with_ids
from shelfwright.plans.registry import query

KEY = ["o_orderkey"]
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

_SNAPSHOTS = """
    WITH base AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
      FROM orders WHERE o_orderdate < '2001-01-01'),
    cur AS (
      SELECT o_orderkey, o_custkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
             o_orderpriority
      FROM orders WHERE o_orderdate >= '1995-07-01'),
    diff AS (
      SELECT coalesce(b.o_orderkey, c.o_orderkey) AS o_orderkey,
             CASE WHEN b.o_orderkey IS NULL THEN 'added' WHEN c.o_orderkey IS NULL THEN 'deleted' ELSE 'modified' END AS op
      FROM base b FULL OUTER JOIN cur c ON b.o_orderkey = c.o_orderkey
      WHERE b.o_orderkey IS NULL OR c.o_orderkey IS NULL OR b.o_totalprice <> c.o_totalprice)
"""


def base(t):
    return t.orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")).select(*COLUMNS)


def current(t):
    repriced = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    price = F.when(repriced, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = t.orders.where(F.col("o_orderdate") >= F.lit("1995-07-01").cast("timestamp_ntz"))
    return kept.withColumn("o_totalprice", price).select(*COLUMNS)


@query(_SNAPSHOTS + "SELECT o_orderkey, op FROM diff")
def snapshot_diff(t):
    return cdc.classify(base(t), current(t), KEY)


@query(_SNAPSHOTS + "SELECT op, count(*)::BIGINT AS changes FROM diff GROUP BY op")
def change_counts(t):
    return rel.count_by(cdc.classify(base(t), current(t), KEY), "op", "changes")


@query(_SNAPSHOTS + "SELECT * FROM cur")
def apply_changes(t):
    changes = cdc.change_set(base(t), current(t), KEY)
    return cdc.apply_changes(base(t), changes, KEY)


_LINES = "l_orderkey AS o_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    _SNAPSHOTS
    + f"""
    SELECT {_LINES}, CASE WHEN l_orderkey IN (SELECT o_orderkey FROM diff) THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
    FROM lineitem
    """
)
def child_replace(t):
    children = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    new = children.withColumn("l_quantity", F.col("l_quantity") + 1)
    touched = cdc.classify(base(t), current(t), KEY)
    return cdc.replace_children(children, new, touched, "o_orderkey")


@query(
    _SNAPSHOTS
    + f"""
    SELECT {_LINES} FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM diff WHERE op = 'deleted')
    """
)
def cascade_delete(t):
    children = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey"
    )
    deleted = cdc.classify(base(t), current(t), KEY).where(F.col("op") == cdc.DELETED)
    return cdc.cascade_delete(children, deleted, "o_orderkey")


@query(
    _SNAPSHOTS
    + """
    SELECT b.o_orderkey, b.o_custkey::VARCHAR AS old_id, (c.o_custkey + 1)::VARCHAR AS new_id
    FROM base b JOIN cur c ON b.o_orderkey = c.o_orderkey WHERE c.o_orderpriority = '3-MEDIUM'
    """
)
def id_immutability(t):
    moved = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_custkey") + 1)
    old = base(t).select("o_orderkey", F.col("o_custkey").cast("string").alias("id"))
    new = current(t).select("o_orderkey", F.coalesce(moved, "o_custkey").cast("string").alias("id"))
    return cdc.changed_ids(old, new, KEY, "id")


@query(
    _SNAPSHOTS
    + """
    SELECT d.o_orderkey, b.o_custkey FROM diff d JOIN base b ON b.o_orderkey = d.o_orderkey WHERE d.op = 'deleted'
    """
)
def deleted_ids(t):
    changes = cdc.classify(base(t), current(t), KEY)
    return cdc.deleted_ids(base(t), changes, KEY, "o_custkey")


@query(
    """
    WITH named AS (SELECT 'customer' AS collection, c_custkey AS id, c_name AS slug FROM customer
                   UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier)
    SELECT collection, id, 'modified' AS op, CASE collection WHEN 'supplier' THEN 1 ELSE 2 END AS apply_rank
    FROM named WHERE collection = 'supplier' OR id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """
)
def change_order(t):
    """Renamed owners come before renamed customers; by id a rename is a modification."""
    building = F.col("c_mktsegment") == "BUILDING"
    new_name = F.when(building, F.upper("c_name")).otherwise(F.col("c_name"))

    def snapshot(customer_name, supplier_name):
        customers = t.customer.select(F.col("c_custkey").alias("id"), customer_name.alias("slug"))
        suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), supplier_name.alias("slug"))
        return rel.union_collections(customer=customers, supplier=suppliers)

    before = snapshot(F.col("c_name"), F.col("s_name"))
    after = snapshot(new_name, F.upper("s_name"))
    changed = cdc.classify(before, after, ["collection", "id"])
    rank = cdc.apply_order(F.col("collection"), ["supplier", "customer"]).cast("int")
    return changed.withColumn("apply_rank", rank).orderBy("apply_rank", "id")


@query("SELECT c_custkey, 'modified' AS op FROM customer WHERE c_mktsegment = 'BUILDING'")
def rename_by_id(t):
    """Keyed by id, an entity that only changed its name is a modification, not a new one."""
    named = t.customer.select("c_custkey", F.col("c_name").alias("slug"), "c_acctbal")
    building = F.col("c_mktsegment") == "BUILDING"
    renamed = t.customer.select(
        "c_custkey", F.when(building, F.upper("c_name")).otherwise(F.col("c_name")).alias("slug"), "c_acctbal"
    )
    return cdc.classify(named, renamed, ["c_custkey"])


@query(_SNAPSHOTS + "SELECT o_orderkey, 'x' AS op FROM base WHERE false")
def noop_diff(t):
    return cdc.classify(base(t), base(t), KEY)


@query(
    _SNAPSHOTS
    + """
    SELECT 'version' AS key, (1 + (count(*) > 0)::INTEGER)::VARCHAR AS value FROM diff
    UNION ALL SELECT 'changes', count(*)::VARCHAR FROM diff
    UNION ALL SELECT 'created_at', '2000-01-01' FROM diff HAVING count(*) >= 0
    """
)
def version_stamp(t):
    """Metadata after the change-set was applied: same keys, later values win."""
    changes = cdc.classify(base(t), current(t), KEY).agg(F.count("*").alias("n"))
    old = t.spark.createDataFrame(
        [("version", "1", 1), ("created_at", "2000-01-01", 1)], "key string, value string, at int"
    )
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    stamps = F.array(
        pair("version", F.when(F.col("n") > 0, 2).otherwise(1)), pair("changes", F.col("n"))
    )
    new = changes.select(F.explode(stamps).alias("s")).select("s.*", F.lit(2).alias("at"))
    return rel.latest_per_key(old.unionByName(new), "key", ["at"]).select("key", "value")


@query(_SNAPSHOTS + "SELECT * FROM cur WHERE o_orderkey IN (SELECT o_orderkey FROM diff)")
def incremental_scope(t):
    changed = cdc.classify(base(t), current(t), KEY)
    return current(t).join(changed, KEY, "left_semi")


@query(
    _IDS
    + """
    SELECT doc_id, collection,
           CASE WHEN coalesce(id, '') <> '' THEN id
                ELSE left(translate(to_base64(unhex(sha256(collection || '/' || doc_id || '/0'))), '+/', '-_'), 21) END AS id,
           coalesce(id, '') = '' AS assigned
    FROM ids
    """
)
def assign_ids(t):
    return cdc.assign_ids(documents_with_ids(t), "id", ["collection", "doc_id"])


@query(
    """
    WITH mapping AS (
      SELECT c_custkey::VARCHAR AS old_id,
             left(translate(to_base64(unhex(sha256('customer/' || c_name || '/0'))), '+/', '-_'), 21) AS new_id
      FROM customer WHERE c_acctbal >= 0)
    SELECT o_orderkey, coalesce(new_id, o_custkey::VARCHAR) AS owner
    FROM orders LEFT JOIN mapping ON old_id = o_custkey::VARCHAR
    """
)
def rekey_mapping(t):
    owners = t.customer.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("customer").alias("collection"), "c_name"
    )
    mapping = cdc.rekey(owners, "id", ["collection", "c_name"])
    orders = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("owner"))
    return cdc.remap(orders, "owner", mapping)


@query(
    """
    SELECT p_partkey, trim(both '-' FROM regexp_replace(regexp_replace(regexp_replace(lower(p_name || ' (' || p_brand || ')'),
      '[^a-z0-9\\s-]', '', 'g'), '\\s+', '-', 'g'), '-+', '-', 'g')) AS slug FROM part
    """
)
def slug_generate(t):
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return t.part.select("p_partkey", text.slug_of(name).alias("slug"))


@query(
    """
    SELECT c_custkey, regexp_matches(name, '^([a-z0-9][a-z0-9-]*[a-z0-9]|[a-z0-9])$') AS is_slug
    FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name ELSE lower(replace(c_name, '#', '-')) END AS name FROM customer)
    """
)
def slug_check(t):
    name = F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(
        F.lower(F.replace("c_name", F.lit("#"), F.lit("-")))
    )
    return t.customer.select("c_custkey", text.is_slug(name).alias("is_slug"))


@query(
    """
    SELECT o_orderkey, CASE o_orderkey % 1000 WHEN 1 THEN 'deleted' WHEN 2 THEN 'added' ELSE 'modified' END AS op
    FROM orders WHERE o_orderkey % 1000 IN (1, 2, 3)
    """
)
def snapshot_diff_sparse(t):
    """Three orders of a thousand differ; only their groups of keys meet in the join."""
    orders, part = t.orders, F.col("o_orderkey") % 1000
    price = F.when(part == 3, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    new = orders.where(part != 1).withColumn("o_totalprice", price)
    return cdc.classify_sparse(orders.where(part != 2), new, KEY)


# ---------------------------------------------------------------- keys of which a part may be NULL

_NULLABLE = _SNAPSHOTS + """,
    base_2 AS (SELECT nullif(o_orderstatus, 'P') AS branch, * FROM base),
    cur_2 AS (SELECT nullif(o_orderstatus, 'P') AS branch, * FROM cur)
"""
BRANCH_KEY = ["branch", "o_orderkey"]


def _branched(orders):
    status = F.col("o_orderstatus")
    return orders.select(F.when(status != "P", status).alias("branch"), "*")


@query(
    _NULLABLE
    + """
    SELECT b.branch, b.o_orderkey, b.o_custkey FROM base_2 b
    WHERE NOT EXISTS (SELECT 1 FROM cur_2 c WHERE c.o_orderkey = b.o_orderkey AND c.branch IS NOT DISTINCT FROM b.branch)
    """
)
def deleted_ids_nullable(t):
    old, new = _branched(base(t)), _branched(current(t))
    return cdc.deleted_ids(old, cdc.classify(old, new, BRANCH_KEY), BRANCH_KEY, "o_custkey")


@query(
    _NULLABLE
    + """
    SELECT b.branch, b.o_orderkey, b.o_custkey::VARCHAR AS old_id, (c.o_custkey + 1)::VARCHAR AS new_id
    FROM base_2 b JOIN cur_2 c ON b.o_orderkey = c.o_orderkey AND b.branch IS NOT DISTINCT FROM c.branch
    WHERE c.o_orderpriority = '3-MEDIUM'
    """
)
def changed_ids_nullable(t):
    moved = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_custkey") + 1)
    old = _branched(base(t)).select(*BRANCH_KEY, F.col("o_custkey").cast("string").alias("id"))
    new = _branched(current(t)).select(*BRANCH_KEY, F.coalesce(moved, "o_custkey").cast("string").alias("id"))
    return cdc.changed_ids(old, new, BRANCH_KEY, "id")


@query(
    """
    SELECT source, lang, CASE WHEN n % 2 = 0 THEN NULL ELSE lang END AS kind, count(*)::BIGINT AS rows_of_key,
      count(*)::BIGINT AS ids
    FROM (SELECT source, lang, n_chars AS n FROM documents) GROUP BY ALL
    """
)
def assign_ids_hot_key(t):
    """Ids for rows that repeat a natural key many times, half of them without a part of it: as many ids as rows."""
    kind = F.when(F.col("n_chars") % 2 != 0, F.col("lang"))
    rows = t.documents.select("doc_id", "source", "lang", kind.alias("kind"), F.lit(None).cast("string").alias("id"))
    given = cdc.assign_ids(rows, "id", ["source", "lang", "kind"])
    return given.groupBy("source", "lang", "kind").agg(
        F.count("*").alias("rows_of_key"), F.count_distinct("id").alias("ids")
    )
