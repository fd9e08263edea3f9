"""Lookups, joins, pages and counts a consumer of the published tables runs."""

from pyspark.sql import functions as F

from shelfwright.operators import relational as rel
from shelfwright.plans.registry import query


@query("SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders WHERE o_orderkey = 42")
def lookup_by_id(t):
    # the date as text: the two engines type it differently
    return t.orders.where(F.col("o_orderkey") == 42).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey = 42")
def lookup_by_fk(t):
    return t.orders.where(F.col("o_custkey") == 42).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'Red%'")
def like_prefix(t):
    return t.part.where(F.col("p_name").ilike("Red%")).select("p_partkey", "p_name")


@query(
    """
    SELECT o.o_orderkey, o.o_orderpriority, c.c_name
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE o.o_orderpriority = '1-URGENT'
    """
)
def attr_equals(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return urgent.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_name"
    )


@query(
    """
    SELECT o.o_orderkey, o.o_totalprice, c.c_name
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    ORDER BY o.o_orderkey LIMIT 20
    """
)
def join_owner(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rel.page(joined.select("o_orderkey", "o_totalprice", "c_name"), ["o_orderkey"], 20)


@query(
    """
    SELECT s.s_suppkey, s.s_name, n.n_name
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
    ORDER BY s.s_suppkey LIMIT 20
    """
)
def join_owner_2(t):
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rel.page(joined.select("s_suppkey", "s_name", "n_name"), ["s_suppkey"], 20)


@query(
    """
    SELECT s.s_suppkey, s.s_name, count(*)::BIGINT AS lines
    FROM supplier s
    JOIN lineitem l ON l.l_suppkey = s.s_suppkey
    JOIN part p ON p.p_partkey = l.l_partkey
    WHERE p.p_type = 'ECONOMY'
    GROUP BY s.s_suppkey, s.s_name
    """
)
def join_bridge_category(t):
    wanted = t.part.where(F.col("p_type") == "ECONOMY").select("p_partkey")
    # counting per supplier key before the owner join sends one row per key and task on
    counted = (
        t.lineitem.join(wanted, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey")
        .agg(F.count("*").alias("lines"))
    )
    return counted.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "s_suppkey", "s_name", "lines"
    )


@query(
    """
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name, s.s_name
    FROM lineitem l
    JOIN part p ON p.p_partkey = l.l_partkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey
    WHERE p.p_type = 'ECONOMY'
    ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, s.s_name LIMIT 20
    """
)
def products_by_category(t):
    wanted = t.part.where(F.col("p_type") == "ECONOMY").select("p_partkey", "p_name")
    joined = t.lineitem.join(wanted, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    shown = joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "s_name")
    return rel.page(shown, ["l_orderkey", "l_linenumber", "l_partkey", "s_name"], 20)


@query(
    """
    WITH words AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS category FROM part),
    all_members AS (
      SELECT p_partkey, category FROM words
      UNION SELECT p_partkey, p_type FROM part
      UNION SELECT p_partkey, p_brand FROM part)
    SELECT category, count(*)::BIGINT AS parts FROM all_members GROUP BY category
    """
)
def category_membership(t):
    bridge = t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("category"))
    both = rel.members(t.part, "p_partkey", bridge, "p_partkey", "category", "p_type", "p_brand")
    return rel.count_by(both, "category", "parts")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def page_1(t):
    return rel.page(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 20)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 80")
def page_5(t):
    return rel.page(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 20, 80)


@query("SELECT p_type, count(*)::BIGINT AS count FROM part GROUP BY p_type ORDER BY count DESC, p_type")
def category_counts(t):
    return rel.count_by(t.part, "p_type")


@query(
    """
    SELECT l_returnflag, count(*)::BIGINT AS count FROM lineitem
    GROUP BY l_returnflag ORDER BY count DESC, l_returnflag
    """
)
def format_counts(t):
    return rel.count_by(t.lineitem, "l_returnflag")


@query(
    """
    SELECT 'orders' AS collection, count(*)::BIGINT AS n FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'documents', count(*) FROM documents
    """
)
def row_counts(t):
    names = ["orders", "lineitem", "part", "documents"]
    counted = [
        getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("collection"), "n")
        for name in names
    ]
    first, *rest = counted
    for other in rest:
        first = first.unionByName(other)
    return first


@query(
    """
    SELECT p_partkey, p_brand, p_retailprice,
           greatest((SELECT count(*) FROM part) - 10, 0)::BIGINT AS remaining
    FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10
    """
)
def topn_with_remainder(t):
    parts = t.part.select("p_partkey", "p_brand", "p_retailprice")
    return rel.top_with_remainder(parts, [F.desc("p_retailprice"), "p_partkey"], 10)


@query(
    """
    SELECT 'customer' AS collection, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL
    SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
    """
)
def union_collections(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return rel.union_collections(customer=customers, supplier=suppliers)


@query(
    """
    SELECT round(min(l_extendedprice), 2) AS lowest, round(max(l_extendedprice), 2) AS highest,
           round(avg(l_extendedprice), 2) AS mean
    FROM lineitem
    """
)
def measure_summary(t):
    price = F.col("l_extendedprice")
    return rel.numbers_of(
        t.lineitem,
        lowest=F.round(F.min(price), 2),
        highest=F.round(F.max(price), 2),
        mean=F.round(F.avg(price), 2),
    )


@query(
    """
    WITH means AS (SELECT l_returnflag, l_linestatus, avg(l_quantity) AS mean
                   FROM lineitem GROUP BY l_returnflag, l_linestatus)
    SELECT round(avg(mean), 3) AS mean_of_means, count(*) FILTER (mean > 25.5)::BIGINT AS slow
    FROM means
    """
)
def mean_of_means(t):
    means = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_quantity").alias("mean"))
    return rel.numbers_of(
        means, mean_of_means=F.round(F.avg("mean"), 3), slow=F.count_if(F.col("mean") > 25.5)
    )


@query(
    """
    SELECT o.o_orderkey, coalesce(c.c_name, '') AS owner_name, c.c_custkey AS owner_key
    FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey
    """
)
def join_owner_left(t):
    known = t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey", "c_name")
    return rel.with_owner(t.orders, "o_custkey", known, "c_custkey").select(
        "o_orderkey",
        F.coalesce("c_name", F.lit("")).alias("owner_name"),
        F.col("c_custkey").alias("owner_key"),
    )


@query(
    """
    SELECT o_orderkey, (SELECT max(c_name) FROM customer WHERE c_custkey = o_custkey) AS owner_name
    FROM orders
    """
)
def owner_scalar_subquery(t):
    owners = t.customer.groupBy("c_custkey").agg(F.max("c_name").alias("owner_name"))
    return rel.with_owner(t.orders, "o_custkey", owners, "c_custkey").select("o_orderkey", "owner_name")


@query(
    """
    WITH codes(code, title) AS (VALUES ('F', 'finished'), ('O', 'open'))
    SELECT o.o_orderkey, o.o_orderstatus, coalesce(c.title, 'unknown') AS title
    FROM orders o LEFT JOIN codes c ON c.code = o.o_orderstatus
    """
)
def code_lookup(t):
    codes = t.spark.createDataFrame([("F", "finished"), ("O", "open")], "code string, title string")
    return t.orders.join(codes, F.col("o_orderstatus") == F.col("code"), "left").select(
        "o_orderkey", "o_orderstatus", F.coalesce("title", F.lit("unknown")).alias("title")
    )


# a schema history derived from the orders: one version per month, breaking when urgent orders lead
_HISTORY = """
    WITH history AS (
      SELECT (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS version,
             (count(*) FILTER (o_orderpriority = '1-URGENT')
              > count(*) FILTER (o_orderpriority = '5-LOW'))::INTEGER AS breaking_change
      FROM orders GROUP BY 1)
"""


def _history(t):
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    low = F.count_if(F.col("o_orderpriority") == "5-LOW")
    version = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return t.orders.groupBy(version.alias("version")).agg(
        (urgent > low).cast("int").alias("breaking_change")
    )


@query(
    _HISTORY
    + """
    SELECT version, (SELECT max(version) FROM history) AS current_version FROM history
    WHERE version > 199800 AND breaking_change = 1 ORDER BY version
    """
)
def schema_compat(t):
    history = _history(t)
    newest = history.agg(F.max("version")).scalar()
    breaking = history.where((F.col("version") > 199800) & (F.col("breaking_change") == 1))
    return breaking.select("version", newest.alias("current_version")).orderBy("version")


@query(_HISTORY + "SELECT version, breaking_change FROM history ORDER BY version")
def versions_sorted(t):
    return _history(t).orderBy("version")


@query(
    """
    SELECT o_orderkey, o_orderstatus = 'F' AS is_final, o_totalprice >= 400000 AS is_broken,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END = '' AS is_missing
    FROM orders
    """
)
def predicate_flags(t):
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").alias("is_final"),
        (F.col("o_totalprice") >= 400000).alias("is_broken"),
        (F.coalesce(priority, F.lit("")) == "").alias("is_missing"),
    )


@query(
    """
    SELECT page_id, url FROM pages
    WHERE regexp_matches(url, '^https?://[^/]+/(en|fr|de)/[^?#]*\\.html')
    """
)
def path_filter(t):
    return t.pages.where(F.col("url").rlike(r"\Ahttps?://[^/]+/(en|fr|de)/[^?#]*\.html")).select(
        "page_id", "url"
    )
