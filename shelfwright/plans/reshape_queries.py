"""Documents to tables: projections, flattening, aliases, overlays, generated keys."""

from pyspark.sql import functions as F

from shelfwright.functions import text
from shelfwright.functions.keys import child_key
from shelfwright.operators import ordered, overlay, reshape
from shelfwright.operators.lineage import resolve_parent
from shelfwright.plans.registry import query


@query(
    """
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS pos,
           unnest(string_split(text, chr(10))) AS line
    FROM documents
    """
)
def explode_list(t):
    return t.documents.select("doc_id", F.posexplode(text.lines(F.col("text"))).alias("pos", "line"))


@query(
    """
    SELECT event_id, key, json_extract(props, '$.' || key)::INTEGER AS value
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
    """
)
def explode_map(t):
    entries = t.events.select("event_id", F.from_json("props", "map<string,int>").alias("entries"))
    return reshape.explode_map(entries, ["event_id"], "entries", "key", "value")


@query(
    """
    SELECT event_id, format, json_extract(props, '$.' || format)::INTEGER AS identifier
    FROM (SELECT event_id, props, unnest(['k', event_type]) AS format FROM events)
    """
)
def map_key_lookup(t):
    return reshape.with_map_entry(
        t.events,
        ["event_id"],
        F.array(F.lit("k"), F.col("event_type")),
        F.from_json("props", "map<string,int>"),
        "format",
        "identifier",
    )


@query(
    """
    WITH outer_level AS (
      SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS line_pos,
             unnest(string_split(text, chr(10))) AS line
      FROM documents)
    SELECT doc_id, line_pos, generate_subscripts(string_split(line, ', '), 1)::INTEGER - 1 AS part_pos,
           unnest(string_split(line, ', ')) AS part
    FROM outer_level
    """
)
def explode_nested_two_level(t):
    nested = t.documents.select(
        "doc_id",
        F.transform(
            text.lines(F.col("text")), lambda line: F.struct(F.split(line, ", ").alias("parts"))
        ).alias("revisions"),
    )
    outer = nested.select("doc_id", F.posexplode("revisions").alias("line_pos", "revision"))
    return outer.select(
        "doc_id", "line_pos", F.posexplode("revision.parts").alias("part_pos", "part")
    )


@query(
    """
    SELECT o_orderkey AS id, o_orderkey::VARCHAR || '-order' AS name,
           coalesce(o_orderstatus = 'P', false)::INTEGER AS pending,
           coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, 'none') AS priority,
           coalesce(CASE WHEN o_totalprice > 100000 THEN 2 END, 1) AS max_connections
    FROM orders WHERE o_orderkey IS NOT NULL
    """
)
def default_and_flag_projection(t):
    urgent = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return t.orders.where(F.col("o_orderkey").isNotNull()).select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("-order")).alias("name"),
        F.coalesce(F.col("o_orderstatus") == "P", F.lit(False)).cast("int").alias("pending"),
        F.coalesce(urgent, F.lit("none")).alias("priority"),
        F.coalesce(F.when(F.col("o_totalprice") > 100000, 2), F.lit(1)).alias("max_connections"),
    )


@query("SELECT p_partkey, array_to_string(string_split(p_name, ' '), chr(10) || chr(10)) AS body FROM part")
def list_to_text(t):
    return t.part.select("p_partkey", text.paragraphs(F.split("p_name", " ")).alias("body"))


@query(
    """
    SELECT s_suppkey, s_name AS name, coalesce(n_name, '') AS manufacturer_name,
           array_to_string(string_split(s_name, '#'), ' ') AS categories, '' AS description
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey < 3
    """
)
def search_document(t):
    near = t.nation.where(F.col("n_regionkey") < 3)
    joined = t.supplier.join(near, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    described = joined.withColumn("note", F.lit(None).cast("string"))
    return reshape.search_document(
        described, "s_suppkey", "s_name", "n_name", F.split("s_name", "#"), "note"
    )


@query(
    """
    WITH aliases(alias, canonical) AS (VALUES ('small', 'tiny'), ('large', 'big'), ('new', 'fresh')),
    words AS (SELECT p_partkey, unnest(string_split(p_name, ' ') || [lower(p_type)]) AS word FROM part)
    SELECT DISTINCT p_partkey, coalesce(canonical, word) AS category
    FROM words LEFT JOIN aliases ON alias = word
    """
)
def alias_normalise(t):
    aliases = reshape.alias_map({"small": "tiny", "large": "big", "new": "fresh"})
    words = F.array_append(F.split("p_name", " "), F.lower("p_type"))
    return reshape.explode_list(t.part, ["p_partkey"], reshape.replace_alias(words, aliases), "category")


@query(
    """
    WITH translated AS (SELECT conv_id, role, length(text)::INTEGER AS size FROM conversations WHERE turn = 0)
    SELECT c.conv_id, c.turn, c.role, coalesce('size ' || t.size, c.role) AS shown
    FROM conversations c LEFT JOIN translated t ON c.conv_id = t.conv_id AND c.role = t.role
    """
)
def overlay_merge(t):
    base = t.conversations.select("conv_id", "turn", "role", F.col("role").alias("shown"))
    translated = t.conversations.where(F.col("turn") == 0).select(
        "conv_id", "role", F.concat(F.lit("size "), F.length("text").cast("string")).alias("shown")
    )
    return overlay.overlay_columns(base, translated, ["conv_id", "role"], ["shown"])


@query(
    """
    WITH localised AS (SELECT conv_id, turn, 'local' AS link FROM conversations WHERE role = 'system')
    SELECT * FROM localised
    UNION ALL
    SELECT conv_id, turn, role FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM localised)
    """
)
def overlay_replace(t):
    base = t.conversations.select("conv_id", "turn", F.col("role").alias("link"))
    localised = base.where(F.col("link") == "system").withColumn("link", F.lit("local"))
    return overlay.overlay_replace(base, localised, "conv_id")


@query(
    """
    SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'good' END, d.source) AS description,
           coalesce(CASE WHEN l.toxic = 1 THEN 'flagged' END, d.lang) AS website
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def overlay_content(t):
    base = t.documents.select(
        "doc_id", F.col("source").alias("description"), F.col("lang").alias("website")
    )
    translated = t.labels.select(
        "doc_id",
        F.when(F.col("quality") == 1, "good").alias("description"),
        F.when(F.col("toxic") == 1, "flagged").alias("website"),
    )
    return overlay.overlay_columns(base, translated, ["doc_id"], ["description", "website"])


@query(
    """
    SELECT c.p_partkey, p.p_name AS parent_name
    FROM (SELECT p_partkey, p_partkey // 2 + p_size AS parent FROM part) c
    LEFT JOIN part p ON p.p_partkey = c.parent
    """
)
def parent_self_join(t):
    children = t.part.select(
        "p_partkey", "p_name", F.expr("p_partkey div 2 + p_size").alias("parent")
    )
    return resolve_parent(children, "p_partkey", "parent", "p_name", "parent_name").select(
        "p_partkey", "parent_name"
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, generate_subscripts(prices, 1)::INTEGER - 1 AS pos,
           unnest(prices).kind AS kind, unnest(prices).amount AS amount
    FROM (SELECT *, [{'kind': 'price', 'amount': l_extendedprice}, {'kind': 'discount', 'amount': l_discount},
                     {'kind': 'tax', 'amount': l_tax}] AS prices FROM lineitem)
    """
)
def explode_children(t):
    packed = t.lineitem.select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("parent"),
        F.array(
            F.struct(F.lit("price").alias("kind"), F.col("l_extendedprice").alias("amount")),
            F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("amount")),
            F.struct(F.lit("tax").alias("kind"), F.col("l_tax").alias("amount")),
        ).alias("prices"),
    )
    flat = reshape.explode_children(packed, "parent", "prices", {"kind": "kind", "amount": "amount"})
    return flat.select("parent.*", "pos", "kind", "amount")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id
    FROM lineitem
    """
)
def generated_keys(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ordered.with_row_number(t.lineitem.select(*order), order)


@query(
    """
    WITH flat AS (
      SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS pos FROM documents)
    SELECT doc_id, pos, left(translate(to_base64(unhex(sha256(doc_id || '/' || pos || '/0'))), '+/', '-_'), 21) AS row_key
    FROM flat
    """
)
def child_keys(t):
    flat = t.documents.select("doc_id", F.posexplode(text.lines(F.col("text"))).alias("pos", "line"))
    return flat.select(
        "doc_id", "pos", child_key(F.col("doc_id").cast("string"), F.col("pos")).alias("row_key")
    )


@query(
    """
    SELECT doc_id, lang AS locale, generate_subscripts(links, 1)::INTEGER - 1 AS pos, unnest(links) AS link
    FROM (SELECT doc_id, lang, [source, lang || '/' || source] AS links FROM documents)
    WHERE lang IN ('de', 'fr')
    """
)
def localised_links(t):
    content = F.struct(
        F.array(F.col("source"), F.concat_ws("/", "lang", "source")).alias("links")
    )
    packed = t.documents.select("doc_id", F.create_map(F.col("lang"), content).alias("translations"))
    approved = t.spark.createDataFrame([("de",), ("fr",)], "locale string")
    per_locale = reshape.explode_map(packed, ["doc_id"], "translations", "locale", "content")
    return per_locale.join(approved, "locale", "left_semi").select(
        "doc_id", "locale", F.posexplode("content.links").alias("pos", "link")
    )


@query(
    """
    SELECT doc_id, lang AS locale, text AS description FROM documents
    WHERE lang IN ('de', 'fr') AND (text <> '' OR source <> '')
    """
)
def localised_content(t):
    content = F.struct(F.col("text").alias("description"), F.col("source").alias("website"))
    packed = t.documents.select("doc_id", F.create_map(F.col("lang"), content).alias("translations"))
    approved = t.spark.createDataFrame([("de",), ("fr",)], "locale string")
    per_locale = reshape.explode_map(packed, ["doc_id"], "translations", "locale", "content")
    filled = ~text.is_blank(F.col("content.description")) | ~text.is_blank(F.col("content.website"))
    return per_locale.join(approved, "locale", "left_semi").where(filled).select(
        "doc_id", "locale", "content.description"
    )


@query(
    """
    SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey
    FROM lineitem r
    WHERE r.l_returnflag = 'R' AND EXISTS (
      SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'R' AND p.l_partkey = r.l_partkey AND p.l_suppkey = r.l_suppkey)
    """
)
def localised_ports(t):
    ports = (
        t.lineitem.where(F.col("l_returnflag") != "R").select("l_partkey", "l_suppkey").distinct()
    )
    translated = t.lineitem.where(F.col("l_returnflag") == "R")
    return translated.join(ports, ["l_partkey", "l_suppkey"], "left_semi").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    """
    SELECT file, generate_subscripts(urls, 1)::INTEGER - 1 AS pos, unnest(urls) AS url
    FROM (SELECT page_id::VARCHAR AS file, [url, replace(url, 'http:', 'https:')] AS urls FROM pages)
    """
)
def reattach_parent(t):
    results = t.pages.select(
        F.col("page_id").cast("string").alias("file"),
        F.array("url", F.replace("url", F.lit("http:"), F.lit("https:"))).alias("urls"),
    )
    return results.select("file", F.posexplode("urls").alias("pos", "url"))
