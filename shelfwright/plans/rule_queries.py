"""Validation rules over the tables: raw checks, coded findings, tiers and verdicts."""

from pyspark.sql import functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions import dates, identifiers, text, urls
from shelfwright.operators import changes as cdc, findings as fd, nearest, references as refs
from shelfwright.plans import change_queries as snapshots
from shelfwright.plans.registry import query

NOTHING = "NULL::VARCHAR AS suggestion"

# ---------------------------------------------------------------- names, dates


_NAMED = """
    named AS (SELECT conv_id || '/' || turn AS slug,
                     CASE WHEN role = 'system' THEN NULL WHEN turn = 1 THEN '' ELSE text END AS name
              FROM conversations)
"""


def _named(t):
    name = F.when(F.col("role") == "system", F.lit(None)).when(F.col("turn") == 1, "").otherwise(F.col("text"))
    return t.conversations.select(F.concat_ws("/", "conv_id", "turn").alias("slug"), name.alias("name"))


@query(
    f"""
    WITH {_NAMED}
    SELECT 'conversations' AS collection, slug, 2 AS tier, 'E100' AS code, 'name' AS path,
           'name is required' AS message, {NOTHING}
    FROM named WHERE coalesce(name, '') = ''
    """
)
def required_fields(t):
    blank = _named(t).where(text.is_blank(F.col("name")))
    return fd.finding(
        blank, tier=fd.SHAPE, code="E100", path="name", message="name is required",
        collection=F.lit("conversations"),
    )


_DATED = """
    dated AS (
      SELECT o_orderkey, o_orderstatus = 'P' AS year_only,
             CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y')
                                  WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y') || chr(10)
                                  WHEN '3-MEDIUM' THEN NULL
                                  WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-31')
                                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
      FROM orders)
"""


def _dated(t):
    priority = F.col("o_orderpriority")
    year = F.date_format("o_orderdate", "yyyy")
    day = (
        F.when(priority == "1-URGENT", year)
        .when(priority == "2-HIGH", F.concat(year, F.lit("\n")))
        .when(priority == "3-MEDIUM", F.lit(None))
        .when(priority == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-'31'"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return t.orders.select("o_orderkey", (F.col("o_orderstatus") == "P").alias("year_only"), day.alias("day"))


@query(
    f"""
    WITH {_DATED}
    SELECT o_orderkey, NOT year_only OR coalesce(regexp_full_match(day, '[0-9]{{4}}'), false) AS ok FROM dated
    """
)
def year_only_rule(t):
    return _dated(t).select("o_orderkey", dates.year_only_ok(F.col("year_only"), F.col("day")).alias("ok"))


@query(
    f"""
    WITH {_DATED}
    SELECT 'orders' AS collection, o_orderkey::VARCHAR AS slug, 2 AS tier, 'E199' AS code,
           'releaseDateYearOnly' AS path, '{dates.YEAR_ONLY_MESSAGE}' AS message, {NOTHING}
    FROM dated WHERE year_only AND NOT coalesce(regexp_full_match(day, '[0-9]{{4}}'), false)
    """
)
def rule_year_only(t):
    bad = _dated(t).where(~dates.year_only_ok(F.col("year_only"), F.col("day")))
    return fd.finding(
        bad, tier=fd.SHAPE, code="E199", path="releaseDateYearOnly", collection=F.lit("orders"),
        slug="o_orderkey", message=dates.YEAR_ONLY_MESSAGE,
    )


@query(
    f"""
    WITH {_DATED}
    SELECT o_orderkey, regexp_full_match(day, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(day AS DATE) IS NOT NULL AS ok
    FROM dated WHERE day IS NOT NULL
    """
)
def iso_date_rule(t):
    return _dated(t).where(F.col("day").isNotNull()).select(
        "o_orderkey", dates.is_iso_date(F.col("day")).alias("ok")
    )


@query(
    f"""
    WITH {_DATED}
    SELECT 'orders' AS collection, o_orderkey::VARCHAR AS slug, 2 AS tier, 'E199' AS code, 'prices.asOf' AS path,
           'price date is not an ISO date: ' || day AS message, {NOTHING}
    FROM dated WHERE day IS NOT NULL
      AND NOT (regexp_full_match(day, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(day AS DATE) IS NOT NULL)
    """
)
def rule_price_date(t):
    bad = _dated(t).where(F.col("day").isNotNull() & ~dates.is_iso_date(F.col("day")))
    return fd.finding(
        bad, tier=fd.SHAPE, code="E199", path="prices.asOf", collection=F.lit("orders"), slug="o_orderkey",
        message=F.concat(F.lit("price date is not an ISO date: "), "day"),
    )


# ---------------------------------------------------------------- types and vocabularies


@query(
    f"""
    SELECT 'events' AS collection, event_id::VARCHAR AS slug, 2 AS tier, 'E101' AS code, 'k' AS path,
           'expected STRING, got BIGINT' AS message, {NOTHING}
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN '{{"k": "x"}}' ELSE props END AS props FROM events)
    WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')
    """
)
def rule_types(t):
    props = F.when(F.col("event_type") == "error", F.lit('{"k": "x"}')).otherwise(F.col("props"))
    parsed = t.events.select("event_id", F.try_parse_json(props).alias("doc"))
    found = F.schema_of_variant(F.try_variant_get("doc", "$.k", "variant"))
    bad = parsed.withColumn("found", found).where(F.col("found") != "STRING")
    return fd.finding(
        bad, tier=fd.SHAPE, code="E101", path="k", collection=F.lit("events"), slug="event_id",
        message=F.concat(F.lit("expected STRING, got "), "found"),
    )


@query(
    f"""
    WITH allowed AS (SELECT DISTINCT event_type FROM events WHERE event_type > 'd')
    SELECT 'events' AS collection, event_id::VARCHAR AS slug, 2 AS tier, 'E105' AS code, 'platforms' AS path,
           'invalid platform ''' || event_type || '''; valid: ' ||
           (SELECT array_to_string(list_sort(list(event_type)), ', ') FROM allowed) AS message, {NOTHING}
    FROM events WHERE event_type NOT IN (SELECT event_type FROM allowed)
    """
)
def rule_platform(t):
    allowed = t.events.where(F.col("event_type") > "d").select("event_type").distinct()
    shown = refs.options_shown(allowed, "event_type")
    bad = refs.dangling(t.events, ["event_type"], allowed, ["event_type"])
    message = F.concat(F.lit("invalid platform '"), "event_type", F.lit("'; valid: "), shown)
    return fd.finding(
        bad, tier=fd.SHAPE, code="E105", path="platforms", collection=F.lit("events"), slug="event_id",
        message=message,
    )


@query(
    """
    WITH allowed AS (SELECT word, min(p_partkey) AS pos
                     FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_partkey FROM part WHERE p_size < 10) GROUP BY word),
    used AS (SELECT p_partkey, generate_subscripts(words, 1)::INTEGER - 1 AS i, unnest(words) AS word
             FROM (SELECT p_partkey, string_split(p_name, ' ') || [substr(p_type, 1, 4)] AS words FROM part)),
    bad AS (SELECT * FROM used WHERE word NOT IN (SELECT word FROM allowed)),
    best AS (SELECT b.word, arg_min(a.word, (levenshtein(lower(b.word), lower(a.word)), a.pos, a.word)) AS suggestion
             FROM (SELECT DISTINCT word FROM bad) b, allowed a
             WHERE levenshtein(lower(b.word), lower(a.word)) <= 3 GROUP BY b.word)
    SELECT 'part' AS collection, p_partkey::VARCHAR AS slug, 2 AS tier, 'E106' AS code, 'formats.' || i AS path,
           'invalid format ''' || bad.word || '''' AS message, suggestion
    FROM bad LEFT JOIN best ON bad.word = best.word
    """
)
def rule_format(t):
    words = t.part.select("p_partkey", "p_size", F.explode(F.split("p_name", " ")).alias("word"))
    allowed = words.where(F.col("p_size") < 10).groupBy("word").agg(F.min("p_partkey").alias("pos"))
    listed = F.array_append(F.split("p_name", " "), F.substring("p_type", 1, 4))
    used = t.part.select("p_partkey", F.posexplode(listed).alias("i", "value"))
    bad = refs.dangling(used, ["value"], allowed, ["word"])
    best = nearest.nearest_option(bad, "value", allowed, "word", "pos")
    return fd.finding(
        bad.join(best, "value", "left"), tier=fd.SHAPE, code="E106",
        path=F.concat(F.lit("formats."), F.col("i").cast("string")),
        message=F.concat(F.lit("invalid format '"), "value", F.lit("'")),
        collection=F.lit("part"), slug="p_partkey", suggestion=F.col("suggestion"),
    )


@query(
    f"""
    SELECT 'orders' AS collection, o_orderkey::VARCHAR AS slug, 3 AS tier, 'E200' AS code, 'manufacturer' AS path,
           'referenced owner ' || o_custkey || ' does not exist' AS message, {NOTHING}
    FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    """
)
def rule_owner(t):
    known = t.customer.where(F.col("c_acctbal") >= 0)
    bad = refs.dangling(t.orders, ["o_custkey"], known, ["c_custkey"])
    message = F.concat_ws(" ", F.lit("referenced owner"), "o_custkey", F.lit("does not exist"))
    return fd.finding(
        bad, tier=fd.OWNER, code="E200", path="manufacturer", message=message,
        collection=F.lit("orders"), slug="o_orderkey",
    )


@query(
    f"""
    WITH items AS (SELECT p_partkey, p_brand, p_partkey // 2 AS supersedes FROM part)
    SELECT p_brand AS collection, p_partkey::VARCHAR AS slug, 4 AS tier, 'E199' AS code, 'supersedes' AS path,
           'referenced id ' || supersedes || ' does not exist in this collection' AS message, {NOTHING}
    FROM items a
    WHERE NOT EXISTS (SELECT 1 FROM items b WHERE b.p_brand = a.p_brand AND b.p_partkey = a.supersedes)
    """
)
def rule_lineage_ref(t):
    items = t.part.select("p_partkey", "p_brand", F.expr("p_partkey div 2").alias("supersedes"))
    bad = refs.dangling(items, ["p_brand", "supersedes"], items, ["p_brand", "p_partkey"])
    message = F.concat_ws(
        " ", F.lit("referenced id"), "supersedes", F.lit("does not exist in this collection")
    )
    return fd.finding(
        bad, tier=fd.LINEAGE, code="E199", path="supersedes", message=message,
        collection="p_brand", slug="p_partkey",
    )


# ---------------------------------------------------------------- identifiers

# each part is an entry: its type names a format, and the identifier is built from brand and name
FORMAT_OF_TYPE = {
    "ECONOMY": "au", "STANDARD": "aax", "MEDIUM": "vst3", "PROMO": "clap", "LARGE": "standalone", "SMALL": "lv2",
}
_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FORMAT_OF_TYPE.items())

ENTRIES_SQL = f"""
    typed AS (SELECT *, CASE p_type {_CASES} END AS own FROM part),
    entries AS (
      SELECT p_partkey, p_size, CASE WHEN p_size > 30 THEN [own, 'vst2'] ELSE [own] END AS formats,
             CASE WHEN p_size <= 15 OR own = 'standalone' THEN NULL ELSE own END AS held,
             CASE own WHEN 'au' THEN replace(p_name, ' ', '.') WHEN 'aax' THEN p_brand[1:4] WHEN 'vst3' THEN p_brand
                      WHEN 'clap' THEN '' ELSE p_brand || '/' || p_name END AS value
      FROM typed)
"""
_HINTS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.IDENTIFIER_HINTS.items())
_WITH_PATTERN = ", ".join(f"'{k}'" for k in fixed.IDENTIFIER_PATTERNS)
_PATTERNS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.IDENTIFIER_PATTERNS.items())
ERROR_SQL = f"""
    CASE WHEN trim(value) = '' THEN 'no value for the identifier of ' || held
         WHEN NOT regexp_matches(value, CASE held {_PATTERNS} END)
         THEN 'not an identifier of ' || held || ': ''' || value || '''' END
"""


def entries(t):
    own = F.try_element_at(
        F.create_map(*[F.lit(x) for item in FORMAT_OF_TYPE.items() for x in item]), F.col("p_type")
    )
    value = (
        F.when(own == "au", F.replace("p_name", F.lit(" "), F.lit(".")))
        .when(own == "aax", F.substring("p_brand", 1, 4))
        .when(own == "vst3", F.col("p_brand"))
        .when(own == "clap", F.lit(""))
        .otherwise(F.concat_ws("/", "p_brand", "p_name"))
    )
    none = F.create_map().cast("map<string,string>")
    holds = (F.col("p_size") > 15) & (own != "standalone")
    return t.part.select(
        "p_partkey",
        F.when(F.col("p_size") > 30, F.array(own, F.lit("vst2"))).otherwise(F.array(own)).alias("formats"),
        F.when(holds, F.create_map(own, value)).otherwise(none).alias("identifiers"),
    )


@query(
    f"""
    WITH {ENTRIES_SQL}
    SELECT p_partkey, held AS format, value, {ERROR_SQL} AS error FROM entries WHERE held IS NOT NULL
    """
)
def identifier_pattern(t):
    held = entries(t).select("p_partkey", F.explode("identifiers").alias("format", "value"))
    return held.withColumn("error", identifiers.identifier_error(F.col("format"), F.col("value")))


@query(
    f"""
    WITH {ENTRIES_SQL}
    SELECT 'part' AS collection, p_partkey::VARCHAR AS slug, 2 AS tier, 'E400' AS code, 'identifiers.' || held AS path,
           {ERROR_SQL} AS message,
           CASE held {_HINTS} END AS suggestion
    FROM entries WHERE held IS NOT NULL AND ({ERROR_SQL}) IS NOT NULL
    """
)
def rule_identifier(t):
    bad = entries(t).select(
        "p_partkey", F.explode(identifiers.invalid_identifiers(F.col("identifiers"))).alias("bad")
    )
    return fd.finding(
        bad, tier=fd.SHAPE, code="E400", path=F.concat(F.lit("identifiers."), "bad.format"),
        message=F.col("bad.error"), suggestion=identifiers.hint_for(F.col("bad.format")),
        collection=F.lit("part"), slug="p_partkey",
    )


@query(
    f"""
    WITH {ENTRIES_SQL}, used AS (SELECT p_partkey, unnest(formats) AS format FROM entries)
    SELECT p_partkey, format, format IN ({_WITH_PATTERN}) AS has_pattern,
           CASE format {_HINTS} END AS hint
    FROM used
    """
)
def hint_lookup(t):
    used = entries(t).select("p_partkey", F.explode("formats").alias("format"))
    return used.select(
        "p_partkey",
        "format",
        identifiers.has_pattern(F.col("format")).alias("has_pattern"),
        identifiers.hint_for(F.col("format")).alias("hint"),
    )


# ---------------------------------------------------------------- URLs

LINKS_SQL = """
    links AS (
      SELECT page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS file,
             CASE WHEN url LIKE '%/fr/%' THEN 'https://youtube.com/watch?v=' || page_id
                  WHEN url LIKE '%/de/%' THEN 'https://www.youtube.com/embed/' || page_id
                  WHEN url LIKE '%/es/%' THEN 'https://youtu.be/' || page_id
                  WHEN url LIKE '%utm_source%' THEN 'https://www.youtube.com/watch?v=' || page_id || '&t=1'
                  WHEN url LIKE '%.html' THEN 'https://www.youtube.com/watch?v=' || page_id
                  WHEN url LIKE '%page=2%' THEN regexp_replace(url, '^https?://', '')
                  ELSE url END AS url
      FROM pages)
"""
VIDEO_ERROR_SQL = """
    CASE WHEN url LIKE 'https://youtube.com/%' THEN 'use ''www.youtube.com'' instead of ''youtube.com'''
         WHEN url LIKE 'https://www.youtube.com/embed/%' THEN 'use ''/watch?v='' instead of ''/embed/'''
         WHEN url LIKE 'https://youtu.be/%' THEN 'use ''www.youtube.com/watch?v='' instead of ''youtu.be'''
         WHEN url LIKE 'https://www.youtube.com/%' AND NOT regexp_matches(url, 'VIDEO_CANONICAL')
         THEN 'must match ''https://www.youtube.com/watch?v={videoId}''' END
""".replace("VIDEO_CANONICAL", fixed.VIDEO_CANONICAL)


def links(t):
    key, url = F.col("page_id").cast("string"), F.col("url")
    made = (
        F.when(F.contains(url, F.lit("/fr/")), F.concat(F.lit("https://youtube.com/watch?v="), key))
        .when(F.contains(url, F.lit("/de/")), F.concat(F.lit("https://www.youtube.com/embed/"), key))
        .when(F.contains(url, F.lit("/es/")), F.concat(F.lit("https://youtu.be/"), key))
        .when(
            F.contains(url, F.lit("utm_source")),
            F.concat(F.lit("https://www.youtube.com/watch?v="), key, F.lit("&t=1")),
        )
        .when(F.endswith(url, F.lit(".html")), F.concat(F.lit("https://www.youtube.com/watch?v="), key))
        .when(F.contains(url, F.lit("page=2")), F.regexp_replace(url, r"\Ahttps?://", ""))
        .otherwise(url)
    )
    return t.pages.select("page_id", urls.host_of(url).alias("file"), made.alias("url"))


@query(
    f"""
    WITH {LINKS_SQL}
    SELECT page_id, url, regexp_matches(url, '^https?://[^/]') AS is_url, {VIDEO_ERROR_SQL} AS error FROM links
    """
)
def url_rules(t):
    return links(t).select(
        "page_id", "url", urls.is_url(F.col("url")).alias("is_url"), urls.video_url_error(F.col("url")).alias("error")
    )


@query(
    r"""
    WITH used AS (
      SELECT page_id, url FROM pages
      UNION SELECT page_id, replace(url, 'http:', 'https:') FROM pages
      UNION SELECT page_id, 'http://' || page_id || '.example.org' FROM pages
      UNION SELECT page_id, replace(url, 'http', 'http://deep\') FROM pages)
    SELECT page_id, url FROM used
    """
)
def nested_url_extract(t):
    """Pages packed into nested JSON: a URL on top, in a list of lists, and one that is no URL field."""
    secure = F.replace("url", F.lit("http:"), F.lit("https:"))
    own = F.concat(F.lit("http://"), F.col("page_id").cast("string"), F.lit(".example.org"))
    deep = F.struct(F.replace("url", F.lit("http"), F.lit("http://deep\\"),).alias("source"))
    for _ in range(12):
        deep = F.array(F.struct(deep.alias("more")))
    packed = F.to_json(
        F.struct(
            F.col("url").alias("website"),
            F.lit("plain text").alias("source"),
            F.array(F.struct(F.array(F.struct(secure.alias("url"), F.col("url").alias("title"))).alias("links"))).alias("revisions"),
            F.struct(own.alias("source"), F.col("url").alias("note")).alias("price"),
            F.array(F.col("url")).alias("urls"),
            deep.alias("deep"),
        )
    )
    docs = t.pages.select("page_id", F.parse_json(packed).alias("doc"))
    return urls.extract_urls(docs, ["page_id"], "doc")


# ---------------------------------------------------------------- markers

_LINES = """
    split AS (SELECT page_id, string_split(html, chr(10)) AS parts FROM pages),
    numbered AS (SELECT page_id, generate_subscripts(parts, 1)::INTEGER AS line, unnest(parts) AS body FROM split),
    walked AS (
      SELECT *, regexp_matches(body, '^\\s*<p>') AS toggles,
             coalesce(sum(regexp_matches(body, '^\\s*<p>')::INTEGER) OVER (PARTITION BY page_id ORDER BY line
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS fenced
      FROM numbered),
    odd AS (SELECT page_id, line FROM walked
            WHERE NOT toggles AND NOT fenced AND (length(body) - length(replace(body, '/', ''))) % 2 = 1)
"""


@query(
    """
    SELECT page_id, ((length(html) - length(replace(html, '%%%', ''))) // 3) % 2 = 0 AS balanced FROM pages
    """
)
def marker_balance(t):
    return t.pages.select("page_id", text.fences_balanced(F.col("html"), "%%%").alias("balanced"))


@query(f"WITH {_LINES} SELECT page_id, line FROM odd")
def marker_lines(t):
    odd = text.odd_marker_lines(F.col("html"), marker="/", fence="<p>")
    return t.pages.select("page_id", F.explode(odd).alias("line"))


@query(
    f"""
    SELECT 'pages' AS collection, page_id::VARCHAR AS slug, 2 AS tier, 'E302' AS code, 'description' AS path,
           'unclosed block' AS message, {NOTHING}
    FROM pages WHERE ((length(html) - length(replace(html, '%%%', ''))) // 3) % 2 = 1
    """
)
def rule_fences(t):
    bad = t.pages.where(~text.fences_balanced(F.col("html"), "%%%"))
    return fd.finding(
        bad, tier=fd.SHAPE, code="E302", path="description", message="unclosed block",
        collection=F.lit("pages"), slug="page_id",
    )


@query(
    f"""
    WITH {_LINES}
    SELECT 'pages' AS collection, page_id::VARCHAR AS slug, 2 AS tier, 'E303' AS code, 'description' AS path,
           'unbalanced on line ' || line AS message, {NOTHING}
    FROM odd
    """
)
def rule_backticks(t):
    odd = text.odd_marker_lines(F.col("html"), marker="/", fence="<p>")
    bad = t.pages.select("page_id", F.explode(odd).alias("line"))
    return fd.finding(
        bad, tier=fd.SHAPE, code="E303", path="description", collection=F.lit("pages"), slug="page_id",
        message=F.concat(F.lit("unbalanced on line "), F.col("line").cast("string")),
    )


# ---------------------------------------------------------------- ports, ids, groups


@query(
    f"""
    SELECT 'lineitem' AS collection, r.l_orderkey || '/' || r.l_linenumber AS slug, 2 AS tier, 'E204' AS code,
           'translations.io' AS path, 'no port named ' || r.l_suppkey AS message, {NOTHING}
    FROM lineitem r
    WHERE r.l_returnflag = 'R' AND NOT EXISTS (
      SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'R' AND p.l_partkey = r.l_partkey AND p.l_suppkey = r.l_suppkey)
    """
)
def rule_port_translation(t):
    translated = t.lineitem.where(F.col("l_returnflag") == "R")
    ports = t.lineitem.where(F.col("l_returnflag") != "R")
    pair = ["l_partkey", "l_suppkey"]
    bad = refs.dangling(translated, pair, ports, pair)
    return fd.finding(
        bad, tier=fd.SHAPE, code="E204", path="translations.io", collection=F.lit("lineitem"),
        slug=F.concat_ws("/", "l_orderkey", "l_linenumber"),
        message=F.concat_ws(" ", F.lit("no port named"), "l_suppkey"),
    )


@query(
    snapshots._SNAPSHOTS
    + f"""
    SELECT 'orders' AS collection, b.o_orderkey::VARCHAR AS slug, 0 AS tier, 'E199' AS code, 'id' AS path,
           'id changed from ' || b.o_custkey || ' to ' || (c.o_custkey + 1) AS message, {NOTHING}
    FROM base b JOIN cur c ON b.o_orderkey = c.o_orderkey WHERE c.o_orderpriority = '3-MEDIUM'
    """
)
def rule_id_immutable(t):
    moved = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_custkey") + 1)
    old = snapshots.base(t).select("o_orderkey", F.col("o_custkey").alias("id"))
    new = snapshots.current(t).select("o_orderkey", F.coalesce(moved, "o_custkey").alias("id"))
    bad = cdc.changed_ids(old, new, ["o_orderkey"], "id")
    message = F.concat_ws(" ", F.lit("id changed from"), "old_id", F.lit("to"), "new_id")
    return fd.finding(
        bad, tier=fd.OUTSIDE_TIERS, code="E199", path="id", message=message,
        collection=F.lit("orders"), slug="o_orderkey",
    )


@query(
    f"""
    WITH vocabulary AS (SELECT DISTINCT p_name AS term FROM part WHERE p_size <= 40),
    grouped AS (SELECT p_name AS member, count(DISTINCT p_type) AS n FROM part WHERE p_size > 40 GROUP BY p_name)
    SELECT 'vocabulary' AS collection, coalesce(term, member) AS slug, 0 AS tier, 'E199' AS code, 'groups' AS path,
           CASE WHEN member IS NULL THEN 'unmapped' WHEN term IS NULL THEN 'orphan' ELSE 'multi_mapped' END AS message,
           {NOTHING}
    FROM vocabulary FULL OUTER JOIN grouped ON term = member
    WHERE member IS NULL OR term IS NULL OR n > 1
    """
)
def rule_vocabulary_groups(t):
    vocabulary = t.part.where(F.col("p_size") <= 40)
    grouped = t.part.where(F.col("p_size") > 40)
    bad = refs.reconcile(vocabulary, "p_name", grouped, "p_name", "p_type")
    return fd.finding(
        bad, tier=fd.OUTSIDE_TIERS, code="E199", path="groups", message=F.col("status"),
        collection=F.lit("vocabulary"), slug="term",
    )


# ---------------------------------------------------------------- reports over several rules

_REPORT = f"""
    WITH findings AS (
      SELECT lang AS collection, doc_id::VARCHAR AS slug, 2 AS tier, 'E302' AS code, 'text' AS path,
             'odd number of commas' AS message
      FROM documents WHERE (length(text) - length(replace(text, ',', ''))) % 2 = 1
      UNION ALL
      SELECT lang, doc_id::VARCHAR, 3, 'E200', 'source', 'unknown source ' || source
      FROM documents WHERE source NOT IN (
        SELECT d.source FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1)
      UNION ALL
      SELECT lang, doc_id::VARCHAR, 5, 'E202', 'lines.' || pos, 'duplicate line'
      FROM (SELECT doc_id, lang, pos, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS n
            FROM (SELECT doc_id, lang, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS pos,
                         unnest(string_split(text, chr(10))) AS line FROM documents))
      WHERE n > 1)
"""


def document_findings(t):
    """Three rules of different tiers over the documents."""
    docs = t.documents.withColumn("collection", F.col("lang")).withColumn("slug", F.col("doc_id"))
    odd = docs.where(~text.fences_balanced(F.col("text"), ","))
    toxic = t.labels.where(F.col("toxic") == 1)
    sources = t.documents.join(toxic, "doc_id", "left_semi").select("source").distinct()
    unknown = refs.dangling(docs, ["source"], sources, ["source"])
    repeated = docs.select("collection", "slug", F.explode(text.repeats(text.lines(F.col("text")))).alias("r"))
    return fd.all_findings(
        fd.finding(odd, tier=fd.SHAPE, code="E302", path="text", message="odd number of commas"),
        fd.finding(
            unknown, tier=fd.OWNER, code="E200", path="source",
            message=F.concat(F.lit("unknown source "), "source"),
        ),
        fd.finding(
            repeated, tier=fd.CATEGORIES, code="E202", message="duplicate line",
            path=F.concat(F.lit("lines."), F.col("r.pos").cast("string")),
        ),
    )


@query(_REPORT + "SELECT collection, slug, tier, code, path, message FROM findings")
def findings_report(t):
    return document_findings(t).drop("suggestion")


@query(
    _REPORT
    + """
    SELECT collection, slug, tier, code, path, message
    FROM (SELECT *, min(tier) OVER (PARTITION BY collection, slug) AS first_tier FROM findings) WHERE tier = first_tier
    """
)
def findings_tiered(t):
    return fd.first_tier(document_findings(t)).drop("suggestion")


@query(
    _REPORT
    + """
    SELECT collection, slug, count(*)::INTEGER AS n,
           array_to_string(list(code || ' ' || path ORDER BY tier, code, path), ', ') AS shown
    FROM findings GROUP BY collection, slug
    """
)
def findings_per_document(t):
    per_document = fd.per_document(document_findings(t))
    shown = F.transform("findings", lambda f: F.concat_ws(" ", f["code"], f["path"]))
    return per_document.select(
        "collection", "slug", F.size("findings").alias("n"), F.array_join(shown, ", ").alias("shown")
    )


@query(
    _REPORT
    + """
    SELECT d.lang AS collection, count(*)::BIGINT AS documents,
           count(*) FILTER (d.doc_id::VARCHAR NOT IN (SELECT slug FROM findings))::BIGINT AS valid
    FROM documents d GROUP BY d.lang
    """
)
def verdict_counts(t):
    entities = t.documents.select(F.col("lang").alias("collection"), F.col("doc_id").alias("slug"))
    return fd.valid_counts(entities, document_findings(t))


@query(
    _REPORT
    + """, titles(code, title) AS (VALUES ('E302', 'Unclosed code block'), ('E200', 'Manufacturer not found'), ('E202', 'Duplicate category'))
    SELECT f.code, t.title, count(*)::BIGINT AS findings FROM findings f JOIN titles t ON t.code = f.code GROUP BY 1, 2
    """
)
def findings_by_title(t):
    counted = document_findings(t).groupBy("code").agg(F.count("*").alias("findings"))
    return fd.with_titles(counted).select("code", "title", "findings")
