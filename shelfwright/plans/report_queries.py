"""Freshness, coverage, link health and translation reports, and the small functions they use."""

from pyspark.sql import functions as F

from shelfwright import fixed_values as fixed
from shelfwright.functions import dates, text, urls
from shelfwright.operators import coverage, freshness as fresh, health, relational as rel, translations
from shelfwright.plans.registry import query
from shelfwright.plans.rule_queries import (
    ENTRIES_SQL, ERROR_SQL, LINKS_SQL, VIDEO_ERROR_SQL, entries, links,
)

# ---------------------------------------------------------------- freshness

_VERIFIED = """
    verified AS (
      SELECT o_orderkey, o_orderstatus AS status,
             CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
                  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'some day'
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
      FROM orders),
    entries AS (
      SELECT o_orderkey, status = 'F' AS discontinued,
             CASE WHEN day = '' THEN 'never' WHEN day = 'some day' THEN 'malformed'
                  WHEN date_diff('day', day::DATE, DATE '2000-01-01') > 180 THEN 'stale' ELSE 'fresh' END AS bucket,
             CASE WHEN day NOT IN ('', 'some day') THEN date_diff('day', day::DATE, DATE '2000-01-01')::INTEGER END AS age_days
      FROM verified)
"""
_PRICES = """
    priced AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS amount, l_returnflag AS currency,
             CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0 THEN 'unknown'
                  ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day
      FROM lineitem),
    prices AS (
      SELECT l_orderkey, l_linenumber, l_partkey, amount, currency,
             CASE WHEN day IS NULL THEN 'never' WHEN day = 'unknown' THEN 'malformed'
                  WHEN date_diff('day', day::DATE, DATE '2000-01-01') > 90 THEN 'stale' ELSE 'fresh' END AS bucket,
             CASE WHEN day <> 'unknown' THEN date_diff('day', day::DATE, DATE '2000-01-01')::INTEGER END AS age_days
      FROM priced)
"""


def _as_of(moment):
    return F.lit(moment).cast("timestamp")


def _entries(t):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    day = (
        F.when(priority == "4-NOT SPECIFIED", "")
        .when((priority == "5-LOW") & (status == "P"), "some day")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    state = F.when(status == "F", "discontinued").otherwise("active")
    rows = t.orders.select("o_orderkey", day.alias("day"), state.alias("state"))
    return fresh.entry_freshness(rows, ["o_orderkey"], "day", "state", _as_of("2000-01-01"))


def _prices(t):
    day = (
        F.when(F.col("l_discount") == 0, F.lit(None))
        .when(F.col("l_tax") == 0, "unknown")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    rows = t.lineitem.select(
        *keys, F.col("l_extendedprice").alias("amount"), F.col("l_returnflag").alias("currency"), day.alias("day")
    )
    return fresh.price_freshness(rows, keys, "day", _as_of("2000-01-01"))


@query(f"WITH {_VERIFIED} SELECT o_orderkey, bucket, age_days, discontinued FROM entries")
def freshness_entries(t):
    return _entries(t)


@query(f"WITH {_PRICES} SELECT * FROM prices")
def freshness_prices(t):
    return _prices(t)


@query(f"WITH {_VERIFIED} SELECT o_orderkey, age_days FROM entries WHERE discontinued")
def discontinued_entries(t):
    return _entries(t).where("discontinued").select("o_orderkey", "age_days")


@query(
    f"""
    WITH {_VERIFIED}, {_PRICES}
    SELECT (SELECT count(*) FROM entries)::BIGINT AS total_entries,
           (SELECT count(*) FROM entries WHERE bucket = 'never')::BIGINT AS never_verified,
           (SELECT count(*) FROM entries WHERE bucket = 'stale')::BIGINT AS stale_entries,
           (SELECT count(*) FROM prices WHERE bucket = 'stale')::BIGINT AS stale_prices,
           (SELECT count(*) FROM prices WHERE bucket = 'never')::BIGINT AS never_priced,
           (SELECT count(*) FROM entries WHERE discontinued)::BIGINT AS discontinued,
           ((SELECT count(*) FROM entries WHERE bucket = 'malformed') + (SELECT count(*) FROM prices WHERE bucket = 'malformed'))::BIGINT
             AS malformed_dates
    """
)
def freshness_summary(t):
    return fresh.freshness_summary(_entries(t), _prices(t))


# ---------------------------------------------------------------- coverage

_ANALYSED = f"""
    {ENTRIES_SQL},
    analysed AS (
      SELECT p_partkey, formats, held, value, held IS NOT NULL AS has_identifiers,
             list_filter(formats, lambda f: f <> 'standalone' AND f IS DISTINCT FROM held) AS missing,
             CASE WHEN held IS NOT NULL THEN {ERROR_SQL} END AS error
      FROM entries)
"""


def _analysed(t):
    return coverage.analysis(entries(t), ["p_partkey"], "formats", "identifiers")


@query(
    f"""
    WITH {_ANALYSED}
    SELECT p_partkey, array_to_string(formats, ',') AS formats, has_identifiers,
           array_to_string(missing, ',') AS missing_formats, coalesce(error, '') AS errors
    FROM analysed
    """
)
def analysis_record(t):
    return _analysed(t).select(
        "p_partkey",
        F.array_join("formats", ",").alias("formats"),
        "has_identifiers",
        F.array_join("missing_formats", ",").alias("missing_formats"),
        F.array_join("invalid_identifiers.error", ",").alias("errors"),
    )


@query(
    f"""
    WITH {_ANALYSED}, used AS (SELECT unnest(formats) AS format, held, value FROM analysed)
    SELECT format, count(*)::BIGINT AS entries_with_format,
           count(*) FILTER (held = format AND value <> '')::BIGINT AS entries_with_identifier,
           round(100.0 * count(*) FILTER (held = format AND value <> '') / count(*))::INTEGER AS coverage_percent
    FROM used WHERE format <> 'standalone' GROUP BY format
    """
)
def coverage_by_format(t):
    return coverage.coverage_by_format(_analysed(t)).orderBy(F.desc("entries_with_format"), "format")


@query(
    f"""
    WITH {_ANALYSED}
    SELECT count(*)::BIGINT AS total, count(*) FILTER (has_identifiers)::BIGINT AS with_identifiers,
           count(*) FILTER (NOT has_identifiers)::BIGINT AS without_identifiers,
           round(100.0 * count(*) FILTER (has_identifiers) / count(*))::INTEGER AS coverage_percent,
           count(error)::BIGINT AS invalid_identifiers
    FROM analysed
    """
)
def coverage_summary(t):
    return coverage.coverage_summary(_analysed(t))


@query(
    f"""
    WITH {_ANALYSED}
    SELECT p_partkey, CASE WHEN list_has_any(formats, {fixed.URGENT_FORMATS}) AND len(missing) > 0 THEN 'high'
                           WHEN len(list_filter(formats, lambda f: f <> 'standalone')) > 0 THEN 'medium' ELSE 'low' END AS priority
    FROM analysed WHERE NOT has_identifiers
    """
)
def priority_buckets(t):
    return coverage.priority(_analysed(t)).select("p_partkey", "priority")


@query(
    f"""
    WITH {_ANALYSED}
    SELECT format, count(*)::BIGINT AS parts FROM (SELECT unnest(missing) AS format FROM analysed) GROUP BY format
    """
)
def missing_formats(t):
    missing = _analysed(t).select(F.explode("missing_formats").alias("format"))
    return rel.count_by(missing, "format", "parts")


# ---------------------------------------------------------------- link checks and their cache

_CHECKS = """
    results AS (
      SELECT event_id, 'https://host/' || user_id AS url, ts AS last_checked,
             CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 301 WHEN 'purchase' THEN 404 WHEN 'signup' THEN 503 END AS status,
             CASE event_type WHEN 'view' THEN 'https://host/moved' END AS redirects_to,
             CASE event_type WHEN 'error' THEN 'timeout' END AS error_message
      FROM events),
    cache AS (
      SELECT *, CASE WHEN status IS NULL THEN 0.25 WHEN status < 300 THEN 7.0 WHEN status < 400 THEN 3.0 ELSE 1.0 END::DOUBLE AS ttl_days,
             date_diff('microsecond', last_checked, TIMESTAMP '2024-02-02 00:00:00') / 86400000000.0 AS age
      FROM results)
"""
_LATEST = _CHECKS + """,
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY last_checked DESC, event_id DESC) AS n
                              FROM cache) WHERE n = 1)
"""
AS_OF = "2024-02-02 00:00:00"


def _results(t):
    """One check per event: the type of the event is the outcome, the user stands for the URL."""
    kind = F.col("event_type")
    status = F.when(kind == "click", 200).when(kind == "view", 301).when(kind == "purchase", 404).when(kind == "signup", 503)
    return t.events.select(
        "event_id",
        F.concat(F.lit("https://host/"), F.col("user_id").cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("last_checked"),
        status.alias("status"),
        F.when(kind == "view", "https://host/moved").alias("redirects_to"),
        F.when(kind == "error", "timeout").alias("error_message"),
    )


def _stamped(t):
    return _results(t).withColumn("ttl_days", health.ttl_days(F.col("status")))


def _latest(t):
    return rel.latest_per_key(_stamped(t), "url", ["last_checked", "event_id"])


@query(f"WITH {_CHECKS} SELECT event_id, ttl_days, age > ttl_days AS expired FROM cache")
def cache_expiry(t):
    expired = health.is_expired(F.col("last_checked"), F.col("ttl_days"), _as_of(AS_OF))
    return _stamped(t).select("event_id", "ttl_days", expired.alias("expired"))


@query(f"WITH {_LATEST} SELECT url, event_id, status, ttl_days FROM latest")
def cache_latest(t):
    empty = _stamped(t).where(F.lit(False))
    return health.put_results(empty, _results(t)).select("url", "event_id", "status", "ttl_days")


@query(f"WITH {_LATEST} SELECT url, event_id FROM latest WHERE age <= ttl_days")
def cache_fresh(t):
    return health.prune(_latest(t), _as_of(AS_OF)).select("url", "event_id")


@query(f"WITH {_LATEST} SELECT (count(*) FILTER (age > ttl_days))::BIGINT AS removed FROM latest")
def cache_prune(t):
    expired = health.is_expired(F.col("last_checked"), F.col("ttl_days"), _as_of(AS_OF))
    return _latest(t).agg(F.count_if(expired).alias("removed"))


@query(
    f"""
    WITH {_LATEST}
    SELECT count(*)::BIGINT AS total_entries,
           count(*) FILTER (age <= ttl_days AND status < 300)::BIGINT AS success_count,
           count(*) FILTER (age <= ttl_days AND (status IS NULL OR status >= 400))::BIGINT AS error_count,
           count(*) FILTER (age <= ttl_days AND status BETWEEN 300 AND 399)::BIGINT AS redirect_count,
           count(*) FILTER (age > ttl_days)::BIGINT AS expired_count
    FROM latest
    """
)
def cache_stats(t):
    return health.cache_stats(_latest(t), _as_of(AS_OF))


_EARLY = "2024-01-02 00:00:00"


@query(
    f"WITH {_LATEST} SELECT url, status FROM latest WHERE age <= ttl_days AND (status IS NULL OR status >= 400)".replace(
        "2024-02-02 00:00:00", _EARLY
    )
)
def cache_broken(t):
    return health.broken(_latest(t), _as_of(_EARLY)).select("url", "status")


@query(
    f"""
    WITH {_LATEST}
    SELECT 'https://host/' || c_custkey AS url, status, l.url IS NULL AS needs_check
    FROM customer c LEFT JOIN (SELECT * FROM latest WHERE age <= ttl_days) l ON l.url = 'https://host/' || c_custkey
    """
)
def cache_lookup(t):
    wanted = t.customer.select(F.concat(F.lit("https://host/"), F.col("c_custkey").cast("string")).alias("url"))
    return health.lookup(wanted, _latest(t), _as_of(AS_OF)).select("url", "status", "needs_check")


_LINK_HEALTH = f"""
    {_CHECKS}, {LINKS_SQL},
    known AS (SELECT l.url, c.status, c.redirects_to, c.error_message, c.age <= c.ttl_days AS valid
              FROM links l JOIN cache c ON c.event_id % (SELECT count(*) FROM pages) = l.page_id
              QUALIFY row_number() OVER (PARTITION BY l.url ORDER BY last_checked DESC, c.event_id DESC) = 1),
    used AS (SELECT DISTINCT file, url FROM links),
    judged AS (
      SELECT u.file, u.url, {VIDEO_ERROR_SQL.replace("url", "u.url")} AS format_message, k.status, k.redirects_to, k.error_message, k.url IS NOT NULL AS hit
      FROM used u LEFT JOIN (SELECT * FROM known WHERE valid) k ON k.url = u.url),
    classified AS (
      SELECT file, url, CASE WHEN format_message IS NULL THEN status END AS status, format_message IS NOT NULL AS format_error,
             format_message IS NULL AND redirects_to IS NOT NULL AS redirected,
             coalesce(format_message, error_message) AS error, format_message IS NULL AND NOT hit AS needs_check,
             format_message IS NOT NULL OR (hit AND (status IS NULL OR status >= 400)) AS broken
      FROM judged)
"""


def _classified(t):
    """Links of the pages; the checks are dealt out to the pages' links by their number."""
    pages = t.pages.agg(F.count("*")).scalar()
    stamped = _stamped(t).drop("url").withColumn("page_id", F.col("event_id") % pages)
    checks = links(t).join(stamped, "page_id")
    cache = rel.latest_per_key(
        checks.select("url", "last_checked", "event_id", "status", "redirects_to", "error_message", "ttl_days"),
        "url",
        ["last_checked", "event_id"],
    ).drop("event_id")
    return health.classify_links(links(t), cache, _as_of("2024-01-02 00:00:00"))


@query(
    "WITH " + _LINK_HEALTH.replace("2024-02-02 00:00:00", "2024-01-02 00:00:00") + "SELECT * FROM classified"
)
def link_health(t):
    return _classified(t)


@query(
    "WITH "
    + _LINK_HEALTH.replace("2024-02-02 00:00:00", "2024-01-02 00:00:00")
    + """
    SELECT count(DISTINCT file)::BIGINT AS files_checked, count(*)::BIGINT AS urls_checked,
           count(*) FILTER (broken)::BIGINT AS broken, count(*) FILTER (NOT broken AND redirected)::BIGINT AS redirected
    FROM classified
    """
)
def link_stats(t):
    return health.link_stats(_classified(t))


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN value > 50 THEN 200 ELSE 404 END AS status
    FROM events
    """
)
def status_collapse(t):
    status = F.when(F.col("value") > 50, 200).otherwise(404)
    return t.events.select(
        "event_id", health.cached_status(status, F.col("event_type") == "error").alias("status")
    )


# ---------------------------------------------------------------- translations


@query(
    """
    SELECT count(DISTINCT source)::BIGINT AS files_with_translations, count(*)::BIGINT AS total_translations,
           count(DISTINCT lang)::BIGINT AS locales_used,
           (count(DISTINCT lang) FILTER (lang NOT IN ('de', 'fr')))::BIGINT AS unapproved_locales
    FROM documents
    """
)
def translation_stats(t):
    approved = t.spark.createDataFrame([("de",), ("fr",)], "code string")
    return translations.translation_stats(t.documents, ["source"], "lang", approved, "code")


@query(
    """
    SELECT doc_id, lang FROM documents WHERE lang NOT IN ('de', 'fr')
    """
)
def translation_locales(t):
    approved = t.spark.createDataFrame([("de",), ("fr",)], "code string")
    return translations.unapproved(t.documents, "lang", approved, "code").select("doc_id", "lang")


@query(
    """
    SELECT doc_id, unnest(list_filter(CASE WHEN lang = 'de' THEN ['description', 'title', 'website'] ELSE ['details', lang] END,
                                      lambda f: f NOT IN ('description', 'website'))) AS field
    FROM documents
    """
)
def translation_fields(t):
    fields = F.when(
        F.col("lang") == "de", F.array(F.lit("description"), F.lit("title"), F.lit("website"))
    ).otherwise(F.array(F.lit("details"), F.col("lang")))
    unknown = translations.unknown_fields(fields, ["description", "website"])
    return t.documents.select("doc_id", F.explode(unknown).alias("field"))


# ---------------------------------------------------------------- functions


@query(
    """
    SELECT l_partkey, count(*) FILTER (l_returnflag = 'R')::BIGINT AS returned,
           floor(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*) + 0.5)::INTEGER AS percent
    FROM lineitem GROUP BY l_partkey
    """
)
def round_percent(t):
    returned = F.count_if(F.col("l_returnflag") == "R")
    return t.lineitem.groupBy("l_partkey").agg(
        returned.alias("returned"), text.rounded_percent(returned, F.count("*")).alias("percent")
    )


@query(
    """
    SELECT p_partkey, unnest(parts) AS key, try_cast(nullif(regexp_extract(unnest(parts), '^[0-9]+'), '') AS INTEGER) AS index
    FROM (SELECT p_partkey, string_split(p_type || '.' || p_size || '.' || p_name, '.') AS parts FROM part)
    """
)
def path_parse(t):
    path = F.concat_ws(".", "p_type", F.col("p_size").cast("string"), "p_name")
    parts = t.part.select("p_partkey", F.explode(text.path_parts(path)).alias("part"))
    return parts.select("p_partkey", "part.key", "part.index")


@query(
    """
    SELECT p_partkey, lower(p_type) AS lowered, trim('  ' || p_name || ' ') AS trimmed, replace(p_name, ' ', '_') AS replaced,
           starts_with(p_name, 'red') AS is_red, p_brand[7:] AS brand_number, p_name[1] AS initial
    FROM part
    """
)
def string_primitives(t):
    return t.part.select(
        "p_partkey",
        F.lower("p_type").alias("lowered"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("replaced"),
        F.startswith("p_name", F.lit("red")).alias("is_red"),
        F.expr("substr(p_brand, 7)").alias("brand_number"),
        F.substring("p_name", 1, 1).alias("initial"),
    )


@query(
    """
    SELECT p_partkey, list_contains(words, 'red') AS has_red, len(list_filter(words, lambda w: length(w) > 4)) > 0 AS any_long,
           len(list_filter(words, lambda w: length(w) <= 4)) = 0 AS all_long,
           array_to_string(list_filter(words, lambda w: w <> 'red'), ' ') AS others
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
    """
)
def array_predicates(t):
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.array_contains(words, "red").alias("has_red"),
        F.exists(words, lambda w: F.length(w) > 4).alias("any_long"),
        F.forall(words, lambda w: F.length(w) > 4).alias("all_long"),
        F.array_join(F.filter(words, lambda w: w != "red"), " ").alias("others"),
    )


@query(
    """
    SELECT event_id, floor(date_diff('microsecond', ts, TIMESTAMP '2024-01-15 06:00:00') / 86400000000.0)::INTEGER AS days,
           round(date_diff('microsecond', ts, TIMESTAMP '2024-01-15 06:00:00') / 86400000000.0, 6) AS age
    FROM events
    """
)
def day_age(t):
    at, as_of = F.col("ts").cast("timestamp"), _as_of("2024-01-15 06:00:00")
    return t.events.select(
        "event_id", dates.whole_days(at, as_of).alias("days"), F.round(dates.age_days(at, as_of), 6).alias("age")
    )


@query(
    """
    SELECT page_id, starts_with(url, 'http://') OR starts_with(url, 'https://') AS is_http,
           regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host
    FROM pages
    """
)
def url_parts(t):
    return t.pages.select(
        "page_id", urls.is_http(F.col("url")).alias("is_http"), urls.host_of(F.col("url")).alias("host")
    )
