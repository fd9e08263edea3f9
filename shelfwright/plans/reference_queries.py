"""References, vocabularies, nearest terms and duplicates."""

from pyspark.sql import functions as F

from shelfwright.functions import text
from shelfwright.operators import nearest, ordered, references as refs
from shelfwright.plans.registry import query


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    """
)
def dangling_reference(t):
    known = t.customer.where(F.col("c_acctbal") >= 0)
    return refs.dangling(t.orders, ["o_custkey"], known, ["c_custkey"]).select("o_orderkey", "o_custkey")


@query(
    """
    WITH items AS (SELECT p_partkey, p_brand AS collection, p_partkey // 2 AS supersedes FROM part)
    SELECT a.p_partkey, a.collection, a.supersedes FROM items a
    WHERE NOT EXISTS (SELECT 1 FROM items b WHERE b.collection = a.collection AND b.p_partkey = a.supersedes)
    """
)
def dangling_same_collection(t):
    items = t.part.select(
        "p_partkey", F.col("p_brand").alias("collection"), F.expr("p_partkey div 2").alias("supersedes")
    )
    return refs.dangling(items, ["collection", "supersedes"], items, ["collection", "p_partkey"])


@query(
    """
    SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey FROM lineitem r
    WHERE r.l_returnflag = 'R' AND NOT EXISTS (
      SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'R' AND p.l_partkey = r.l_partkey AND p.l_suppkey = r.l_suppkey)
    """
)
def dangling_composite(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    translated = t.lineitem.where(F.col("l_returnflag") == "R").select(*columns)
    ports = t.lineitem.where(F.col("l_returnflag") != "R")
    pair = ["l_partkey", "l_suppkey"]
    return refs.dangling(translated, pair, ports, pair)


_SPLIT = r"unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{M}]+'), lambda t: t <> ''))"
_TOKENS = f"tokens AS MATERIALIZED (SELECT DISTINCT {_SPLIT} AS token, lang FROM documents)"


def _tokens(t):
    found = F.array_distinct(text.tokens(F.col("text")))
    return t.documents.select(F.explode(found).alias("token"), "lang").distinct()


def _by_bytes(word):
    """The word with a byte for each letter, as the database compares bytes; covers the four languages' letters."""
    return f"translate({word}, 'àâäáèéêëíìîïñóòôöùúûüçßœæ', '!#$%&()*+,-./:;<=>?@[]^_{{|')"


@query(
    f"""
    WITH {_TOKENS},
    options AS (SELECT word, min(p_partkey) AS pos
                FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_partkey FROM part) GROUP BY word),
    inputs AS (SELECT DISTINCT token FROM tokens WHERE token NOT IN (SELECT word FROM options)),
    scored AS (SELECT token, word, pos, levenshtein({_by_bytes("token")}, {_by_bytes("word")}) AS d FROM inputs, options
               WHERE abs(length(token) - length(word)) <= 3)
    SELECT token, arg_min(word, (d, pos, word)) AS suggestion, min(d)::INTEGER AS distance
    FROM scored WHERE d <= 3 GROUP BY token
    """
)
def nearest_term(t):
    options = (
        t.part.select(F.explode(F.split("p_name", " ")).alias("word"), "p_partkey")
        .groupBy("word")
        .agg(F.min("p_partkey").alias("pos"))
    )
    unknown = _tokens(t).select("token").distinct().join(
        options, F.col("token") == F.col("word"), "left_anti"
    )
    return nearest.nearest_option(unknown, "token", options, "word", "pos")


@query(
    f"""
    WITH {_TOKENS}
    SELECT token, count(*)::BIGINT AS languages FROM tokens
    WHERE token IN (SELECT {_SPLIT} FROM benchmark) GROUP BY token
    """
)
def vocabulary_membership(t):
    words = t.benchmark.select(F.explode(F.array_distinct(text.tokens(F.col("text")))).alias("token")).distinct()
    known = _tokens(t).join(words, "token", "left_semi")
    return known.groupBy("token").agg(F.count("*").alias("languages"))


@query(
    f"""
    WITH {_TOKENS},
    vocabulary AS (SELECT DISTINCT token AS term FROM tokens WHERE lang = 'en'),
    grouped AS (SELECT token AS member, count(DISTINCT lang) AS n FROM tokens WHERE lang <> 'en' GROUP BY token)
    SELECT coalesce(term, member) AS term,
           CASE WHEN member IS NULL THEN 'unmapped' WHEN term IS NULL THEN 'orphan' ELSE 'multi_mapped' END AS status
    FROM vocabulary FULL OUTER JOIN grouped ON term = member
    WHERE member IS NULL OR term IS NULL OR n > 1
    """
)
def vocabulary_reconcile(t):
    found = _tokens(t)
    vocabulary = found.where(F.col("lang") == "en")
    grouped = found.where(F.col("lang") != "en")
    return refs.reconcile(vocabulary, "token", grouped, "token", "lang")


@query(
    f"""
    WITH {_TOKENS}
    SELECT token, count(DISTINCT lang)::BIGINT AS groups, min(lang) AS first_group, max(lang) AS last_group
    FROM tokens GROUP BY token HAVING count(DISTINCT lang) > 1
    """
)
def multi_mapped(t):
    return refs.multi_mapped(_tokens(t), "token", "lang")


@query(
    f"""
    WITH {_TOKENS}
    SELECT lang, token FROM tokens WHERE lang <> 'en' AND token IN (SELECT token FROM tokens WHERE lang = 'en')
    """
)
def group_members_known(t):
    found = _tokens(t)
    return refs.known_members(
        found.where(F.col("lang") != "en"), "token", found.where(F.col("lang") == "en"), "token"
    ).select("lang", "token")


@query(
    """
    WITH known AS (SELECT p_name AS term FROM part UNION SELECT p_type FROM part UNION SELECT p_brand FROM part)
    SELECT term FROM known
    """
)
def vocabulary_sets(t):
    parts = [t.part.select(F.col(c).alias("term")) for c in ("p_name", "p_type", "p_brand")]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query(
    """
    WITH brands AS (SELECT p_type, list_sort(list(DISTINCT p_brand)) AS options FROM part GROUP BY p_type)
    SELECT p_type, CASE WHEN len(options) <= 10 THEN array_to_string(options, ', ')
      ELSE array_to_string(options[1:10], ', ') || ', ... (' || len(options) || ' total)' END AS shown
    FROM brands
    """
)
def option_list(t):
    return refs.options_by_group(t.part, "p_type", "p_brand")


@query(
    """
    WITH lines AS (
      SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS pos,
             unnest(string_split(text, chr(10))) AS value FROM documents)
    SELECT doc_id, pos, value FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id, value ORDER BY pos) AS n FROM lines) WHERE n > 1
    """
)
def duplicate_in_list(t):
    found = t.documents.select("doc_id", F.explode(text.repeats(text.lines(F.col("text")))).alias("r"))
    return found.select("doc_id", "r.pos", "r.value")


@query(
    """
    SELECT doc_id, parts[1] AS first_line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
    WHERE list_contains(parts[2:], parts[1])
    """
)
def primary_in_list(t):
    split = t.documents.select("doc_id", text.lines(F.col("text")).alias("parts"))
    rest = F.expr("slice(parts, 2, size(parts))")
    first = F.col("parts")[0]
    return split.where(F.array_contains(rest, first)).select("doc_id", first.alias("first_line"))


@query(
    """
    SELECT * FROM (
      SELECT md5(text) AS id, lag(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS previous, doc_id
      FROM documents)
    WHERE previous IS NOT NULL
    """
)
def duplicate_id_pairs(t):
    keyed = t.documents.select(F.md5("text").alias("id"), "doc_id")
    paired = ordered.with_previous(keyed, ["id"], ["doc_id"], "doc_id")
    return paired.where(F.col("previous").isNotNull())


@query("SELECT md5(text) AS id, count(*)::BIGINT AS uses FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(t):
    return refs.duplicate_keys(t.documents.select(F.md5("text").alias("id")), ["id"])


_IDS = """
    WITH ids AS (
      SELECT d.doc_id, d.lang AS collection, CASE WHEN l.quality = 0 THEN NULL WHEN l.toxic = 1 THEN '' ELSE md5(d.text) END AS id
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""


def documents_with_ids(t):
    """Documents whose id is missing where the label says low quality, and empty where toxic."""
    id_ = F.when(F.col("quality") == 0, F.lit(None)).when(F.col("toxic") == 1, "").otherwise(F.md5("text"))
    return t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.col("lang").alias("collection"), id_.alias("id")
    )


@query(
    _IDS
    + """
    SELECT collection, count(*) FILTER (id <> '')::BIGINT AS with_ids,
           count(*) FILTER (id IS NULL)::BIGINT AS without_ids,
           (count(*) FILTER (id <> '') - count(DISTINCT id) FILTER (id <> ''))::BIGINT AS duplicates
    FROM ids GROUP BY collection
    """
)
def id_stats(t):
    # each later holder of an id is one duplicate: holders minus distinct ids, counted in two
    # steps so that an id held by many is combined before it is shuffled
    per_id = documents_with_ids(t).groupBy("collection", "id").agg(F.count("*").alias("n"))
    valid = F.col("id") != ""
    return per_id.groupBy("collection").agg(
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).cast("bigint").alias("with_ids"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("without_ids"),
        F.coalesce(F.sum(F.when(valid, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("duplicates"),
    )


@query(
    _IDS
    + """
    SELECT collection, count(*) FILTER (coalesce(id, '') = '')::BIGINT AS assigned,
           count(*) FILTER (id <> '')::BIGINT AS skipped FROM ids GROUP BY collection
    """
)
def assign_stats(t):
    blank = text.is_blank(F.col("id"))
    return documents_with_ids(t).groupBy("collection").agg(
        F.count_if(blank).alias("assigned"), F.count_if(~blank).alias("skipped")
    )


@query(
    """
    SELECT p_partkey, lower(p_name) AS name, levenshtein(lower(p_name), lower(p_type))::INTEGER AS distance FROM part
    """
)
def edit_distance(t):
    return t.part.select(
        "p_partkey",
        F.lower("p_name").alias("name"),
        F.levenshtein(F.lower("p_name"), F.lower("p_type")).alias("distance"),
    )
