"""Term search over the documents."""

from pyspark.sql import functions as F

from shelfwright.functions import stemming
from shelfwright.operators import search
from shelfwright.plans.registry import query

_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}\p{M}]+'), lambda t: t <> '')"


@query(f"SELECT doc_id FROM documents WHERE list_contains({_TOKENS}, 'with')")
def search_term(t):
    return t.documents.where(search.has_all_terms(F.col("text"), ["with"])).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE list_has_all({_TOKENS}, ['that', 'with'])")
def search_and(t):
    return t.documents.where(search.has_all_terms(F.col("text"), ["that", "with"])).select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE len(list_filter({_TOKENS}, lambda t: starts_with(t, 'the'))) > 0")
def search_prefix(t):
    return t.documents.where(search.has_prefix(F.col("text"), "the")).select("doc_id")


@query(
    f"""
    SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    WHERE d.doc_id IN (SELECT doc_id FROM documents WHERE len(list_filter({_TOKENS}, lambda t: starts_with(t, 'est'))) > 0)
    """
)
def search_join(t):
    found = t.documents.where(search.has_prefix(F.col("text"), "est")).select("doc_id", "source")
    return found.join(t.labels, "doc_id").select("doc_id", "source", "quality")


@query(
    f"""
    SELECT term, count(DISTINCT doc_id)::BIGINT AS docs
    FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents) GROUP BY term
    """
)
def search_index_terms(t):
    postings = search.plain_postings(t.documents, "doc_id", ["text"])
    return postings.groupBy("term").agg(F.count("*").alias("docs"))


@query(
    f"""
    WITH held AS (SELECT doc_id, {_TOKENS} AS terms FROM documents)
    SELECT doc_id FROM held
    WHERE list_contains(terms, 'that') AND len(list_filter(terms, lambda t: starts_with(t, 'wit'))) > 0
    """
)
def search_terms_and_prefix(t):
    postings = search.plain_postings(t.documents, "doc_id", ["text"])
    terms = search.query_terms("That wit", stemmed=False)
    return search.matching_docs(postings, terms, prefix=True).withColumnRenamed("doc", "doc_id")


# ---------------------------------------------------------------- the stemmer in SQL, a step per CTE


def _marked(word):
    """The word with Y for each y that is a consonant: at the start, after a vowel, after a y that is a vowel."""
    return f"regexp_replace(regexp_replace({word}, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g')"


def _has(word, pattern):
    return f"regexp_matches({_marked(word)}, '{pattern}')"


_VOWEL, _ONE, _TWO = "[aeiouy]", "[aeiouy][^aeiouy]", "[aeiouy][^aeiouy]+[aeiouy]+[^aeiouy]"
_CVC = "[^aeiouy][aeiouy][^aeiouywxY]$"


def _without(n, word="w"):
    return f"left({word}, length({word}) - {n})"


def _restored(stem):
    """A stem after 'ed' or 'ing' went."""
    return f"""CASE WHEN regexp_matches({stem}, '(at|bl|iz)$') THEN {stem} || 'e'
      WHEN right({stem}, 1) = left(right({stem}, 2), 1) AND length({stem}) > 1 AND {_has(stem, "[^aeiouy]$")}
           AND NOT regexp_matches({stem}, '[lsz]$') THEN {_without(1, stem)}
      WHEN {_has(stem, _ONE)} AND NOT {_has(stem, _TWO)} AND {_has(stem, _CVC)} THEN {stem} || 'e' ELSE {stem} END"""


def _by_suffix(pairs, measure, extra=""):
    """The longest suffix that fits is replaced where what stands before it is long enough."""
    ordered = sorted(pairs, key=lambda pair: -len(pair[0]))
    cases = " ".join(
        f"WHEN ends_with(w, '{old}') THEN CASE WHEN {_has(_without(len(old)), measure)}"
        f"{extra if old == 'ion' else ''} THEN {_without(len(old))} || '{new}' ELSE w END"
        for old, new in ordered
    )
    return f"CASE {cases} ELSE w END"


_STEPS = [
    f"""CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {_without(2)}
        WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN {_without(1)} ELSE w END""",
    f"""CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_has(_without(3), _ONE)} THEN {_without(1)} ELSE w END
        WHEN ends_with(w, 'ed') THEN CASE WHEN {_has(_without(2), _VOWEL)} THEN {_restored(_without(2))} ELSE w END
        WHEN ends_with(w, 'ing') THEN CASE WHEN {_has(_without(3), _VOWEL)} THEN {_restored(_without(3))} ELSE w END
        ELSE w END""",
    f"CASE WHEN ends_with(w, 'y') AND {_has(_without(1), _VOWEL)} THEN {_without(1)} || 'i' ELSE w END",
    _by_suffix(stemming.STEP_2, _ONE),
    _by_suffix(stemming.STEP_3, _ONE),
    _by_suffix([(suffix, "") for suffix in stemming.STEP_4], _TWO, f" AND regexp_matches({_without(3)}, '[st]$')"),
    f"""CASE WHEN ends_with(w, 'e') AND ({_has(_without(1), _TWO)} OR ({_has(_without(1), _ONE)} AND NOT {_has(_without(1), _CVC)}))
        THEN {_without(1)} ELSE w END""",
    f"CASE WHEN ends_with(w, 'll') AND {_has(_without(1), _TWO)} THEN {_without(1)} ELSE w END",
]


def _stemmed_sql():
    chain, last = [], "words"
    for i, step in enumerate(_STEPS):
        chain.append(f"step{i} AS (SELECT term, plain, CASE WHEN plain THEN {step} ELSE w END AS w FROM {last})")
        last = f"step{i}"
    split = _TOKENS.replace("lower(text)", "lower(value)")
    return f"""
    WITH fields AS (SELECT doc_id, 'text' AS field, text AS value FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents),
    held AS MATERIALIZED (SELECT DISTINCT doc_id, field, unnest({split}) AS term FROM fields),
    words AS (SELECT term, strip_accents(term) AS w, regexp_full_match(strip_accents(term), '[a-z]{{3,}}') AS plain
              FROM (SELECT DISTINCT term FROM held)),
    {", ".join(chain)},
    forms AS MATERIALIZED (SELECT term, w AS form FROM {last})
    SELECT form AS term, count(*)::BIGINT AS docs
    FROM (SELECT DISTINCT doc_id, field, form FROM held JOIN forms ON held.term = forms.term) GROUP BY form
    """


@query(_stemmed_sql())
def search_stemmed(t):
    postings = search.stemmed_postings(t.documents, "doc_id", ["text", "source"])
    return postings.groupBy("term").agg(F.count("*").alias("docs"))


@query(
    f"""
    WITH after AS (
      SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'withdrawn ' || d.text ELSE d.text END AS text
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(l.quality, 1) <> 0)
    SELECT term, count(*)::BIGINT AS docs
    FROM (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS term FROM after) GROUP BY term
    """
)
def index_maintenance(t):
    labelled = t.documents.join(t.labels, "doc_id").select("doc_id", "text", "quality", "toxic")
    removed = labelled.where(F.col("quality") == 0)
    changed = labelled.where((F.col("toxic") == 1) & (F.col("quality") != 0)).select(
        "doc_id", F.concat(F.lit("withdrawn "), "text").alias("text")
    )
    before = search.plain_postings(t.documents, "doc_id", ["text"])
    after = search.replace_docs(before, changed, removed, "doc_id", ["text"])
    return after.groupBy("term").agg(F.count("*").alias("docs"))


@query(
    f"""
    SELECT s_suppkey FROM supplier s LEFT JOIN nation ON s_nationkey = n_nationkey
    WHERE list_has_all(list_filter(regexp_split_to_array(lower(s_name || ' ' || coalesce(n_name, '')),
      '[^\\p{{L}}\\p{{N}}\\p{{M}}]+'), lambda t: t <> ''), ['supplier', '7'])
    """
)
def search_fields(t):
    # terms of one query may be found in different fields
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    postings = search.plain_postings(joined, "s_suppkey", ["s_name", "n_name"])
    return search.matching_docs(postings, ["supplier", "7"]).select(F.col("doc").alias("s_suppkey"))
