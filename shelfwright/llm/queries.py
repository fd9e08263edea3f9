"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def register(sql: str | None = None) -> Callable:
    """Register a query under its function name."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


@register()
def op10_repetition(spark: SparkSession, folder: str) -> DataFrame:
    """Word, symbol, line and repeat counts of every document, and whether the rules keep it."""
    from shelfwright.llm.repetition import repetition_stats

    stats = repetition_stats(table(spark, folder, "documents").select("doc_id", "text"))
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "covered_words", "longest_repeat", "base_failed", "kept",
    )


@register()
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every whole document."""
    import public_tokenizers

    from shelfwright.llm.tokens import LIMIT, token_counts

    counts = token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "n_chunks", "n_widened"
    )


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
RULED = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {RULED} AS w FROM documents),
i AS MATERIALIZED (SELECT item_id, {RULED} AS w FROM benchmark),
iw AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, w[s : s + least(len(w), 13) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, n, w[s : s + n - 1] AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, s, dw.n AS n FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
p AS (SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS keys
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(keys, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""


@register(CONTAMINATION)
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a window of a benchmark item."""
    from shelfwright.llm.winnowing import contamination

    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SITE_LINES = r"""
WITH p AS MATERIALIZED (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host,
    string_split(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '<script[^>]*>.*?</script>', chr(10), 'gis'), '<style[^>]*>.*?</style>', chr(10), 'gis'),
      '<!--.*?-->', chr(10), 'gs'), '(?:\s*<[^>]*>\s*)+', chr(10), 'g'), BLANKS), chr(10)) AS lines
  FROM pages),
l AS MATERIALIZED (SELECT page_id, host, pos, line, trim(line, BLANKS) AS bare
  FROM (SELECT page_id, host, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM p)),
b AS (SELECT host, bare, count(DISTINCT page_id) AS n FROM l WHERE bare <> '' GROUP BY host, bare),
t AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
x AS (SELECT b.host, bare FROM b JOIN t ON b.host IS NOT DISTINCT FROM t.host WHERE n >= 2 AND n > 0.1 * pages),
k AS (SELECT l.*, x.bare IS NOT NULL AS gone
      FROM l LEFT JOIN x ON l.host IS NOT DISTINCT FROM x.host AND l.bare = x.bare)
SELECT p.page_id, p.host, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS text_or_null,
  count(pos) AS n_lines, count(*) FILTER (gone) AS n_dropped
FROM p LEFT JOIN k ON p.page_id = k.page_id GROUP BY p.page_id, p.host, p.lines
"""
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@register(
    "SELECT page_id, host, n_lines, n_dropped, CASE WHEN n_lines > 0 THEN coalesce(text_or_null, '') END AS text FROM ("
    + SITE_LINES.replace("BLANKS", BLANKS)
    + ")"
)
def op4_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The text of every page without the lines that its host repeats."""
    from shelfwright.llm.site_lines import drop_boilerplate, page_lines

    return drop_boilerplate(page_lines(table(spark, folder, "pages")), "host", counts=("n_lines", "n_dropped"))


RECORDS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
             CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""


@register(RECORDS)
def op5_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    """A WARC record per page, read back through the merged capture index."""
    from shelfwright.llm.archives import capture_history

    # the table has no capture time; ids stand for seconds
    time = F.lit(1_700_000_000) + F.col("page_id")
    found = capture_history(table(spark, folder, "pages"), "page_id", "url", "html", time)
    return found.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register()
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document a mix to the target weights takes."""
    from shelfwright.llm.mixing import taken_words

    return taken_words(table(spark, folder, "documents"))


@register()
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate component of every document, on two-word shingles."""
    from shelfwright.llm.minhash import near_components

    return near_components(table(spark, folder, "documents"), shingle=2)


SPLIT = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

REPEATS = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {SPLIT} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20),
x AS MATERIALIZED (SELECT doc_id, s, sha256(array_to_string(w[s : s + 19], ' ')) AS k FROM p),
f AS (SELECT k, min(struct_pack(a := doc_id, b := s)) AS first FROM x GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place
      FROM x JOIN f ON x.k = f.k WHERE struct_pack(a := doc_id, b := s) <> first),
u AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM d),
c AS (SELECT u.doc_id, count(g.place) AS n_removed, string_agg(word, ' ' ORDER BY u.place) FILTER (g.place IS NULL) AS kept
      FROM u LEFT JOIN g ON u.doc_id = g.doc_id AND u.place = g.place GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c ON d.doc_id = c.doc_id
"""


@register(REPEATS)
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that no earlier window of twenty words repeats."""
    from shelfwright.llm.superkmers import without_repeats

    kept = without_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register()
def op9_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a trigram model of nine tenths of them."""
    from shelfwright.llm.kneser_ney import held_out, scored, train

    docs = table(spark, folder, "documents")
    model = train(docs.filter(~held_out("doc_id")))
    scores = scored(docs, model).withColumn("held_out", held_out("doc_id"))
    return scores.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


@register()
def op2_private_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every whole document, by patterns and by the trained tagger."""
    from shelfwright.llm.private_data import private_spans, train_tagger

    docs = table(spark, folder, "documents")
    found = private_spans(docs, train_tagger(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["pattern"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in ("email", "ip", "card", "phone")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@register()
def op11_streaming_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every whole text's tokens, and of the text they decode to."""
    import public_tokenizers

    from shelfwright.llm.transducer import encoded_texts

    found = encoded_texts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@register()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the first four components of the distinct ones, whitened."""
    from shelfwright.llm.whitening import fit_whitening, whitened

    vectors = table(spark, folder, "embeddings")
    return whitened(vectors, fit_whitening(vectors))


PHRASES = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
             regexp_extract_all(unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
s AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 6) AS t(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
u AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (
        SELECT 1 FROM f AS o WHERE o.lang = f.lang AND o.k > f.k AND 100 * o.a >= 100 * f.a
          AND contains(' ' || o.phrase || ' ', ' ' || f.phrase || ' '))),
c AS (SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 :], ' ') AS tail
      FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM u)),
x AS (SELECT c.lang, c.phrase, c.a, j, b.a AS l, e.a AS r, n, (1000 * c.a * n) // (b.a * e.a) AS score
      FROM c JOIN f AS b ON c.lang = b.lang AND head = b.phrase JOIN f AS e ON c.lang = e.lang AND tail = e.phrase
        JOIN s ON c.lang = s.lang),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, CAST(phrase AS BLOB)) AS rank FROM y)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score
FROM z WHERE rank <= 2000
"""


@register(PHRASES)
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest phrases of each language."""
    from shelfwright.llm.collocations import collocations

    return collocations(table(spark, folder, "documents"))
