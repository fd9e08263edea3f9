"""Line dedup by site-relative frequency, in DataFrame expressions only.

For each site, the pages that hold a line are divided by the site's pages; lines above ``ratio`` are
boilerplate and are dropped from all pages of the site. A line must be on ``least`` pages, two by default: a
line of one page repeats nothing, however few pages its site has. A line is compared without ASCII white space
at its ends, by two 64-bit hashes; blank lines stay.

A page holds a line once, however often it comes up there, so counts by (site, line) are sums that are combined
before the shuffle, and neither a hot site nor a hot line meets in one task. What is dropped comes back as one
list per site (at most lines-per-page / ratio keys; on a site of a few pages, the lines that two of them share),
broadcast while all lists together are under ``broadcast_bytes`` and joined by site beyond it.

Defined cases: a NULL site is a site of its own; a NULL text stays NULL and counts like an empty one, as a page
without lines; each row is a page, repeated rows too; other columns, of any name, are kept. ``counts`` must name
columns that ``pages`` does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwright.llm.files import new_folder
from shelfwright.session import durable

RATIO = 0.1
LEAST = 2
BROADCAST_BYTES = 8 << 20

BLANK = " \t\n\u000b\f\r"


def line_key(line: Column) -> Column:
    """Two hashes of a line without white space at its ends; NULL for a blank line."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b")))


def boilerplate(pages: DataFrame, site_col: str, text_col: str, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """Per site, the keys of its boilerplate lines: (site, lines)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # every page has a blank line at least (a NULL key), which counts the site's pages in the same pass
    keys = F.array_distinct(F.transform(F.split(F.concat(text, F.lit("\n")), "\n"), line_key))
    lines = pages.select(F.col(site_col).alias("site"), F.explode_outer(keys).alias("line"))
    counts = durable(
        lines.groupBy("site", "line")
        .agg(F.count("*").alias("n"))
        .filter((F.col("n") >= least) | F.col("line").isNull())
    )
    totals = counts.filter("line IS NULL").select(F.col("site").alias("of"), F.col("n").alias("pages"))
    return (
        counts.filter("line IS NOT NULL")
        .join(totals, F.col("site").eqNullSafe(F.col("of")))
        .filter((F.col("n") >= least) & (F.col("n") > ratio * F.col("pages")))
        .groupBy("site")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    pages: DataFrame,
    site_col: str,
    text_col: str = "text",
    ratio: float = RATIO,
    least: int = LEAST,
    broadcast_bytes: int = BROADCAST_BYTES,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """The pages without their boilerplate lines; ``counts`` names two columns for lines and dropped lines."""
    if counts and set(counts) & set(pages.columns):
        raise ValueError(f"columns {counts} must be new")
    lists = durable(boilerplate(pages, site_col, text_col, ratio, least).select(F.col("site").alias("_site"), F.col("lines").alias("_lines")))
    size = lists.agg(F.sum(F.size("_lines") * 24 + F.coalesce(F.octet_length("_site"), F.lit(0)) + 32).alias("n")).first()["n"] or 0
    lists = F.broadcast(lists) if size <= broadcast_bytes else lists
    # the page travels as one struct, so that its columns may have any names
    rows = pages.select(F.struct("*").alias("row"), F.col(site_col).alias("s"), F.split(F.col(text_col), "\n").alias("all"))
    joined = rows.join(lists, F.col("s").eqNullSafe(F.col("_site")), "left")
    kept = F.filter("all", lambda x: F.coalesce(~F.array_contains("_lines", line_key(x)), F.lit(True)))
    joined = joined.withColumn("kept", F.when(F.col("_lines").isNull(), F.col("all")).otherwise(kept))
    more = [F.coalesce(F.size("all"), F.lit(0)), F.coalesce(F.size("all") - F.size("kept"), F.lit(0))] if counts else []
    return joined.select(
        *[F.array_join("kept", "\n").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in pages.columns],
        *[c.cast("long").alias(name) for c, name in zip(more, counts or ())],
    )


def html_lines(html: Column) -> Column:
    """The text of a page, a line for each piece between tags; scripts, styles and comments are left out."""
    for pattern in (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->"):
        html = F.regexp_replace(html, pattern, "\n")
    # nothing that is taken here is ever given back, so that a run of tags of any length needs no stack
    return F.btrim(F.regexp_replace(html, r"\s*+(?:<[^>]*+>\s*+)++", "\n"), F.lit(BLANK))


def page_lines(pages: DataFrame) -> DataFrame:
    """``(page_id, host, text)`` of pages ``(page_id, url, html)``, stored in the shared folder: the lines are counted in one pass and
    dropped in another, and finding them takes longer than reading them again."""
    folder = new_folder(pages.sparkSession, "page-lines")
    lines = pages.select("page_id", host_of(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))
    lines.write.parquet(folder)
    return pages.sparkSession.read.schema(lines.schema).parquet(folder)


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL; NULL without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)
