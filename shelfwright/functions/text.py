"""String and list functions: slugs, tokens, marker parity, option lists, path parsing."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from shelfwright import fixed_values as fixed

LINE_BREAK = "\n"
OUTSIDE_TOKENS = r"[^\p{L}\p{N}\p{M}]"


def slug_of(name: Column) -> Column:
    """Lower-case key of a display name: letters, digits and single inner hyphens."""
    kept = F.regexp_replace(F.lower(name), r"[^a-z0-9\s-]", "")
    hyphenated = F.regexp_replace(F.regexp_replace(kept, r"\s+", "-"), "-+", "-")
    return F.regexp_replace(hyphenated, r"\A-|-\z", "")


def is_slug(value: Column) -> Column:
    return value.rlike(fixed.SLUG_PATTERN)


def paragraphs(parts: Column) -> Column:
    """A list of paragraphs as one text; NULL stays NULL."""
    return F.array_join(parts, "\n\n")


def is_blank(value: Column) -> Column:
    """Absent or empty: the test that treats '' like a missing value."""
    return F.coalesce(value, F.lit("")) == ""


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters, digits and combining marks."""
    return F.array_remove(F.split(F.lower(text), OUTSIDE_TOKENS + "+"), "")


def token_list(text: str) -> list[str]:
    """The tokens of a query text, as :func:`tokens` finds them in a column."""
    kept = "".join(c if unicodedata.category(c)[0] in "LNM" else " " for c in text.lower())
    return kept.split()


def has_token(text: Column, token: str, prefix: bool = False) -> Column:
    """The text has this token, whatever its case, or one that starts with it. Same tokens as :func:`tokens`, found
    without splitting the text; the substring test drops most texts before the pattern runs."""
    folded, token = F.lower(text), token.lower()
    end = "" if prefix else rf"(?:\z|{OUTSIDE_TOKENS})"
    return F.contains(folded, F.lit(token)) & folded.rlike(rf"(?:\A|{OUTSIDE_TOKENS})\Q{token}\E{end}")


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def repeats(values: Column) -> Column:
    """``array<struct<value, pos>>`` of every second and later occurrence, ``pos`` counted from 0.

    Sorting (value, position) pairs puts equal values side by side, so one pass over neighbours
    finds the repeats in n log n inside the row, with no shuffle of the exploded values.
    """
    pairs = F.sort_array(
        F.transform(values, lambda v, i: F.struct(v.alias("value"), i.alias("pos")))
    )
    no_pair = F.array(F.lit(None).cast("struct<value:string,pos:int>"))

    def later(p: Column) -> Column:
        shifted = F.concat(no_pair, F.slice(p, 1, F.size(p) - 1))
        same = lambda a, b: F.when(b.isNotNull() & a["value"].eqNullSafe(b["value"]), a)
        return F.filter(F.zip_with(p, shifted, same), lambda m: m.isNotNull())

    # the one-element list binds the sorted pairs, which are used three times, to one evaluation
    return F.when(F.size(values) > 1, F.transform(F.array(pairs), later)[0])


def marker_count(text: Column, marker: str) -> Column:
    """Occurrences of a literal marker that do not overlap."""
    without = F.length(F.replace(text, F.lit(marker), F.lit("")))
    return F.floor((F.length(text) - without) / len(marker)).cast("int")


def fences_balanced(text: Column, fence: str = "```") -> Column:
    return marker_count(text, fence) % 2 == 0


def odd_marker_lines(text: Column, marker: str = "`", fence: str = "```") -> Column:
    """1-based numbers of the lines outside fenced blocks that hold an odd count of ``marker``.

    A line that opens or closes a block is itself skipped. Walking the lines carries the open/closed
    state, so the whole text is handled inside its row.
    """
    start = F.struct(
        F.lit(False).alias("fenced"),
        F.lit(0).alias("line"),
        F.array().cast("array<int>").alias("odd"),
    )

    def step(state: Column, line: Column) -> Column:
        number = state["line"] + 1
        toggles = line.rlike(rf"\A\s*\Q{fence}\E")
        odd = ~toggles & ~state["fenced"] & (marker_count(line, marker) % 2 == 1)
        return F.struct(
            F.when(toggles, ~state["fenced"]).otherwise(state["fenced"]).alias("fenced"),
            number.alias("line"),
            F.when(odd, F.array_append(state["odd"], number)).otherwise(state["odd"]).alias("odd"),
        )

    return F.aggregate(lines(text), start, step, lambda state: state["odd"])


def option_list(first: Column, total: Column | int, limit: int = fixed.OPTION_LIST_LIMIT) -> Column:
    """``a, b, c`` of the first ``limit`` options in order; the total is added when there are more."""
    count = F.lit(total) if isinstance(total, int) else total
    shown = F.array_join(F.slice(F.array_sort(first), 1, limit), ", ")
    more = F.concat(F.lit(", ... ("), count.cast("string"), F.lit(" total)"))
    return F.when(count <= limit, shown).otherwise(F.concat(shown, more))


def path_parts(path: Column) -> Column:
    """``a.0.b`` as ``array<struct<key, index>>``: ``index`` is set for parts that start with digits."""

    def part(text: Column) -> Column:
        digits = F.regexp_extract(text, r"\A\s*([+-]?[0-9]+)", 1)
        return F.struct(
            text.alias("key"), F.nullif(digits, F.lit("")).try_cast("int").alias("index")
        )

    nothing = F.array().cast("array<struct<key:string,index:int>>")
    return F.when(path == "", nothing).otherwise(F.transform(F.split(path, r"\."), part))


def rounded_percent(part: Column, whole: Column) -> Column:
    """Whole percent, half up; 0 when there is nothing to divide by."""
    share = F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)))
    return F.coalesce(share, F.lit(0.0)).cast("int")
