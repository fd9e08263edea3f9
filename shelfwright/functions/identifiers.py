"""Identifier shape by format."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from shelfwright import fixed_values as fixed


def _by_format(format_: Column, table: dict[str, str], make) -> Column:
    """First branch whose format matches; a handful of branches, so no lookup join is needed."""
    return reduce(
        lambda chain, item: chain.when(format_ == item[0], make(item[1])),
        table.items(),
        F.when(F.lit(False), make(next(iter(table.values())))),
    )


def has_pattern(format_: Column, patterns: dict[str, str] = fixed.IDENTIFIER_PATTERNS) -> Column:
    return format_.isin(list(patterns))


def hint_for(format_: Column, hints: dict[str, str] = fixed.IDENTIFIER_HINTS) -> Column:
    return _by_format(format_, hints, F.lit)


def identifier_error(
    format_: Column, value: Column, patterns: dict[str, str] = fixed.IDENTIFIER_PATTERNS
) -> Column:
    """NULL when fine. A format without a pattern accepts anything, even an empty value."""
    empty = F.trim(F.coalesce(value, F.lit(""))) == ""
    matches = _by_format(format_, patterns, lambda p: value.rlike(p))
    return (
        F.when(~has_pattern(format_, patterns), F.lit(None).cast("string"))
        .when(empty, F.concat(F.lit("no value for the identifier of "), format_))
        .when(
            ~matches,
            F.concat(
                F.lit("not an identifier of "), format_, F.lit(": '"), value, F.lit("'")
            ),
        )
    )


def invalid_identifiers(identifiers: Column) -> Column:
    """Entries of a format -> identifier map that fail, as ``array<struct<format, value, error>>``."""
    checked = F.transform(
        F.map_entries(identifiers),
        lambda e: F.struct(
            e["key"].alias("format"),
            e["value"].alias("value"),
            identifier_error(e["key"], e["value"]).alias("error"),
        ),
    )
    return F.filter(checked, lambda c: c["error"].isNotNull())
