"""Deterministic opaque keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ID_LENGTH = 21


def opaque_id(*parts: Column, salt: Column | int = 0) -> Column:
    """21 URL-safe characters of a SHA-256 over the parts; the same input always gives the same id."""
    salt_column = F.lit(salt) if isinstance(salt, int) else salt
    digest = F.unhex(F.sha2(F.concat_ws("/", *parts, salt_column.cast("string")), 256))
    return F.substring(F.translate(F.base64(digest), "+/", "-_"), 1, ID_LENGTH)


def child_key(parent: Column, *positions: Column) -> Column:
    """Key of a flattened list element: parent key and position, hashed."""
    return opaque_id(parent, *[p.cast("string") for p in positions])


def content_hash(*columns: Column) -> Column:
    """Fingerprint of a row, whatever the types of its columns."""
    return F.sha2(F.to_json(F.struct(*columns)), 256) if columns else F.lit("")
