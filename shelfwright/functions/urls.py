"""URL syntax and the canonical video-URL rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed

URL_FIELDS = ["url", "website", "source"]


def is_http(value: Column) -> Column:
    return F.startswith(value, F.lit("http://")) | F.startswith(value, F.lit("https://"))


def is_url(value: Column) -> Column:
    """Absolute URL: a scheme, and for the web schemes a host of permitted characters."""
    web = value.rlike(r"(?i)\A(https?|wss?|ftp):")
    hosted = value.rlike(
        r"(?is)\A(https?|wss?|ftp):[/\\]*([^/?#\\@]*@)?"
        r"(\[[0-9a-f:.]+\]|[^\s/?#\\@:<>^|\[\]]+)(:[0-9]*)?([/?#\\].*)?\z"
    )
    return F.coalesce(F.when(web, hosted).otherwise(value.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(False))


_AUTHORITY = r"\A[A-Za-z][A-Za-z0-9+.-]*:[/\\]*(?:[^/?#\\@]*@)?([^/?#\\@:]*)(?::[0-9]*)?([^?#]*)"


def host_of(value: Column) -> Column:
    return F.lower(F.regexp_extract(value, _AUTHORITY, 1))


def video_url_error(value: Column) -> Column:
    """Why a video URL is not in the one accepted shape; NULL for good and for other URLs."""
    host = host_of(value)
    path = F.regexp_extract(value, _AUTHORITY, 2)
    return (
        F.when(~host.isin(fixed.VIDEO_HOSTS), F.lit(None).cast("string"))
        .when(
            host.isin(fixed.VIDEO_BARE_HOSTS),
            F.concat(F.lit("use 'www.youtube.com' instead of '"), host, F.lit("'")),
        )
        .when(F.startswith(path, F.lit("/embed/")), F.lit("use '/watch?v=' instead of '/embed/'"))
        .when(
            host == fixed.VIDEO_SHORT_HOST,
            F.lit("use 'www.youtube.com/watch?v=' instead of 'youtu.be'"),
        )
        .when(
            ~value.rlike(fixed.VIDEO_CANONICAL),
            F.lit("must match 'https://www.youtube.com/watch?v={videoId}'"),
        )
    )


# a key of a URL field with a text value, in compact JSON: an unescaped quote opens a string only there
_FIELD = r'(?<!\\)"(?:' + "|".join(URL_FIELDS) + r')":"((?:[^"\\]|\\.)*+)"'


def extract_urls(docs: DataFrame, keys: list[str], doc: str) -> DataFrame:
    """``(keys, url)`` of every http(s) string under a URL field of a VARIANT, each once per document.

    The fields are found in the compact JSON text of the document, at any depth and in one pass.
    """
    found = F.regexp_extract_all(F.to_json(doc), F.lit(_FIELD), F.lit(1))
    texts = F.from_json(F.concat(F.lit('["'), F.array_join(found, '","'), F.lit('"]')), "array<string>")
    urls = F.array_distinct(F.filter(F.when(F.size(found) > 0, texts), is_http))
    return docs.select(*keys, F.explode(urls).alias("url")).distinct()
