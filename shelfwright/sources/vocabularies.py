"""Controlled vocabularies: small configuration files, loaded once and kept."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from shelfwright import fixed_values as fixed
from shelfwright.sources.documents import _loader, yaml


@dataclass(frozen=True)
class Vocabulary:
    """Terms in their order of preference."""

    categories: tuple[str, ...] = ()
    aliases: dict[str, str] = field(default_factory=lambda: dict(fixed.CATEGORY_ALIASES))
    formats: tuple[str, ...] = tuple(fixed.FORMATS)
    platforms: tuple[str, ...] = tuple(fixed.PLATFORMS)
    locales: tuple[tuple[str, str, str], ...] = tuple(fixed.LOCALES)
    groups: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def terms(self, spark: SparkSession, name: str) -> DataFrame:
        """``(term, pos)`` of one of the lists."""
        rows = [(term, pos) for pos, term in enumerate(getattr(self, name))]
        return spark.createDataFrame(rows, "term string, pos int")

    def accepted_categories(self, spark: SparkSession) -> DataFrame:
        """Canonical terms and aliases."""
        aliases = spark.createDataFrame([(a,) for a in self.aliases], "term string")
        return self.terms(spark, "categories").select("term").union(aliases).distinct()

    def locale_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.locales), "code string, name string, native_name string")

    def group_frame(self, spark: SparkSession) -> DataFrame:
        """``(group, category, pos)``."""
        rows = [(g, c, i) for g, members in self.groups.items() for i, c in enumerate(members)]
        return spark.createDataFrame(rows, "group string, category string, pos int")


def _list_file(folder: str, name: str, key: str):
    """One entry of a small configuration file in a local or a shared folder. A missing file is an error."""
    path = f"{folder.rstrip('/')}/{name}"
    if "://" not in path:
        with open(path, encoding="utf-8") as handle:
            content = handle.read()
    else:
        content = SparkSession.active().read.text(path, wholetext=True).first()[0]
    return yaml.load(content, Loader=_loader())[key]


def _checked_groups(groups) -> dict[str, tuple[str, ...]]:
    if not isinstance(groups, dict):
        raise ValueError("groups must map a name to a list of categories")
    for name, members in groups.items():
        if not isinstance(members, list) or not all(isinstance(m, str) for m in members):
            raise ValueError(f"group {name!r} must be a list of category names")
    return {name: tuple(members) for name, members in groups.items()}


@lru_cache(maxsize=8)
def load_vocabulary(folder: str) -> Vocabulary:
    """The vocabulary of a folder. Every file must be there."""
    given: dict = {name: tuple(_list_file(folder, f"{name}.yaml", name)) for name in ("categories", "formats", "platforms")}
    locales = _list_file(folder, "locales.yaml", "locales")
    return Vocabulary(
        aliases=dict(_list_file(folder, "category-aliases.yaml", "aliases")),
        locales=tuple((x["code"], x["name"], x["nativeName"]) for x in locales),
        groups=_checked_groups(_list_file(folder, "category-groups.yaml", "groups")),
        **given,
    )


def clear_vocabulary() -> None:
    load_vocabulary.cache_clear()
