"""Document validation: every rule gives coded findings, and only the first failing tier counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwright import fixed_values as fixed, schemas
from shelfwright.functions import dates, text, urls
from shelfwright.functions.identifiers import hint_for, invalid_identifiers
from shelfwright.operators import (
    findings as fd,
    lineage,
    nearest,
    ordered,
    references as refs,
    translations as tr,
)
from shelfwright.operators.coverage import missing_formats
from shelfwright.operators.reshape import alias_map
from shelfwright.plans.publish import port_translations
from shelfwright.sources import documents as src
from shelfwright.sources.vocabularies import Vocabulary

PRODUCTS = ["software", "hardware"]

# ---------------------------------------------------------------- tier 1 and 2: parsing and shape


def parse_findings(docs: DataFrame) -> DataFrame:
    bad = docs.where(F.col("error").isNotNull())
    return fd.finding(bad, tier=fd.PARSE, code="E110", path="(yaml)", message=F.col("error"))


def _entry(code: str, message: str | Column) -> Column:
    shown = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(code).alias("code"), shown.alias("message"))


# kinds of VARIANT each rule accepts
ACCEPTED = {
    "text": r"STRING", "filled": r"STRING", "url": r"STRING", "video": r"STRING", "date": r"STRING",
    "number": r"(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "flag": r"BOOLEAN", "year": r"BOOLEAN",
    "texts": r"ARRAY<(STRING|VOID)>", "markdown": r"(STRING|ARRAY<(STRING|VOID)>)",
    "map": r"OBJECT.*", "objects": r"ARRAY.*",
}


def _rule_rows(kind: str, rules: dict) -> list[tuple]:
    """``(kind, key, wanted, accepted, required, child)`` of an object and of those nested in it."""
    rows = []
    for key, rule in rules.items():
        nested = isinstance(rule, dict)
        wanted = "objects" if nested else rule.rstrip("!")
        child = f"{kind}.{key}" if nested else None
        rows.append((kind, key, wanted, ACCEPTED[wanted], not nested and rule.endswith("!"), child))
        if nested:
            rows.extend(_rule_rows(child, rule))
    return rows


def _depth(rules: dict) -> int:
    return 1 + max((_depth(r) for r in rules.values() if isinstance(r, dict)), default=0)


def _field_entries() -> Column:
    """Findings of one field: its type first, then what its rule asks of the value."""
    value, kind, wanted = F.col("value"), F.col("value_kind"), F.col("wanted")
    text_value = F.try_variant_get(value, "$", "string")
    good = F.rlike(kind, F.concat(F.lit(r"\A"), F.col("accepted"), F.lit(r"\z")))
    error = urls.video_url_error(text_value)
    year_ok = dates.year_only_ok(F.try_variant_get(value, "$", "boolean"), F.col("date"))
    body = src.text_at(value, "$")
    wrong_type = F.concat(F.col("key"), F.lit(" has the wrong type: "), kind)
    single = F.array(
        F.when(~good, _entry("E101", wrong_type)),
        F.when(good & wanted.isin("url", "video") & ~urls.is_url(text_value), _entry("E103", "invalid URL")),
        F.when(good & (wanted == "video") & error.isNotNull(), _entry("E301", error)),
        F.when(good & (wanted == "date") & ~dates.is_iso_date(text_value), _entry("E199", "invalid ISO date")),
        F.when(
            good & (wanted == "year") & ~year_ok,
            _entry("E199", dates.YEAR_ONLY_MESSAGE),
        ),
        F.when(
            good & (wanted == "markdown") & ~text.fences_balanced(body), _entry("E302", "unclosed code block")
        ),
    )
    on_line = lambda n: _entry("E303", F.concat(F.lit("unclosed inline code on line "), n.cast("string")))
    by_line = F.when(
        good & (wanted == "markdown"), F.transform(text.odd_marker_lines(body), on_line)
    ).otherwise(F.array().cast("array<struct<code:string,message:string>>"))
    return F.filter(F.concat(single, by_line), lambda e: e.isNotNull())


def shape_findings(docs: DataFrame) -> DataFrame:
    """Required fields, types, URLs, dates and markdown, down to the deepest list.

    Objects are opened level by level: each level joins its fields to the table of rules, and the
    lists of objects it holds are the next level.
    """
    spark = docs.sparkSession
    rows = [row for collection, rules in schemas.RULES.items() for row in _rule_rows(collection, rules)]
    rules = spark.createDataFrame(
        rows, "kind string, key string, wanted string, accepted string, required boolean, child string"
    )
    needed = rules.where("required").select("kind", "key", "wanted")
    shape = lambda df: fd.finding(df, tier=fd.SHAPE, code="E101", path=F.col("path"), message="expected an object")
    not_object = docs.where(
        F.col("error").isNull() & ~F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT"))
    )
    found = [shape(not_object.withColumn("path", F.lit("(root)")))]
    as_fields = lambda node: F.try_variant_get(node, "$", "map<string,variant>").alias("fields")
    nodes = src.readable(docs).select(
        "collection", "slug", F.col("collection").alias("kind"), F.lit("").alias("prefix"), as_fields("doc")
    )
    levels = [nodes]
    for _ in range(max(_depth(r) for r in schemas.RULES.values()) - 1):
        items = (
            nodes.select("collection", "slug", "kind", "prefix", F.explode("fields").alias("key", "value"))
            .join(rules.where(F.col("child").isNotNull()), ["kind", "key"])
            .select(
                "collection", "slug", F.col("child").alias("kind"), "prefix", "key",
                F.posexplode(F.try_variant_get("value", "$", "array<variant>")).alias("pos", "node"),
            )
            .withColumn("path", F.concat("prefix", "key", F.lit("."), F.col("pos").cast("string")))
        )
        is_object = F.coalesce(F.startswith(F.schema_of_variant("node"), F.lit("OBJECT")), F.lit(False))
        found.append(shape(items.where(~is_object)))
        nodes = items.where(is_object).select(
            "collection", "slug", "kind", F.concat("path", F.lit(".")).alias("prefix"), as_fields("node")
        )
        levels.append(nodes)

    objects = reduce(DataFrame.unionByName, levels)
    given = F.try_element_at("fields", F.col("key"))
    held = F.schema_of_variant(given)
    empty = (F.col("wanted") == "filled") & (held == "STRING") & (F.try_variant_get(given, "$", "string") == "")
    missing = objects.join(needed, "kind").where(held.isNull() | (held == "VOID") | empty)
    date = F.try_variant_get(F.try_element_at("fields", F.lit("releaseDate")), "$", "string")
    present = (
        objects.select(
            "collection", "slug", "kind", "prefix", date.alias("date"), F.explode("fields").alias("key", "value")
        )
        .join(rules, ["kind", "key"])
        .withColumn("value_kind", F.coalesce(F.schema_of_variant("value"), F.lit("VOID")))
        .where(~F.col("required") | (F.col("value_kind") != "VOID"))
    )
    flat = present.select(
        "collection", "slug", F.concat("prefix", "key").alias("path"), F.explode(_field_entries()).alias("e")
    )
    return fd.all_findings(
        *found,
        fd.finding(
            missing, tier=fd.SHAPE, code="E100", path=F.concat("prefix", "key"),
            message=F.concat("key", F.lit(" is required")),
        ),
        flat.select(
            "collection", "slug", F.lit(fd.SHAPE).alias("tier"), "e.code", "path", "e.message",
            F.lit(None).cast("string").alias("suggestion"),
        ),
    )


def _products(docs: DataFrame, *fields: str) -> DataFrame:
    kinds = {"categories": "array<string>", "formats": "array<string>", "platforms": "array<string>"}
    rows = src.readable(docs).where(F.col("collection").isin(PRODUCTS))
    columns = [F.try_variant_get("doc", f"$.{f}", kinds.get(f, "string")).alias(f) for f in fields]
    return rows.select("collection", "slug", *columns)


def vocabulary_findings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Categories, platforms and formats that no vocabulary has."""
    spark = docs.sparkSession
    rows = _products(docs, "primaryCategory", "secondaryCategory", "categories")
    listed = rows.select("collection", "slug", F.posexplode("categories").alias("i", "term"))
    used = listed.select(
        "collection", "slug", F.concat(F.lit("categories."), F.col("i").cast("string")).alias("path"), "term"
    )
    for name in ("primaryCategory", "secondaryCategory"):
        used = used.unionByName(
            rows.select("collection", "slug", F.lit(name).alias("path"), F.col(name).alias("term"))
        )
    bad = refs.dangling(used, ["term"], vocabulary.accepted_categories(spark), ["term"])
    categories = _suggested(bad, vocabulary.terms(spark, "categories"), "E104", "category")

    software = _products(docs, "formats", "platforms").where(F.col("collection") == "software")

    def exploded(field: str) -> DataFrame:
        rows = software.select("collection", "slug", F.posexplode(field).alias("i", "term"))
        path = F.concat(F.lit(f"{field}."), F.col("i").cast("string"))
        return rows.withColumn("path", path)

    formats = refs.dangling(exploded("formats"), ["term"], vocabulary.terms(spark, "formats"), ["term"])
    platforms = refs.dangling(exploded("platforms"), ["term"], vocabulary.terms(spark, "platforms"), ["term"])
    shown = _shown(vocabulary.platforms)
    message = F.concat(F.lit("invalid platform '"), "term", F.lit("'; valid: "), shown)
    return fd.all_findings(
        categories,
        _suggested(formats, vocabulary.terms(spark, "formats"), "E106", "format", vocabulary.formats),
        fd.finding(platforms, tier=fd.SHAPE, code="E105", path=F.col("path"), message=message),
    )


def _shown(options) -> Column:
    return text.option_list(F.array(*[F.lit(o) for o in options]), len(options))


def _suggested(bad: DataFrame, options: DataFrame, code: str, noun: str, listed=()) -> DataFrame:
    best = nearest.nearest_option(bad, "term", options, "term", "pos")
    message = F.concat(F.lit(f"invalid {noun} '"), "term", F.lit("'"))
    if listed:
        message = F.concat(message, F.lit("; valid: "), _shown(listed))
    return fd.finding(
        bad.join(best, "term", "left"), tier=fd.SHAPE, code=code, path=F.col("path"), message=message,
        suggestion=F.col("suggestion"),
    )


# ---------------------------------------------------------------- tier 3 to 5: references, duplicates


def owner_findings(docs: DataFrame) -> DataFrame:
    """Products whose manufacturer is not the slug of any manufacturer document."""
    owners = docs.where(F.col("collection") == "manufacturers").select(F.col("slug").alias("owner"))
    rows = _products(docs, "manufacturer").where(F.col("manufacturer") != "")
    bad = refs.dangling(rows, ["manufacturer"], owners, ["owner"])
    # among equally near owners the alphabetically first is suggested
    options = owners.select("owner", F.col("owner").alias("pos"))
    best = nearest.nearest_option(bad, "manufacturer", options, "owner", "pos")
    message = F.concat(F.lit("manufacturer '"), "manufacturer", F.lit("' does not exist"))
    few = owners.orderBy("owner").limit(fixed.OWNER_LIST_LIMIT + 1)
    # at most eleven names are gathered; they are listed when that is all there are
    listed = few.agg(
        F.when(
            F.count("*") <= fixed.OWNER_LIST_LIMIT, F.array_join(F.sort_array(F.collect_list("owner")), ", ")
        )
    ).scalar()
    message = F.concat(message, F.coalesce(F.concat(F.lit("; available: "), listed), F.lit("")))
    return fd.finding(
        bad.join(best, "manufacturer", "left"), tier=fd.OWNER, code="E200", path="manufacturer",
        message=message, suggestion=F.col("suggestion"),
    )


def supersedes_findings(docs: DataFrame) -> DataFrame:
    """Products that supersede an id their own collection does not have."""
    rows = _products(docs, "id", "supersedes")
    bad = refs.dangling(rows, ["collection", "supersedes"], rows, ["collection", "id"])
    message = F.concat(F.lit("supersedes id '"), "supersedes", F.lit("' does not exist in this collection"))
    return fd.finding(bad, tier=fd.LINEAGE, code="E199", path="supersedes", message=message)


def category_findings(docs: DataFrame) -> DataFrame:
    """Primary or secondary category repeated in the list, and repeats inside the list."""
    rows = _products(docs, "primaryCategory", "secondaryCategory", "categories")
    found = []
    for name in ("primaryCategory", "secondaryCategory"):
        bad = rows.where((F.col(name) != "") & F.array_contains("categories", F.col(name)))
        message = F.concat(F.lit(f"{name} '"), name, F.lit("' is repeated in categories"))
        found.append(fd.finding(bad, tier=fd.CATEGORIES, code="E202", path="categories", message=message))
    repeated = rows.select("collection", "slug", F.explode(text.repeats(F.col("categories"))).alias("r"))
    found.append(
        fd.finding(
            repeated, tier=fd.CATEGORIES, code="E202",
            path=F.concat(F.lit("categories["), F.col("r.pos").cast("string"), F.lit("]")),
            message=F.concat(F.lit("duplicate category '"), "r.value", F.lit("'")),
        )
    )
    return fd.all_findings(*found)


def alias_findings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Two names of one category in a list: valid by itself, but one key once published."""
    aliases = alias_map(vocabulary.aliases)
    rows = _products(docs, "categories")
    canonical = F.transform("categories", lambda c: F.coalesce(F.try_element_at(aliases, c), c))
    bad = rows.where(
        F.size(F.array_distinct(canonical)) < F.size(F.array_distinct("categories"))
    )
    return fd.finding(
        bad, tier=fd.CATEGORIES, code="E202", path="categories", message="two names of the same category"
    )


def cycle_findings(docs: DataFrame) -> DataFrame:
    """Products whose chain of superseded products runs into a cycle."""
    rows = _products(docs, "id", "supersedes")
    # collections have their own chains: the collection is part of the node
    node = lambda column: F.when(F.col(column) != "", F.concat_ws("/", "collection", column))
    nodes = rows.select("collection", "slug", node("id").alias("node"), node("supersedes").alias("next"))
    # where an id is given twice, the later document stands
    links = nodes.where(F.col("next").isNotNull()).groupBy("node").agg(F.max_by("next", "slug").alias("next"))
    starts, _ = lineage.cycles(lineage.edges_of(links, "node", "next"))
    slugs = nodes.where(F.col("node").isNotNull()).groupBy("collection", "node").agg(F.max("slug").alias("slug"))
    entries = slugs.select(F.col("slug").alias("_entry"), F.col("node").alias("entry"))
    named = starts.join(slugs, "node").join(entries, "entry")
    message = F.concat(
        F.lit("supersedes chain runs into a cycle of "), F.col("length").cast("string"), F.lit(" at "), "_entry"
    )
    return fd.finding(
        named, tier=fd.OUTSIDE_TIERS, code="E199", path="supersedes", message=message
    )


def extra_findings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rules the code list provides for but the standard set leaves out: parent companies, release
    dates, locales, translated ports, and identifiers that are malformed or missing."""
    rows = src.readable(docs)
    owners = docs.where(F.col("collection") == "manufacturers").select(F.col("slug").alias("owner"))
    parent = rows.where(F.col("collection") == "manufacturers").select(
        "collection", "slug", F.try_variant_get("doc", "$.parentCompany", "string").alias("parent")
    )
    orphan = refs.dangling(parent.where(F.col("parent") != ""), ["parent"], owners, ["owner"])
    held = rows.where(F.col("collection") == "software").select(
        "collection", "slug",
        F.coalesce(
            F.try_variant_get("doc", "$.identifiers", "map<string,string>"),
            F.create_map().cast("map<string,string>"),
        ).alias("ids"),
        F.try_variant_get("doc", "$.formats", "array<string>").alias("formats"),
    )
    missing = held.select(
        "collection", "slug", F.explode(missing_formats(F.col("formats"), F.col("ids"))).alias("format")
    )
    released = F.col("releaseDate")
    undated = _products(docs, "releaseDate").where(
        (released != "") & ~dates.is_iso_date(released) & ~released.rlike(r"\A[0-9]{4}\z")
    )
    ports = translation_findings(docs, vocabulary).where(F.contains("path", F.lit(".io.")))
    bad = held.select("collection", "slug", F.explode(invalid_identifiers(F.col("ids"))).alias("bad"))
    locales = vocabulary.locale_frame(docs.sparkSession)
    foreign = tr.unapproved(src.translations(docs), "locale", locales, "code")
    return fd.all_findings(
        fd.finding(
            orphan, tier=fd.OWNER, code="E203", path="parentCompany",
            message=F.concat(F.lit("parent company '"), "parent", F.lit("' does not exist")),
        ),
        fd.finding(
            bad, tier=fd.SHAPE, code="E400", path=F.concat(F.lit("identifiers."), "bad.format"),
            message=F.col("bad.error"), suggestion=hint_for(F.col("bad.format")),
        ),
        fd.finding(
            missing, tier=fd.SHAPE, code="E401", path=F.concat(F.lit("identifiers."), "format"),
            message=F.concat(F.lit("no identifier for "), "format"),
        ),
        fd.finding(
            undated, tier=fd.SHAPE, code="E108", path="releaseDate",
            message=F.concat(F.lit("not a date: "), "releaseDate"),
        ),
        fd.finding(ports, tier=fd.SHAPE, code="E204", path=F.col("path"), message=F.col("message")),
        fd.finding(
            foreign, tier=fd.SHAPE, code="E107", path=F.concat(F.lit("translations."), "locale"),
            message="locale is not approved",
        ),
    )


# ---------------------------------------------------------------- the whole report


def all_document_findings(docs: DataFrame, vocabulary: Vocabulary, extra: bool = False) -> DataFrame:
    """Every finding of every tier."""
    parts = [
        parse_findings(docs), shape_findings(docs), vocabulary_findings(docs, vocabulary),
        owner_findings(docs), supersedes_findings(docs), category_findings(docs),
        alias_findings(docs, vocabulary), cycle_findings(docs),
    ]
    if extra:
        parts.append(extra_findings(docs, vocabulary))
    return fd.all_findings(*parts)


def validate(docs: DataFrame, vocabulary: Vocabulary, extra: bool = False) -> DataFrame:
    """Findings as reported: of each document only the first failing tier, cycles besides."""
    return fd.first_tier(all_document_findings(docs, vocabulary, extra))


def is_valid(findings: DataFrame, id_findings: DataFrame) -> bool:
    return findings.isEmpty() and id_findings.isEmpty()


# ---------------------------------------------------------------- ids


def _ids(docs: DataFrame) -> DataFrame:
    """``(collection, slug, id, kind)``; ``kind`` is NULL where there is no id."""
    kind = F.schema_of_variant(F.try_variant_get("doc", "$.id", "variant"))
    id_ = F.try_variant_get("doc", "$.id", "string")
    return src.readable(docs).select("collection", "slug", id_.alias("id"), kind.alias("kind"))


def _valid_id() -> Column:
    return (F.col("kind") == "STRING") & (F.col("id") != "")


def id_findings(docs: DataFrame) -> DataFrame:
    """Ids that are no text or empty, and every later holder of an id with the holder before it."""
    rows = _ids(docs)
    wrong = rows.where(F.col("kind").isNotNull() & ~_valid_id())
    valid = rows.where(_valid_id()).select("collection", "id", "slug")
    pairs = ordered.with_previous(valid, ["collection", "id"], ["slug"], "slug")
    again = pairs.where(F.col("previous").isNotNull())
    return fd.all_findings(
        fd.finding(
            wrong, tier=fd.OUTSIDE_TIERS, code="E199", path="id",
            message=F.concat(F.lit("the id has to be text that is not empty; it is "), "kind"),
        ),
        fd.finding(
            again, tier=fd.OUTSIDE_TIERS, code="E199", path="id",
            message=F.concat(F.lit("duplicate id '"), "id", F.lit("' in '"), "previous", F.lit("' and '"), "slug", F.lit("'")),
        ),
    )


def id_stats(docs: DataFrame) -> DataFrame:
    rows = _ids(docs)
    held = rows.where(_valid_id()).groupBy("collection", "id").agg(F.count("*").alias("n"))
    repeats = held.groupBy("collection").agg(F.sum(F.col("n") - 1).alias("duplicates"))
    counts = rows.groupBy("collection").agg(
        F.count_if(_valid_id()).alias("with_ids"), F.count_if(F.col("kind").isNull()).alias("without_ids")
    )
    return counts.join(repeats, "collection", "left").select(
        "collection", "with_ids", "without_ids", F.coalesce("duplicates", F.lit(0)).alias("duplicates")
    )


def changed_id_findings(base: DataFrame, current: DataFrame) -> DataFrame:
    """Documents of both snapshots whose id was changed."""
    old = _ids(base).where(_valid_id()).select("collection", "slug", F.col("id").alias("old_id"))
    new = _ids(current).select("collection", "slug", F.col("id").alias("new_id"))
    moved = old.join(new, ["collection", "slug"]).where(~F.col("old_id").eqNullSafe(F.col("new_id")))
    message = F.concat(F.lit("id changed from "), "old_id", F.lit(" to "), F.coalesce("new_id", F.lit("(none)")))
    return fd.finding(moved, tier=fd.OUTSIDE_TIERS, code="E199", path="id", message=message)


# ---------------------------------------------------------------- translations


def translation_findings(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(collection, slug, locale, severity, path, message)`` over all translations."""
    rows = src.translations(docs)
    locales = vocabulary.locale_frame(docs.sparkSession)
    shape = lambda df, severity, path, message: df.select(
        "collection", "slug", "locale", F.lit(severity).alias("severity"), path.alias("path"), message.alias("message")
    )
    base = F.concat(F.lit("translations."), F.col("locale"))
    foreign = shape(
        tr.unapproved(rows, "locale", locales, "code"), "warning", base, F.lit("locale is not approved")
    )
    is_object = F.startswith(F.schema_of_variant("content"), F.lit("OBJECT"))
    opened = rows.where(is_object).lateralJoin(
        docs.sparkSession.tvf.variant_explode(F.col("content").outer())
    )
    allowed = F.lit(False)
    for collection, names in fixed.TRANSLATION_FIELDS.items():
        allowed = allowed | ((F.col("collection") == collection) & F.col("key").isin(names))
    fields = shape(
        opened.where(~allowed), "error", F.concat(base, F.lit("."), "key"), F.lit("unknown field")
    )
    ports = port_translations(rows.where(F.col("collection") == "hardware"))
    unnamed = ports.where(text.is_blank(F.col("original_name")))
    named = ports.where(~text.is_blank(F.col("original_name")))
    device = src.typed(docs, "hardware").select("slug", F.explode("io.name").alias("port"))
    unknown = refs.dangling(named, ["slug", "original_name"], device, ["slug", "port"])
    io = F.concat(base, F.lit(".io."), F.col("pos").cast("string"))
    return (
        foreign.unionByName(fields)
        .unionByName(shape(unnamed, "error", io, F.lit("originalName is missing")))
        .unionByName(
            shape(unknown, "error", io, F.concat(F.lit("no port named '"), F.col("original_name"), F.lit("'")))
        )
    )


def translation_stats(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    locales = vocabulary.locale_frame(docs.sparkSession)
    return tr.translation_stats(src.translations(docs), ["collection", "slug"], "locale", locales, "code")


# ---------------------------------------------------------------- vocabulary groups


def group_findings(spark, vocabulary: Vocabulary) -> DataFrame:
    """Categories that are in no group or in several, and grouped names that are no category."""
    bad = refs.reconcile(
        vocabulary.terms(spark, "categories"), "term", vocabulary.group_frame(spark), "category", "group"
    )
    return fd.finding(
        bad, tier=fd.OUTSIDE_TIERS, code="E199", path="groups", message=F.col("status"),
        collection=F.lit("vocabulary"), slug="term",
    )


def known_groups(spark, vocabulary: Vocabulary) -> DataFrame:
    """Members of the groups that are categories, in their order."""
    return refs.known_members(
        vocabulary.group_frame(spark), "category", vocabulary.terms(spark, "categories"), "term"
    ).orderBy("group", "pos")
