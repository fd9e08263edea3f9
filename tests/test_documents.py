"""Documents end to end: read, publish, validate, diff, report."""

import pytest
from pyspark.sql import functions as F

from fixture_documents import BROKEN, CATEGORIES, CLEAN, write
from shelfwright import schemas
from shelfwright.operators import changes as cdc, coverage, findings as fd
from shelfwright.plans import publish as pub, reports, validate as val
from shelfwright.sources import documents as src, tables as store, url_cache
from shelfwright.sources.vocabularies import Vocabulary, clear_vocabulary, load_vocabulary


def as_of():
    return F.lit("2024-03-31 12:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def vocabulary():
    groups = {"Kinds": ("plugin", "daw", "ghost"), "Sound": ("effect", "synthesizer", "plugin")}
    return Vocabulary(categories=CATEGORIES, groups=groups)


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    return src.read_documents(spark, write(CLEAN, tmp_path_factory.mktemp("clean"))).coalesce(2).cache()


@pytest.fixture(scope="module")
def broken(spark, tmp_path_factory):
    return src.read_documents(spark, write(BROKEN, tmp_path_factory.mktemp("broken"))).coalesce(2).cache()


@pytest.fixture(scope="module")
def published(clean, vocabulary, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("published"))
    store.write_tables(pub.publish(clean, vocabulary, "7", as_of()), folder)
    return store.read_tables(clean.sparkSession, folder)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_reading_keeps_dates_as_text_and_quarantines_what_it_cannot_read(clean, broken):
    assert rows(clean.where("error is not null"), "slug") == []
    glow = src.typed(clean, "software").where("slug = 'glow'")
    assert rows(glow, "releaseDate", "details") == [("2001-05-06", "First paragraph.\n\nSecond paragraph.")]
    assert rows(broken.where("error is not null"), "slug") == [("twice",), ("unreadable",)]
    assert rows(clean.where("collection = 'manufacturers'"), "slug") == [
        ("aurora-labs",), ("borealis",), ("cirrus",)
    ]


def test_plain_scalars_follow_the_core_schema(spark, tmp_path):
    body = "a: 010\nb: 12:30\nc: yes\nd: 1_000\ne: 0x1f\nf: 1.5\ng: true\nh: ~\ni: 2001-01-01\nj: <<\n"
    docs = src.read_documents(spark, write({"software/one.yaml": body}, tmp_path))
    assert docs.first()["json"] == (
        '{"a": 10, "b": "12:30", "c": "yes", "d": "1_000", "e": 31, "f": 1.5, "g": true, "h": null, '
        '"i": "2001-01-01", "j": "<<"}'
    )


def test_stored_documents_are_the_same(clean, tmp_path):
    stored = src.store_documents(clean, str(tmp_path / "docs"))
    assert rows(stored, "collection", "slug", "json") == rows(clean, "collection", "slug", "json")
    assert rows(src.typed(stored, "software"), "id", "name") == rows(src.typed(clean, "software"), "id", "name")
    plan = src.typed(stored, "software")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collection" in plan


def test_missing_collection_is_empty(spark, tmp_path):
    root = write({"software/one.yaml": "name: One\n"}, tmp_path)
    assert rows(src.read_raw(spark, root), "collection", "slug", "path") == [("software", "one", "software/one.yaml")]


def test_all_tables_are_published_with_their_schema(published):
    assert set(published) == set(schemas.TABLES) and len(published) == 34
    counts = {name: df.count() for name, df in published.items()}
    assert counts == {
        **dict.fromkeys(schemas.TABLES, 0),
        "manufacturers": 3, "manufacturer_search_terms": 2, "manufacturer_translations": 1,
        "software": 3, "software_categories": 3, "software_formats": 5, "software_platforms": 2,
        "software_versions": 2, "software_prices": 2, "software_links": 1, "software_fts": 3,
        "software_translations": 1, "software_links_localized": 2,
        "hardware": 1, "hardware_io": 3, "hardware_revisions": 2, "hardware_revision_io": 1,
        "hardware_revision_versions": 1, "hardware_revision_prices": 1, "hardware_revision_links": 1,
        "hardware_fts": 1, "hardware_translations": 1, "hardware_io_translations": 1,
        "locales": 7, "dataset_meta": 3, "schema_migrations": 11,
    }


def test_published_values(published):
    assert rows(published["manufacturers"], "id", F.coalesce("parent_company_id", F.lit("-"))) == [
        ("m-aurora", "-"), ("m-borealis", "m-aurora"), ("m-cirrus", "-")
    ]
    owner = F.coalesce("manufacturer_id", F.lit("-"))
    assert rows(published["software"], "id", owner, F.coalesce("supersedes_id", F.lit("-"))) == [
        ("s-classic", "-", "s-glow"), ("s-glow", "m-aurora", "-"), ("s-shimmer", "m-borealis", "-")
    ]
    # alias and canonical name in one list give one row
    assert rows(published["software_categories"].where("software_id = 's-glow'"), "category") == [
        ("effect",), ("plugin",)
    ]
    assert rows(published["software_formats"].where("software_id = 's-glow'"), "format", F.coalesce("identifier", F.lit("-"))) == [
        ("aax", "toolong"), ("au", "-"), ("standalone", "-"), ("vst3", "com.aurora.Glow")
    ]
    assert rows(published["software_versions"], "name", "pre_release", "unofficial", "release_date_year_only") == [
        ("1.0", 1, 0, 0), ("2.0", 0, 0, 0)
    ]
    assert rows(published["hardware"], "primary_category", "release_date", "release_date_year_only") == [
        ("equalizer", "1999", 1)
    ]
    assert rows(published["hardware_io"], "name", "max_connections") == [("IN", 1), ("OUT", 1), ("OUT", 2)]
    assert rows(published["hardware_io_translations"], "original_name", "translated_name") == [("OUT", "AUSGANG")]
    assert rows(published["software_links_localized"], "locale", F.coalesce("title", F.lit("-"))) == [
        ("de", "-"), ("fr", "Seulement des liens")
    ]
    assert rows(published["software_fts"].where("id = 's-classic'"), "manufacturer_name", "categories", "description") == [
        ("", "", "")
    ]
    joined = published["hardware_revision_io"].join(
        published["hardware_revisions"].select(F.col("id").alias("revision_id"), F.col("name").alias("revision")), "revision_id"
    )
    assert rows(joined, "revision", "name") == [("mk2", "USB")]


def test_publishing_again_gives_the_same_keys(clean, vocabulary, published):
    again = pub.publish(clean, vocabulary, "7", as_of())
    for name in ("hardware_io", "hardware_revision_links", "software_links_localized"):
        assert rows(again[name], "id") == rows(published[name], "id")
        assert again[name].select("id").distinct().count() == again[name].count()


def test_publishing_without_an_id_fails(spark, vocabulary, tmp_path):
    docs = src.read_documents(spark, write({"manufacturers/x.yaml": "name: X\n"}, tmp_path))
    with pytest.raises(Exception, match="missing id in manufacturers/x.yaml"):
        pub.publish(docs, vocabulary, "1", as_of())["manufacturers"].collect()


def codes(findings, slug):
    return rows(findings.where(F.col("slug") == slug), "code", "path")


@pytest.fixture(scope="module")
def report(broken, vocabulary):
    return val.validate(broken, vocabulary).cache()


@pytest.fixture(scope="module")
def clean_report(clean, vocabulary):
    return val.validate(clean, vocabulary).cache()


def test_clean_documents_have_only_reference_findings(clean_report):
    assert rows(clean_report, "slug", "code", "path") == [
        ("glow", "E202", "categories"), ("glow-classic", "E200", "manufacturer")
    ]


def test_each_rule_finds_its_fault(report):
    assert codes(report, "unreadable") == [("E110", "(yaml)")]
    assert codes(report, "twice") == [("E110", "(yaml)")]
    assert codes(report, "list") == [("E101", "(root)")]
    assert codes(report, "owner-two") == [("E100", "name"), ("E101", "searchTerms")]
    assert codes(report, "no-owner") == [("E100", "manufacturer")]
    assert codes(report, "bad-words") == [
        ("E104", "categories.0"), ("E104", "categories.1"), ("E104", "primaryCategory"),
        ("E105", "platforms.0"), ("E106", "formats.0"), ("E106", "formats.1"),
    ]
    assert codes(report, "bad-lineage") == [("E199", "supersedes")]
    assert codes(report, "bad-list") == [
        ("E202", "categories"), ("E202", "categories"), ("E202", "categories[3]"), ("E202", "categories[4]")
    ]
    assert codes(report, "bad-urls") == [
        ("E100", "links.6.type"), ("E101", "links.7"),
        ("E103", "website"),
        ("E301", "links.0.url"), ("E301", "links.1.url"), ("E301", "links.2.url"), ("E301", "links.3.url"),
        ("E301", "links.4.url"),
    ]
    assert codes(report, "bad-dates") == [
        ("E101", "prices.0.amount"), ("E199", "prices.0.asOf"), ("E199", "releaseDateYearOnly"),
        ("E199", "versions.0.releaseDateYearOnly"),
    ]
    assert codes(report, "bad-text") == [("E302", "description"), ("E303", "details"), ("E303", "details")]
    lines = rows(report.where("slug = 'bad-text' and code = 'E303'"), "message")
    assert [line[0][-1] for line in lines] == ["2", "6"]
    assert codes(report, "two-names") == [("E202", "categories")]
    assert codes(report, "fine") == []


def test_only_the_first_failing_tier_is_reported(report, broken):
    # the owner is unknown and a category is repeated: the owner comes first
    assert codes(report, "bad-owner") == [("E200", "manufacturer")]
    assert rows(report.where("slug = 'bad-owner'"), "suggestion") == [("owner-one",)]
    every = val.owner_findings(broken).unionByName(val.category_findings(broken))
    assert codes(every, "bad-owner") == [
        ("E200", "manufacturer"), ("E202", "categories[1]"), ("E202", "categories[2]")
    ]


def test_suggestions(report):
    found = report.where("slug = 'bad-words' and suggestion is not null")
    assert rows(found, "path", "suggestion") == [("formats.0", "vst"), ("primaryCategory", "plugin")]
    available = report.where("slug = 'bad-owner'").first()["message"]
    assert available.endswith("available: list, owner-one, owner-two, twice, unreadable")


def test_cycles_are_reported_for_every_start(report):
    found = report.where("message like '%cycle%'")
    assert rows(found, "slug", "message") == [
        ("ring-a", "supersedes chain runs into a cycle of 3 at ring-a"),
        ("ring-b", "supersedes chain runs into a cycle of 3 at ring-b"),
        ("ring-c", "supersedes chain runs into a cycle of 3 at ring-c"),
        ("ring-self", "supersedes chain runs into a cycle of 1 at ring-self"),
        ("ring-tail", "supersedes chain runs into a cycle of 3 at ring-b"),
    ]


def test_ids(broken):
    found = rows(val.id_findings(broken), "slug", "message")
    assert found == [
        ("number-id", "the id has to be text that is not empty; it is BIGINT"),
        ("owner-two", "duplicate id 'o1' in 'owner-one' and 'owner-two'"),
        ("same-id", "duplicate id 's9' in 'fine' and 'same-id'"),
        ("same-id-too", "duplicate id 's9' in 'same-id' and 'same-id-too'"),
    ]
    assert rows(val.id_stats(broken).where("collection = 'software'"), "with_ids", "without_ids", "duplicates") == [(16, 1, 2)]


def test_verdict(broken, clean, report, clean_report):
    counts = fd.valid_counts(broken, report)
    assert rows(counts, "collection", "documents", "valid") == [
        ("hardware", 2, 1), ("manufacturers", 5, 1), ("software", 18, 5)
    ]
    assert not val.is_valid(report, val.id_findings(broken))
    good = clean.where("slug not in ('glow', 'glow-classic')")
    assert val.is_valid(clean_report.where("slug not in ('glow', 'glow-classic')"), val.id_findings(good))


def test_report_shapes(report):
    titled = fd.with_titles(report).where("code = 'E110'")
    assert rows(titled, "title", "docs")[0] == (
        "YAML syntax error", "findings.md#e110-yaml-syntax-error"
    )
    per_document = fd.per_document(report).where("slug = 'bad-list'").first()
    assert len(per_document["findings"]) == 4


def test_extra_rules_are_off_by_default(clean, vocabulary, report):
    extra = rows(val.extra_findings(clean, vocabulary), "slug", "code", "path")
    assert extra == [
        ("aurora-labs", "E107", "translations.it"), ("beacon", "E204", "translations.de.io.1"),
        ("cirrus", "E203", "parentCompany"), ("glow", "E400", "identifiers.aax"),
        ("glow", "E401", "identifiers.au"), ("glow-classic", "E401", "identifiers.vst2"),
    ]


def test_translations(clean, broken, vocabulary):
    found = rows(val.translation_findings(broken, vocabulary), "locale", "severity", "path")
    assert found == [
        ("de", "error", "translations.de.io.1"), ("de", "error", "translations.de.io.2"),
        ("de", "error", "translations.de.title"), ("it", "warning", "translations.it"),
    ]
    stats = val.translation_stats(clean, vocabulary)
    assert [tuple(r) for r in stats.collect()] == [(3, 6, 4, 1)]


def test_vocabulary_groups(spark, vocabulary):
    found = rows(val.group_findings(spark, vocabulary), "slug", "message")
    assert found == [
        ("equalizer", "unmapped"), ("ghost", "orphan"), ("headphones", "unmapped"),
        ("pitch-shifter", "unmapped"), ("plugin", "multi_mapped"),
    ]
    assert rows(val.known_groups(spark, vocabulary), "group", "category") == [
        ("Kinds", "daw"), ("Kinds", "plugin"), ("Sound", "effect"), ("Sound", "plugin"), ("Sound", "synthesizer")
    ]


def test_vocabulary_files(tmp_path):
    (tmp_path / "categories.yaml").write_text("categories: [b, a]\n")
    (tmp_path / "category-aliases.yaml").write_text("aliases: {bee: b}\n")
    (tmp_path / "category-groups.yaml").write_text("groups:\n  G: [a]\n")
    (tmp_path / "formats.yaml").write_text("formats: [f]\n")
    (tmp_path / "platforms.yaml").write_text("platforms: [p]\n")
    with pytest.raises(FileNotFoundError):
        load_vocabulary(str(tmp_path))
    (tmp_path / "locales.yaml").write_text("locales: [{code: de, name: German, nativeName: Deutsch}]\n")
    loaded = load_vocabulary(str(tmp_path))
    assert loaded.categories == ("b", "a") and loaded.aliases == {"bee": "b"} and loaded.groups == {"G": ("a",)}
    assert load_vocabulary(str(tmp_path)) is loaded
    clear_vocabulary()
    assert load_vocabulary(str(tmp_path)) is not loaded
    (tmp_path / "category-groups.yaml").write_text("groups:\n  G: a\n")
    clear_vocabulary()
    with pytest.raises(ValueError):
        load_vocabulary(str(tmp_path))


def test_change_set_equals_rebuild(spark, published, vocabulary, tmp_path):
    after = dict(CLEAN)
    del after["software/shimmer.yaml"]
    after["software/new.yaml"] = "id: s-new\nname: New\nmanufacturer: cirrus\nplatforms: [linux]\n"
    after["software/renamed.yaml"] = after.pop("software/glow-classic.yaml").replace("Glow Classic", "Classic")
    after["software/glow.yaml"] = after["software/glow.yaml"].replace("platforms: [mac, windows]", "platforms: [linux]")
    docs = src.read_documents(spark, write(after, tmp_path / "after")).coalesce(2).cache()
    current = pub.publish(docs, vocabulary, "8", as_of())
    changes = pub.diff_tables(published, current)
    assert rows(changes["software"], "id", "op") == [
        ("s-classic", "modified"), ("s-new", "added"), ("s-shimmer", "deleted")
    ]
    assert rows(changes["software_platforms"], "software_id", "platform", "op") == [
        ("s-glow", "linux", "added"), ("s-glow", "mac", "deleted"), ("s-glow", "windows", "deleted"),
        ("s-new", "linux", "added"),
    ]
    counts = {(r["table"], r["op"]): r["changes"] for r in pub.change_counts(changes).collect()}
    assert counts[("software_categories", "deleted")] == 1 and ("hardware", "modified") not in counts
    applied = pub.apply_tables(published, changes)
    for name in ("software", "software_platforms", "software_categories", "software_fts", "dataset_meta", "hardware_io"):
        columns = [c for c in current[name].columns if c not in pub.NOT_COMPARED]
        assert sorted(map(str, applied[name].select(*columns).collect())) == sorted(
            map(str, current[name].select(*columns).collect())
        )
    gone = cdc.deleted_ids(published["software"], changes["software"], ["id"], "name")
    assert rows(gone, "id", "name") == [("s-shimmer", "Shimmer")]
    store.write_changes({"software": changes["software"]}, str(tmp_path / "changes"))
    assert spark.read.parquet(str(tmp_path / "changes" / "software")).count() == 3


def test_no_changes_and_version_stamp(published):
    changes = pub.diff_tables(published, published)
    assert all(df.isEmpty() for df in (changes["software"], changes["hardware_io"], changes["software_categories"]))
    later = F.lit("2024-05-01 00:00:00").cast("timestamp")
    stamped = dict(rows(pub.stamp_meta(published["dataset_meta"], "8", later), "key", "value"))
    assert stamped == {"version": "8", "created_at": "2024-03-31 12:00:00", "updated_at": "2024-05-01 00:00:00"}


def test_changed_ids(spark, clean, tmp_path):
    after = {k: v.replace("s-glow\nname", "s-other\nname") for k, v in CLEAN.items()}
    current = src.read_documents(spark, write(after, tmp_path))
    assert rows(val.changed_id_findings(clean, current), "slug", "message") == [
        ("glow", "id changed from s-glow to s-other")
    ]
    assert rows(reports.changed_documents(clean, current), "slug") == [("glow",)]
    assert rows(src.owner_ids(clean), "slug", "id")[0] == ("aurora-labs", "m-aurora")


def test_new_ids_are_mapped(published, tmp_path):
    mapping = cdc.rekey(published["manufacturers"].withColumn("collection", F.lit("manufacturers")), "id", ["collection", "name"])
    store.write_report(mapping, str(tmp_path / "mapping"))
    stored = mapping.sparkSession.read.json(str(tmp_path / "mapping"))
    moved = cdc.remap(published["software"].select("id", "manufacturer_id"), "manufacturer_id", stored)
    owners = {r["old_id"]: r["new_id"] for r in stored.collect()}
    assert rows(moved.where("id = 's-glow'"), "manufacturer_id") == [(owners["m-aurora"],)]


def test_assigning_ids_to_documents(broken):
    ids = src.readable(broken).select(
        "collection", "slug", F.try_variant_get("doc", "$.id", "string").alias("id")
    )
    done = cdc.assign_ids(ids, "id", ["collection", "slug"])
    new = done.where("assigned").collect()
    assert sorted(r["slug"] for r in new) == ["no-id", "twice"] or [r["slug"] for r in new] == ["no-id"]
    assert all(len(r["id"]) == 21 for r in new)
    assert done.count() == ids.count()


def test_freshness(clean):
    entries = rows(reports.entry_freshness(clean, as_of()), "slug", "bucket", "discontinued")
    assert entries == [
        ("beacon", "never", False), ("glow", "fresh", False), ("glow-classic", "stale", True), ("shimmer", "never", False)
    ]
    assert rows(reports.price_freshness(clean, as_of()), "slug", "amount", "bucket") == [
        ("glow", 89.5, "never"), ("glow", 99.0, "fresh")
    ]
    assert [tuple(r) for r in reports.freshness_summary(clean, as_of()).collect()] == [(4, 2, 1, 0, 1, 1, 0)]


def test_identifier_coverage(clean):
    entries = reports.identifier_analysis(clean)
    assert rows(entries, "slug", F.array_join("missing_formats", ","), F.size("invalid_identifiers")) == [
        ("glow", "au", 1), ("glow-classic", "vst2", 0), ("shimmer", "", 0)
    ]
    assert rows(coverage.coverage_by_format(entries), "format", "entries_with_format", "entries_with_identifier", "coverage_percent") == [
        ("aax", 1, 1, 100), ("au", 1, 0, 0), ("vst2", 1, 0, 0), ("vst3", 1, 1, 100)
    ]
    assert [tuple(r) for r in coverage.coverage_summary(entries).collect()] == [(3, 1, 2, 33, 1)]
    assert rows(coverage.priority(entries), "slug", "priority") == [("glow-classic", "medium"), ("shimmer", "low")]


def test_link_health(spark, clean, broken, tmp_path):
    found = rows(reports.links(clean), "file", "url")
    assert ("software/glow.yaml", "https://shop.example/glow") in found
    assert ("hardware/beacon.yaml", "https://borealis.example/mk2.pdf") in found
    assert ("software/glow.yaml", "https://aurora.example/de/glow") in found
    assert len(found) == 8
    moment = "2024-03-31 06:00:00"
    cache = spark.createDataFrame(
        [
            ("https://aurora.example", moment, 200, None, None, 7.0),
            ("https://aurora.example/glow", moment, 404, None, None, 1.0),
            ("https://shop.example/glow", moment, 301, "https://shop.example/new", None, 3.0),
            ("https://borealis.example", "2024-03-01 00:00:00", 200, None, None, 7.0),
        ],
        "url string, last_checked string, status int, redirects_to string, error_message string, ttl_days double",
    ).withColumn("last_checked", F.to_timestamp("last_checked"))
    path = str(tmp_path / "cache")
    url_cache.write_cache(cache, path, as_of())
    judged = reports.link_health(clean, url_cache.read_cache(spark, path), as_of())
    assert rows(judged.where("broken"), "url") == [("https://aurora.example/glow",)]
    assert rows(judged.where("redirected"), "url") == [("https://shop.example/glow",)]
    assert judged.where("needs_check").count() == 5
    assert url_cache.read_cache(spark, str(tmp_path / "none")).count() == 0
    unreadable = reports.link_health(broken, cache.limit(0), as_of()).where("url = '(yaml parse error)'")
    assert unreadable.count() == 2


def test_reports_are_written_as_json(clean, tmp_path):
    path = str(tmp_path / "report")
    store.write_report(reports.freshness_summary(clean, as_of()), path)
    assert clean.sparkSession.read.json(path).first()["total_entries"] == 4


@pytest.mark.parametrize(
    "content",
    [
        '{"a":-0,"b":[1.5,1e5,-0.0,true,null,{}],"c":" x: #y "}', '{"a":"\\u00e9 \U0001f600"}'.replace("\\u00e9", "é"), "{}",
        '{"a":1,"a":2}', '{"a":NaN}', '{"a":1e400}', '{"a":"x y"}', '{"a":"x\\ny"}', '{"a" :01}', '{"a":"x\x85y"}', "{a: b}",
        '{"' + "k" * 2000 + '":1}', '{"a":' + "[" * 3000 + "]" * 3000 + "}", '{"a":"x﻿y"}', '{"a":"\t"}', '{"a":1}\n',
    ],
)
def test_json_documents_are_read_as_yaml_would(content, monkeypatch):
    loader = src._loader()
    fast = src._to_json(content, loader)
    monkeypatch.setattr(src, "_from_json", lambda _: None)
    assert fast == src._to_json(content, loader)


def test_packed_documents_are_parsed_once_and_by_all_cores(spark, monkeypatch):
    from shelfwright.plans import document_queries as packed
    from shelfwright.plans.registry import Tables

    raw, parse = [], src.parse
    monkeypatch.setattr(src, "parse", lambda docs: parse(raw.append(docs) or docs))
    docs = packed._documents(Tables(spark, "/root/testdata/sf0.001"))
    assert raw[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = docs.where("collection = 'manufacturers'")._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and "PartitionFilters: [isnotnull(collection" in plan
    assert docs.where("error IS NULL").count() == docs.count() == 210
