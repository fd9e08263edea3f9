"""Shapes of the source documents and of the published tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

PRICE = "amount double, currency string, asOf string, source string"
LINK = "type string, title string, url string, videoId string, provider string, description string"
VERSION = (
    "name string, releaseDate string, releaseDateYearOnly boolean, preRelease boolean, "
    "unofficial boolean, url string, description string"
)
PORT = (
    "name string, signalFlow string, category string, type string, connection string, "
    "maxConnections int, position string, columnPosition int, rowPosition int, description string"
)
REVISION = (
    "name string, releaseDate string, releaseDateYearOnly boolean, url string, description string, "
    f"io array<struct<{PORT}>>, versions array<struct<{VERSION}>>, "
    f"prices array<struct<{PRICE}>>, links array<struct<{LINK}>>"
)
PORT_TRANSLATION = "originalName string, name string, description string"

MANUFACTURER = (
    "id string, name string, companyName string, parentCompany string, website string, "
    "searchTerms array<string>"
)
_PRODUCT = (
    "id string, name string, manufacturer string, website string, releaseDate string, "
    "releaseDateYearOnly boolean, primaryCategory string, secondaryCategory string, "
    "categories array<string>, supersedes string, searchTerms array<string>, "
    f"versions array<struct<{VERSION}>>, prices array<struct<{PRICE}>>, links array<struct<{LINK}>>, "
    "verification struct<lastVerified string, verifiedBy string, status string>"
)
SOFTWARE = (
    f"{_PRODUCT}, formats array<string>, platforms array<string>, identifiers map<string,string>"
)
HARDWARE = f"{_PRODUCT}, io array<struct<{PORT}>>, revisions array<struct<{REVISION}>>"

DOCUMENTS = {"manufacturers": MANUFACTURER, "software": SOFTWARE, "hardware": HARDWARE}
# fields that hold one text or a list of paragraphs; read apart from the rest
TEXTS = {
    "manufacturers": ["description"],
    "software": ["description", "details", "specs"],
    "hardware": ["description", "details", "specs"],
}

# What a document may hold, for the shape rules. A trailing "!" marks a field that must be present;
# "filled!" must not be empty either. A dict stands for a list of such objects.
PRICE_RULES = {"amount": "number!", "currency": "text!", "asOf": "date", "source": "text"}
LINK_RULES = {
    "type": "text!", "title": "text", "url": "video", "videoId": "text", "provider": "text",
    "description": "text",
}
VERSION_RULES = {
    "name": "text!", "releaseDate": "text", "releaseDateYearOnly": "year", "preRelease": "flag",
    "unofficial": "flag", "url": "url", "description": "text", "prices": PRICE_RULES, "links": LINK_RULES,
}
PORT_RULES = {
    "name": "text!", "signalFlow": "text!", "category": "text!", "type": "text!", "connection": "text!",
    "maxConnections": "number", "position": "text", "columnPosition": "number", "rowPosition": "number",
    "description": "text",
}
REVISION_RULES = {
    "name": "text!", "releaseDate": "text", "releaseDateYearOnly": "year", "url": "url",
    "description": "text", "io": PORT_RULES, "versions": VERSION_RULES, "prices": PRICE_RULES,
    "links": LINK_RULES,
}
_PRODUCT_RULES = {
    "name": "filled!", "manufacturer": "filled!", "categories": "texts", "website": "url",
    "releaseDate": "text", "releaseDateYearOnly": "year", "primaryCategory": "text",
    "secondaryCategory": "text", "supersedes": "text", "searchTerms": "texts", "description": "markdown",
    "details": "markdown", "specs": "markdown", "versions": VERSION_RULES, "prices": PRICE_RULES,
    "links": LINK_RULES,
}
RULES = {
    "manufacturers": {
        "name": "filled!", "companyName": "text", "parentCompany": "text", "website": "url",
        "description": "markdown", "searchTerms": "texts",
    },
    "software": {**_PRODUCT_RULES, "formats": "texts", "platforms": "texts", "identifiers": "map"},
    "hardware": {**_PRODUCT_RULES, "io": PORT_RULES, "revisions": REVISION_RULES},
}

# ---------------------------------------------------------------- published tables

_STAMPS = "created_at timestamp, updated_at timestamp"
_PRODUCT_TABLE = (
    "id string, name string, manufacturer_id string, supersedes_id string, website string, "
    "release_date string, release_date_year_only int, primary_category string, "
    f"secondary_category string, description string, details string, specs string, {_STAMPS}"
)
_VERSION_COLUMNS = (
    "name string, release_date string, release_date_year_only int, pre_release int, unofficial int, "
    "url string, description string"
)
_LINK_COLUMNS = (
    "type string, title string, url string, video_id string, provider string, description string"
)
_PORT_COLUMNS = (
    "name string, signal_flow string, category string, type string, connection string, "
    "max_connections int, position string, column_position int, row_position int, description string"
)
_PRICE_COLUMNS = "amount double, currency string"
_SEARCH = "id string, name string, manufacturer_name string, categories string, description string"
_CONTENT = "locale string, description string, details string, specs string, website string"

TABLES: dict[str, str] = {
    "manufacturers": "id string, name string, company_name string, parent_company_id string, "
    f"website string, description string, {_STAMPS}",
    "manufacturer_search_terms": "manufacturer_id string, term string",
    "software": _PRODUCT_TABLE,
    "software_categories": "software_id string, category string",
    "software_search_terms": "software_id string, term string",
    "software_formats": "software_id string, format string, identifier string",
    "software_platforms": "software_id string, platform string",
    "software_versions": f"id string, software_id string, {_VERSION_COLUMNS}",
    "software_prices": f"id string, software_id string, {_PRICE_COLUMNS}",
    "software_links": f"id string, software_id string, {_LINK_COLUMNS}",
    "hardware": _PRODUCT_TABLE,
    "hardware_categories": "hardware_id string, category string",
    "hardware_search_terms": "hardware_id string, term string",
    "hardware_io": f"id string, hardware_id string, {_PORT_COLUMNS}",
    "hardware_versions": f"id string, hardware_id string, {_VERSION_COLUMNS}",
    "hardware_revisions": "id string, hardware_id string, name string, release_date string, "
    "release_date_year_only int, url string, description string",
    "hardware_revision_io": f"id string, revision_id string, {_PORT_COLUMNS}",
    "hardware_revision_versions": f"id string, revision_id string, {_VERSION_COLUMNS}",
    "hardware_prices": f"id string, hardware_id string, {_PRICE_COLUMNS}",
    "hardware_revision_prices": f"id string, revision_id string, {_PRICE_COLUMNS}",
    "hardware_links": f"id string, hardware_id string, {_LINK_COLUMNS}",
    "hardware_revision_links": f"id string, revision_id string, {_LINK_COLUMNS}",
    "locales": "code string, name string, native_name string, enabled int",
    "category_translations": "locale string, category_key string, translated_name string",
    "manufacturer_translations": "manufacturer_id string, locale string, description string, website string",
    "software_translations": f"software_id string, {_CONTENT}",
    "hardware_translations": f"hardware_id string, {_CONTENT}",
    "software_links_localized": f"id string, software_id string, locale string, {_LINK_COLUMNS}",
    "hardware_links_localized": f"id string, hardware_id string, locale string, {_LINK_COLUMNS}",
    "hardware_io_translations": "hardware_id string, locale string, original_name string, "
    "translated_name string, translated_description string",
    "software_fts": _SEARCH,
    "hardware_fts": _SEARCH,
    "dataset_meta": "key string, value string",
    "schema_migrations": "version int, description string, breaking_change int, applied_at timestamp",
}


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])
