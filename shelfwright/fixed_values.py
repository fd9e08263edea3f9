"""Constants of the dataset contract, stated as they are. No logic lives here."""

# Plugin formats, platforms and approved locales (defaults when no file is given).
FORMATS = ["au", "vst", "vst2", "vst3", "aax", "rtas", "tdm", "clap", "lv2", "standalone"]
PLATFORMS = ["mac", "windows", "linux", "ios", "android"]
LOCALES = [
    ("de", "German", "Deutsch"),
    ("es", "Spanish", "Español"),
    ("fr", "French", "Français"),
    ("ja", "Japanese", "日本語"),
    ("ko", "Korean", "한국어"),
    ("pt-BR", "Portuguese (Brazil)", "Português (Brasil)"),
    ("zh", "Chinese", "中文"),
]
CATEGORY_ALIASES = {
    "effects": "effect",
    "fx": "effect",
    "eq": "equalizer",
    "pitchshifting": "pitch-shifter",
    "headphone": "headphones",
}

# A format that never needs an identifier, and the ones that make a gap urgent.
FORMAT_WITHOUT_IDENTIFIER = "standalone"
URGENT_FORMATS = ["au", "vst3", "aax", "clap"]

# Identifier pattern and hint per format. A format not listed accepts any value.
REVERSE_DOMAIN = r"\A[a-zA-Z][a-zA-Z0-9-]*(\.[a-zA-Z][a-zA-Z0-9-]*){1,}\z"
IDENTIFIER_PATTERNS = {
    "au": REVERSE_DOMAIN,
    "bundle": REVERSE_DOMAIN,
    "vst3": REVERSE_DOMAIN,
    "clap": REVERSE_DOMAIN,
    "aax": r"\A[A-Za-z0-9]{4}\z",
    "lv2": r"\Ahttps?://.+\z",
}
IDENTIFIER_HINTS = {
    "au": "Reverse domain notation (e.g., com.xferrecords.Serum)",
    "bundle": "Reverse domain notation (e.g., com.vendor.AppName)",
    "vst3": "Reverse domain notation (e.g., com.native-instruments.Massive)",
    "clap": "Reverse domain notation (e.g., com.u-he.Diva)",
    "aax": "4-character PACE code (e.g., XfRc)",
    "lv2": "URI format (e.g., https://vendor.com/plugins/name)",
}

# Slug shape.
SLUG_PATTERN = r"\A([a-z0-9][a-z0-9-]*[a-z0-9]|[a-z0-9])\z"

# Video hosts and the one accepted URL shape.
VIDEO_HOSTS = ["youtube.com", "www.youtube.com", "m.youtube.com", "youtu.be"]
VIDEO_BARE_HOSTS = ["youtube.com", "m.youtube.com"]
VIDEO_SHORT_HOST = "youtu.be"
VIDEO_CANONICAL = r"\Ahttps://www\.youtube\.com/watch\?v=[A-Za-z0-9_-]+\z"

# Days a link check stays valid, by outcome.
TTL_DAYS = {
    "success": 7.0,
    "redirect": 3.0,
    "client_error": 1.0,
    "server_error": 1.0,
    "network_error": 0.25,
}
URL_CACHE_VERSION = 1

# Report thresholds.
ENTRY_STALE_DAYS = 180
PRICE_STALE_DAYS = 90
NEAREST_MAX_DISTANCE = 3
OPTION_LIST_LIMIT = 10
OWNER_LIST_LIMIT = 10

# Fields a translation may carry, per collection.
TRANSLATION_FIELDS = {
    "manufacturers": ["description", "website"],
    "software": ["description", "details", "specs", "website", "links"],
    "hardware": ["description", "details", "specs", "website", "links", "io"],
}

# Finding codes, their titles and documentation anchors.
FINDING_CODES = [
    ("E100", "Missing required field", "e100-missing-required-field"),
    ("E101", "Invalid field type", "e101-invalid-field-type"),
    ("E103", "Invalid URL format", "e103-invalid-url-format"),
    ("E104", "Invalid category", "e104-invalid-category"),
    ("E105", "Invalid platform", "e105-invalid-platform"),
    ("E106", "Invalid format", "e106-invalid-format"),
    ("E107", "Invalid locale", "e107-invalid-locale"),
    ("E108", "Invalid date format", "e108-invalid-date-format"),
    ("E110", "YAML syntax error", "e110-yaml-syntax-error"),
    ("E199", "Validation error", "e199-validation-error"),
    ("E200", "Manufacturer not found", "e200-manufacturer-not-found"),
    ("E202", "Duplicate category", "e202-duplicate-category"),
    ("E203", "Parent company not found", "e203-parent-company-not-found"),
    ("E204", "I/O translation mismatch", "e204-io-translation-mismatch"),
    ("E300", "Invalid markdown", "e300-invalid-markdown"),
    ("E301", "Invalid YouTube URL format", "e301-youtube-url-format"),
    ("E302", "Unclosed code block", "e302-unclosed-code-block"),
    ("E303", "Unbalanced backticks", "e303-unbalanced-backticks"),
    ("E400", "Invalid identifier format", "e400-invalid-identifier-format"),
    ("E401", "Missing identifier", "e401-missing-identifier"),
]

# Schema history (version, description, breaking).
SCHEMA_MIGRATIONS = [
    (1, "Initial schema with manufacturers, software, hardware tables", 0),
    (2, "Added software_categories many-to-many table", 0),
    (3, "Added FTS5 full-text search for software and hardware", 0),
    (4, "Added hardware_io table for I/O port definitions", 0),
    (5, "Added prices and links tables for software and hardware", 0),
    (6, "Added locales and translation tables", 0),
    (7, "Added hardware_revisions tables for hardware variants", 0),
    (8, "Added hardware_io_translations table", 0),
    (9, "Migrated IDs from auto-increment integers to nanoid strings", 1),
    (10, "Added schema_migrations table for version tracking", 0),
    (11, "Added supersedes_id column for product lineage tracking", 0),
]

# The order in which changes of the collections must be applied.
COLLECTIONS = ["manufacturers", "software", "hardware"]
