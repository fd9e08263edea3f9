"""Column functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from shelfwright.functions import dates, identifiers, stemming, text, urls


def column(spark, values, make, ddl="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v")).alias("r")).collect()]


def test_slugs(spark):
    names = ["Some Name", "  Odd -- Name! ", "ÄÖ x", "a__b", "UPPER-case 2", "---", "a\nb"]
    assert column(spark, names, text.slug_of) == ["some-name", "odd-name", "x", "ab", "upper-case-2", "", "a-b"]
    slugs = ["a", "a-b", "ab1", "-a", "a-", "A", "", "a b", "a\n"]
    assert column(spark, slugs, text.is_slug) == [True, True, True, False, False, False, False, False, False]


def test_repeats(spark):
    found = column(spark, [["a", "b", "a", "a"], ["a"], [], ["x", "y"]], text.repeats, "array<string>")
    assert [[(r["value"], r["pos"]) for r in rows or []] for rows in found] == [[("a", 2), ("a", 3)], [], [], []]


def test_markdown(spark):
    bodies = ["`a`", "`a", "```\nodd `\n```\nodd `", "  ```js\n`\n```", "plain"]
    assert column(spark, bodies, text.odd_marker_lines) == [[], [1], [4], [], []]
    assert column(spark, bodies, text.fences_balanced) == [True, True, True, True, True]
    assert column(spark, ["```\nx", "``` ```"], text.fences_balanced) == [False, True]


def test_option_list(spark):
    many = [chr(ord("a") + i) for i in range(12)]
    shown = lambda c: text.option_list(c, F.size(c))
    assert column(spark, [["b", "a"], many], shown, "array<string>") == [
        "a, b", "a, b, c, d, e, f, g, h, i, j, ... (12 total)"
    ]


def test_paths(spark):
    found = column(spark, ["a.0.b", "", "x", "10x.y"], text.path_parts)
    assert [[(p["key"], p["index"]) for p in parts] for parts in found] == [
        [("a", None), ("0", 0), ("b", None)], [], [("x", None)], [("10x", 10), ("y", None)]
    ]


def test_tokens(spark):
    assert column(spark, ["Über-cool 3D, l'été", ""], text.tokens) == [["über", "cool", "3d", "l", "été"], []]
    bodies = ["a with b", "without", "x-with.", "WITH"]
    assert column(spark, bodies, lambda c: text.has_token(c, "with")) == [True, False, True, True]
    assert column(spark, bodies, lambda c: text.has_token(c, "with", prefix=True)) == [True, True, True, True]


def test_percent(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (0, 0), (1, 200), (1, 8)], "a int, b int")
    got = [r[0] for r in df.select(text.rounded_percent(F.col("a"), F.col("b"))).collect()]
    assert got == [50, 33, 0, 1, 13]


def test_dates(spark):
    assert column(spark, ["2024-02-29", "2023-02-29", "2024-1-1", "2024-01-01x", "soon"], dates.is_iso_date) == [
        True, False, False, False, False
    ]
    years = ["2001", "2001-01-01", None, "2001\n", "20011"]
    assert column(spark, years, lambda c: dates.year_only_ok(F.lit(True), c)) == [True, False, False, False, False]
    as_of = F.lit("2024-01-02 12:00:00").cast("timestamp")
    moments = ["2024-01-01", "2024-01-02T11:00:00Z", "2024-01-03", "never"]
    assert column(spark, moments, lambda c: dates.whole_days(dates.instant(c), as_of)) == [1, 0, -1, None]


def test_urls(spark):
    values = ["https://a.example/x", "http://a", "mailto:a@b.example", "nothing", "https://", "http://a b", "ftp://h/x|y", "https://[::1]/"]
    assert column(spark, values, urls.is_url) == [True, True, True, False, False, False, True, True]


@pytest.mark.parametrize(
    "url, part",
    [
        ("https://www.youtube.com/watch?v=a-b_1", None),
        ("https://elsewhere.example/embed/x", None),
        ("no url", None),
        ("https://youtube.com/watch?v=a", "instead of 'youtube.com'"),
        ("https://M.youtube.com/embed/a", "instead of 'm.youtube.com'"),
        ("https://www.youtube.com/embed/a", "'/embed/'"),
        ("https://youtu.be/embed/a", "'/embed/'"),
        ("https://youtu.be/a", "'youtu.be'"),
        ("http://www.youtube.com/watch?v=a", "must match"),
        ("https://www.youtube.com/watch?v=a&t=1", "must match"),
    ],
)
def test_video_urls(spark, url, part):
    [error] = column(spark, [url], urls.video_url_error)
    assert error is None if part is None else part in error


def test_identifiers(spark):
    cases = [
        ("au", "com.vendor.Thing", None), ("au", "single", "not an identifier"), ("au", "com.1vendor", "not an identifier"),
        ("bundle", "a.b-c", None), ("vst3", " ", "no value"), ("clap", None, "no value"), ("aax", "AbC1", None),
        ("aax", "AbC", "not an identifier"), ("aax", "AbC12", "not an identifier"), ("lv2", "https://x", None), ("lv2", "x", "not an identifier"),
        ("vst2", "", None), ("aax", "AbC1\n", "not an identifier"),
    ]
    df = spark.createDataFrame([(i, f, v) for i, (f, v, _) in enumerate(cases)], "i int, f string, v string")
    got = [r[0] for r in df.orderBy("i").select(identifiers.identifier_error(F.col("f"), F.col("v"))).collect()]
    for (_, _, want), error in zip(cases, got):
        assert error is None if want is None else error.startswith(want)


def test_stems():
    # pairs from the published description of the algorithm
    pairs = {
        "caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster",
        "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall",
        "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
        "digitizer": "digit", "vietnamization": "vietnam", "hopefulness": "hope", "formality": "formal",
        "triplicate": "triplic", "electrical": "electr", "goodness": "good", "revival": "reviv",
        "allowance": "allow", "adjustment": "adjust", "adoption": "adopt", "effective": "effect",
        "probate": "probat", "rate": "rate", "controll": "control", "roll": "roll", "oscillators": "oscil",
    }
    assert {word: stemming.stem(word) for word in pairs} == pairs
    assert stemming.fold("Éçàü") == "ecau"
