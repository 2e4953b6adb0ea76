from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entityflow.functions import labels, names, text, times, urls

NOW = "2026-09-12 12:00:00"


def apply(spark, values, expr):
    """Values through a column expression, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").repartition(2)
    return [r["out"] for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def stamp(*parts):
    return datetime(*parts)


TIMES = [
    ("2 hours ago", stamp(2026, 9, 12, 10)),
    ("Posted 2hours ago by X", stamp(2026, 9, 12, 10)),
    ("Just now", stamp(2026, 9, 12, 12)),
    (" moments ago ", stamp(2026, 9, 12, 12)),
    ("Yesterday", stamp(2026, 9, 11, 12)),
    ("3 weeks ago", stamp(2026, 8, 22, 12)),
    ("1 month ago", stamp(2026, 8, 13, 12)),
    ("1 year ago", stamp(2025, 9, 12, 12)),
    ("2026-09-12T08:00:00Z", stamp(2026, 9, 12, 8)),
    ("2026-09-12T10:00:00+02:00", stamp(2026, 9, 12, 8)),
    ("2026-09-12 10:00", stamp(2026, 9, 12, 10)),
    ("20260912", stamp(2026, 9, 12)),
    ("Sep 9, 2026", stamp(2026, 9, 9)),
    ("September 9, 2026", stamp(2026, 9, 9)),
    ("Wed, Sep 9 2026", stamp(2026, 9, 9)),
    ("9 Sep 2026", stamp(2026, 9, 9)),
    ("Sep 9", stamp(2026, 9, 9)),
    ("2026/09/09", stamp(2026, 9, 9)),
    ("9/10/2026", stamp(2026, 9, 10)),
    ("9 Sep 9 2026", None),
    ("Sep 31, 2026", None),
    ("", None),
    (None, None),
    ("   ", None),
    ("an hour ago", None),
    ("garbage", None),
    ("2026", None),
    ("99999999999999999999 years ago", None),
    ("5000 years ago", None),
]


def test_parse_time(spark):
    got = apply(spark, [raw for raw, _ in TIMES], lambda c: times.parse_time(c, NOW))
    assert dict(zip([r for r, _ in TIMES], got)) == dict(TIMES)


def test_add_time_equals_parse_time(spark):
    from entityflow.operators.timed import add_time

    df = spark.createDataFrame([(r,) for r, _ in TIMES], "v string")
    rows = add_time(df.withColumn("a", times.parse_time("v", NOW)), "v", "b", NOW).collect()
    assert len(rows) == len(TIMES)
    assert all(r["a"] == r["b"] for r in rows)


def test_fuzzy_reader_only_fills_gaps(spark):
    raw = ["Updated on the 3rd of March 2026 at 10:30", "2 hours ago", "garbage", "an hour ago", None,
           "99999999999999999999 years ago"]
    got = apply(spark, raw, lambda c: times.parse_time(c, NOW, fuzzy=True))
    assert got == [stamp(2026, 3, 3, 10, 30), stamp(2026, 9, 12, 10), None, None, None, None]


def test_parse_iso(spark):
    raw = ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.250+0100", "20240102", "2024", "03:04", "2024-1-2", "n/a", None]
    assert apply(spark, raw, times.parse_iso) == [
        stamp(2024, 1, 2), stamp(2024, 1, 2, 3, 4, 5), stamp(2024, 1, 2, 2, 4, 5, 250000), stamp(2024, 1, 2),
        None, None, None, None, None,
    ]


def test_freshness_bounds(spark):
    raw = ["2026-09-11 12:00:00", "2026-09-11 11:59:59.999999", "2026-09-12 12:05:00", "2026-09-12 12:05:00.000001", None]
    assert apply(spark, raw, lambda c: times.is_fresh(c.cast("timestamp"), NOW)) == [True, False, True, False, False]
    # 0 and None mean the default window.
    assert apply(spark, raw[:2], lambda c: times.is_fresh(c.cast("timestamp"), NOW, 0)) == [True, False]
    assert apply(spark, raw[:2], lambda c: times.is_fresh(c.cast("timestamp"), datetime(2026, 9, 12, 12), None)) == [True, False]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-200, 10), min_size=1, max_size=30), st.integers(1, 72))
def test_freshness_grows_with_hours(spark, offsets, hours):
    df = spark.createDataFrame([(o,) for o in offsets], "o int").select(
        F.timestamp_micros(F.unix_micros(F.lit(NOW).cast("timestamp")) + F.col("o").cast("bigint") * 3_600_000_000).alias("ts")
    )
    rows = df.select(times.is_fresh("ts", NOW, hours).alias("a"), times.is_fresh("ts", NOW, hours + 5).alias("b")).collect()
    assert all(r["b"] or not r["a"] for r in rows)


def test_fresh_filter_reaches_the_scan(spark, sf, capsys):
    from entityflow.operators.filters import fresh_only

    df = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    place = spark.conf.get("spark.checkpoint.dir") + "/pushed"
    df.write.mode("overwrite").parquet(place)
    fresh_only(spark.read.parquet(place), "ts", "2024-01-31 00:00:00").explain("formatted")
    out = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts" in out and "LessThanOrEqual(ts" in out


NAMES = {
    "OpenAI, Inc.": "openai", "Open AI": "open ai", "X.AI": "xai", "Hugging Face S.A.": "hugging face sa",
    "Co-op Labs": "op labs", "Café Labs Ltd.": "café labs", " Runway\t ML ": "runway ml", "Inc.": "", "": "",
    "Acme GmbH": "acme", "Foo_Bar PLC": "foo_bar",
}


def test_normalize_name(spark):
    assert dict(zip(NAMES, apply(spark, list(NAMES), names.normalize_name))) == NAMES
    assert apply(spark, ["Open AI, Inc."], names.tight_name) == ["openai"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abcxyzé &-_9 \t", max_size=20), min_size=1, max_size=40))
def test_normalize_is_idempotent_without_suffixes(spark, raw):
    once = apply(spark, raw, names.normalize_name)
    assert apply(spark, once, names.normalize_name) == once


def test_strip_matches_python(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    raw = [f"{s}a {s}b{s}" for s in spaces] + ["​a"]
    assert apply(spark, raw, text.strip) == [r.strip() for r in raw]


def test_labels(spark):
    assert apply(spark, [" Free Trial ", "Contact Sales", "???", None, "", "freemium", "FREE"], labels.pricing_model) == [
        "PAID", "ENTERPRISE", "PAID", "PAID", "PAID", "FREEMIUM", "FREE",
    ]
    titles = ["SWE", "Sweeper", "ML Engineer / Data Scientist", "HTML Engineer", "Chai Engineer", "Research Engineer"]
    assert apply(spark, titles, labels.role_family) == [
        "Software Engineer", "Other", "ML Engineer", "ML Engineer", "AI Engineer", "Research Scientist",
    ]
    assert apply(spark, ["Fully REMOTE", "On site"], labels.is_remote) == [True, False]
    assert apply(spark, ["", None, "Acme"], lambda c: labels.company_or_site(c, F.lit("Board"))) == ["Board", "Board", "Acme"]
    assert apply(spark, ["x"], lambda c: labels.classify(c, {}, "none")) == ["none"]


def test_repo_links(spark):
    assert apply(spark, ["see https://github.com/a/b.", "http://github.com/x-y/z_1 and more", "none", None], text.first_repo_url) == [
        "https://github.com/a/b.", "http://github.com/x-y/z_1", None, None,
    ]
    assert apply(spark, ["https://github.com/a/b.git", "https://github.com/a/b.", "https://example.org/a/b", None], text.repo_slug) == [
        "a/b", "a/b.", None, None,
    ]


def test_small_text(spark):
    assert apply(spark, ["1,234 employees", "7 Employee", "Founded 2019", ", employees", None], text.employee_count) == [1234, 7, None, None, None]
    assert apply(spark, ["\n A\nB  ", "x"], text.clean_title) == ["A B", "x"]
    assert apply(spark, ["a\n\n\n\nb  \t c\n\nd"], text.collapse_whitespace) == ["a\n\nb c\n\nd"]
    assert apply(spark, ["&lt;a&gt; &amp;lt;"], text.unescape_entities) == ["<a> &lt;"]
    row = spark.createDataFrame([([" a ", "", " ", "b"],)], "v array<string>").select(text.clean_array("v").alias("o")).first()
    assert row["o"] == ["a", "b"]
    prompt = apply(spark, ["BODY"], lambda c: text.build_prompt(c, "{}"))[0]
    assert prompt.endswith("SCHEMA:\n{}\n\nCONTENT:\nBODY")


@pytest.mark.parametrize("href, expected", [
    ("/a/b", "https://n.example.com/a/b"), ("//cdn.example.net/x", "https://cdn.example.net/x"),
    ("https://o.example.org/c", "https://o.example.org/c"), ("rel/path", "rel/path"),
    ("/a/../b/./c?q=/../x", "https://n.example.com/b/c?q=/../x"), ("/a/b/..", "https://n.example.com/a/"), ("/..", "https://n.example.com/"),
])
def test_absolute_url(spark, href, expected):
    from urllib.parse import urljoin

    base = "https://n.example.com/category/ai/?page=2"
    assert apply(spark, [href], lambda c: urls.absolute_url(c, F.lit(base))) == [expected]
    if href.startswith("/"):
        assert urljoin(base, href) == expected


def test_canonical_url(spark):
    pairs = {
        "http://Example.COM/a/?utm_source=x&page=2&ref=y#top": "https://example.com/a?page=2",
        "https://example.com/": "https://example.com",
        "https://example.com": "https://example.com",
        "https://User@EXAMPLE.com/A?PHPSESSID=1": "https://User@example.com/A",
        "https://example.com/a?reference=1&a=b": "https://example.com/a?reference=1&a=b",
        "not a url": "not a url",
    }
    assert dict(zip(pairs, apply(spark, list(pairs), urls.canonical_url))) == pairs
    keys = apply(spark, ["http://example.com/a/", "https://EXAMPLE.com/a?utm_medium=m"], urls.url_key)
    assert keys[0] == keys[1] and len(keys[0]) == 64
