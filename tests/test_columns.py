"""Table-driven checks of the column library."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from jobloom.functions import columns as C


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, want", [
    ("HTTPS://Jobs.Example.com:443/a/b/?utm_source=x&b=2&a=1#top", "https://jobs.example.com/a/b?a=1&b=2"),
    ("http://x.io:8080", "http://x.io:8080/"),
    ("http://x.io:80/p//", "http://x.io/p"),
    ("https://hirify.me/jobs/7?v=3&k=", "https://hirify.me/jobs/7?k="),
    ("https://www.hirify.me/jobs/7?v=3", "https://www.hirify.me/jobs/7"),
    ("https://other.io/?v=3", "https://other.io/?v=3"),
    ("https://people.andersenlab.com/x", "https://people-andersenlab.com/x"),
    ("https://user@x.io/a?q=a+b&z=%7E*", "https://x.io/a?q=a+b&z=~%2A"),
    ("  ", ""),
    (None, ""),
])
def test_canonical_url(spark, raw, want):
    assert C.with_canonical_url(spark.range(1).select(F.lit(raw).cast("string").alias("url"))).first().canonical_url == want


@pytest.mark.parametrize("a, b", [("N-iX", "n-ix"), ("n  ix", "n-ix"), ("Soft-Serve", "softserve"), (" Acme\tApps ", "acme apps"), (None, "")])
def test_company(spark, a, b):
    assert value(spark, C.canonical_company(F.lit(a).cast("string"))) == b


@pytest.mark.parametrize("title, description, topic, level, junior", [
    ("Senior iOS Developer", None, "native_ios", "senior", False),
    ("Lead QA Engineer (iOS)", None, None, "lead", False),
    ("iOS / Android Developer", None, "cross_platform", "unknown", False),
    ("Kotlin Multiplatform Engineer", None, "kmp", "unknown", False),
    ("Mobile Engineer", None, "mobile", "unknown", False),
    ("Mobile Developer (Android)", None, None, "unknown", False),
    ("Mobile Developer (Android)", "some SwiftUI", "ios_in_description", "unknown", False),
    ("macOS Engineer", None, "apple_platform", "unknown", False),
    ("Senior Staff iOS Engineer", None, "native_ios", "staff", False),
    ("Junior iOS Developer", None, "native_ios", "junior", True),
    ("Junior to Senior iOS Developer", None, "native_ios", "senior", False),
    ("Стажер iOS", None, "native_ios", "junior", True),
    ("Biosensor Engineer", None, None, "unknown", False),
])
def test_topic(spark, title, description, topic, level, junior):
    t, d = F.lit(title), F.lit(description).cast("string")
    assert value(spark, C.topic(t, d)) == topic
    assert value(spark, C.title_level(t)) == level
    assert value(spark, ~C.is_target_level(t)) is junior


@pytest.mark.parametrize("location, remote, mode_ok, place_ok, attention, workable", [
    ("Kyiv, Ukraine", "onsite", True, True, False, True),
    ("КИЇВ", "", True, True, False, True),
    (None, None, True, True, True, None),
    (None, "remote", True, True, True, True),
    ("Remote", "", True, True, False, True),
    ("Fully remote, work from home only", "remote", True, True, False, True),
    ("US only", "remote", True, False, True, True),
    ("Berlin", "onsite", False, False, False, False),
    ("Львів", "remote", True, True, False, True),
    ("no remote, Paris", "remote", False, False, False, False),
])
def test_location(spark, location, remote, mode_ok, place_ok, attention, workable):
    a = F.lit(location).cast("string"), F.lit(remote).cast("string")
    assert value(spark, C.is_work_mode_eligible(*a)) is mode_ok
    assert value(spark, C.is_location_eligible(*a)) is place_ok
    assert value(spark, C.location_attention(*a)) is attention
    assert value(spark, C.workable(*a)) is workable


@pytest.mark.parametrize("text, want", [("not remote", "onsite"), ("hybrid, remote", "hybrid"), ("on-site", "onsite"), ("worldwide", "remote"), ("office", "onsite"), ("", "unknown"), ("віддалено", "remote")])
def test_infer_remote(spark, text, want):
    assert value(spark, C.infer_remote(F.lit("x"), F.lit(text), F.lit(None).cast("string"))) == want


@pytest.mark.parametrize("text, want", [
    ("Authorized to work in the US.", ["local work authorization required"]),
    ("Must be a US citizen", ["citizenship or permanent residency required"]),
    ("Security clearance. Citizens only", ["security clearance required", "citizenship or permanent residency required"]),
    ("We offer visa support, right to work needed", ["local work authorization required"]),
    ("Right to work in Ukraine", []),
    ("Nice to have:\nwork permit required", []),
    ("Bonus\nCitizens only\nRequirements\nCitizens only", ["citizenship or permanent residency required"]),
    ("Work permit is optional", []),
    (None, []),
])
def test_blockers(spark, text, want):
    assert value(spark, C.authorization_blockers(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, want", [("hello", "en"), ("123", "unknown"), ("Привіт, це їжак", "uk"), ("Это мы", "ru"), ("Senior iOS developer у Києві", "en"), (None, "unknown")])
def test_language(spark, text, want):
    assert value(spark, C.language(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("a, b", [("Senior iOS Developer", "iOS Engineer (AI)"), ("Sr. iOS Engineer", "iOS Developer [Team]"), ("iOS, Engineer", "iOS Engineer")])
def test_family_joins(spark, a, b):
    assert value(spark, C.role_family_title(F.lit(a))) == value(spark, C.role_family_title(F.lit(b)))


def test_family_keeps(spark):
    assert value(spark, C.role_family_title(F.lit("Lead iOS Engineer"))) != value(spark, C.role_family_title(F.lit("Senior iOS Engineer")))
    assert value(spark, C.role_family_title(F.lit("Software Engineer (iOS)"))) == "software engineer (ios)"


@pytest.mark.parametrize("n, want", [(1, "a"), (2, "b"), (5, "c"), (11, "c"), (12, "c"), (21, "a"), (112, "c"), (0, "c")])
def test_number_form(spark, n, want):
    assert value(spark, C.number_form(F.lit(n), "a", "b", "c")) == want


def test_slug_and_source_id(spark):
    assert value(spark, C.title_from_slug(F.lit("https://x.io/jobs/senior-ios_dev/"))) == "senior ios dev"
    assert value(spark, C.source_id(F.lit("Acme"), F.lit("https://www.Acme.io/jobs"))) == "company:Acme@acme.io"
    assert value(spark, C.same_origin(F.lit("https://a.io/x"), F.lit("https://A.io/y"))) is True
    assert value(spark, C.same_origin(F.lit("https://a.io/x"), F.lit("http://a.io/y"))) is False
    assert value(spark, C.strip_tracking(F.lit("https://a.io/x?utm_a=1&B=2&c#f"))) == "https://a.io/x?B=2&c"
    assert value(spark, C.short_list(F.array(*map(F.lit, "abcde")))) == "a, b, c (+2)"


@pytest.mark.parametrize("base", ["https://x.io/careers/", "https://x.io", "http://a/b/c/d;p?q", "https://X.io/a/b?x=1#f", "https://x.io:8080/a//b/", "", "ftp://f/x/y", "https://x.io/a/../b/./c"])
def test_links_are_resolved_as_a_browser_does(spark, base):
    hrefs = ["g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", ";x", "", "..", "../", "../g", "../..", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./../g", "./g/.", "g/../h", "http:g", "https:g", "HTTPS://Y.io/a?#", "mailto:a@b", " /jobs/1 ", "a\tb\n", "?", "//y.io//a//b", "a//b", "/a//b/../c", None, "jobs/über straße?q=ж"]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string")
    assert [(r.h, r.u) for r in df.select("h", C.resolve_url(F.lit(base), F.col("h")).alias("u")).collect()] == [(h, urljoin(base, h or "")) for h in hrefs]


def test_masked_tokens_and_walls(spark):
    token = "12:ab"
    for url, want in (("https://t/bot12:ab/x?k=12:ab#12:ab", "https://t/bot[redacted]/x?k=12:ab#12:ab"), ("https://t/x12:ab/12:ab", "https://t/x[redacted]/[redacted]"), ("https://t/botx/y", "https://t/botx/y"), ("https://t/bot/12:ab", "https://t/bot/12:ab"), ("12:ab", "[redacted]"), (None, None)):
        assert value(spark, C.redact_token(F.lit(url).cast("string"), token)) == want
    assert value(spark, C.redact_token(F.lit("https://t/bot12:ab"), "")) == "https://t/bot12:ab"
    for body, wall in (("x Just a moment... y", True), ("JUST A MOMENT...", True), ("just a moment", False), ("Just a moment..." + "x" * 24_000, False), ("Attention Required! | Cloudflare", True), (None, False)):
        assert value(spark, C.looks_like_bot_wall(F.lit(body).cast("string"))) is wall


def test_links_from_the_root_and_whole_links_are_resolved_as_by_a_browser(spark):
    bases = ["https://x.io", "https://x.io?q", "https://u@x.io:80/a/b?c#d", "http://x.io/a", "HTTPS://x.io/a", "https://x\t.io/a", "file:///a/b", "x/y"]
    hrefs = ["/a", "/", "/a//b/", "/a/./b", "/.a/b", "/a/..", "/a?", "/a#", "/a?b#", "/a?b/.c#d", "//y/a", "///a", "/a\tb", "https://y.io", "https://y.io/a/../b", "http://y.io/?", "https:///a", "https://y.io/a?b#c", "HTTPS://Y.io/a"]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    assert [(r.b, r.h, r.u) for r in df.select("b", "h", C.resolve_url(F.col("b"), F.col("h")).alias("u")).collect()] == [(b, h, urljoin(b, h)) for b in bases for h in hrefs]


def test_let_computes_its_value_once_a_row(spark):
    assert [r.x for r in spark.range(3).select(C.let(F.col("id") + 1, lambda v: v * v).alias("x")).collect()] == [1, 4, 9]
