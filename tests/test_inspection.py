"""Crawls, discovery, evaluation, reports and pages: every query against its SQL, and small cases."""

import json

import pytest
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators import reports, watchlist
from jobloom.plans import inspection, run
from jobloom.sources import crawl, discovery, feeds
from tests.oracle import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(inspection.QUERIES))
def test_query(spark, sf_dir, name):
    got = rows_of(inspection.QUERIES[name](spark, sf_dir))
    assert got == sql_rows(inspection.SQL[name], sf_dir) and got[1]


def _visit(spark, edges, most):
    links = spark.createDataFrame([("s", a, i, b) for i, (a, b) in enumerate(edges)], "source_id string, url string, pos long, next string")
    out = crawl.visit(spark.createDataFrame([("s", "a")], "source_id string, url string"), links, most).collect()
    return [(r.url, r.visited) for r in sorted(out, key=lambda r: r.nth)]


def test_visits_in_the_order_of_a_reader(spark):
    cyclic = [("a", "c"), ("a", "b"), ("b", "a"), ("c", "d"), ("b", "e"), ("d", "a"), ("d", "d"), ("c", "b"), ("e", "f")]
    order, pending, seen = [], ["a"], {"a"}
    while pending:
        at = pending.pop(0)
        order.append(at)
        for x, y in cyclic:
            if x == at and y not in seen:
                seen.add(y), pending.append(y)
    assert _visit(spark, cyclic, 20) == [(u, True) for u in order]
    assert _visit(spark, cyclic, 2) == [("a", True), ("c", True), ("b", False), ("d", False)]
    deep = [(chr(97 + i), chr(98 + i)) for i in range(24)]
    assert _visit(spark, deep, 20) == [(chr(97 + i), i < 20) for i in range(21)]


def test_listed_details_count_what_is_left(spark):
    places = spark.createDataFrame([("s", 0, "v-1 v-2 v-1"), ("s", 1, "v-3 v-2"), ("t", 0, None), ("u", 0, "none"), ("w", 0, "v-9")], "source_id string, place int, body string")
    details = spark.createDataFrame([("v-1", "A", "x"), ("v-2", None, "x"), ("v-3", "C", "x")], "url string, title string, body string")
    good, states = crawl.listed_details(places, details, "(v-[0-9])", F.col("slug"), most=2)
    assert [(r.source_id, r.url, r.nth) for r in good.collect()] == [("s", "v-1", 1)]
    assert {(r.source_id, r.listed, r.deferred, r.read, r.errors, r.status) for r in states.collect()} == {("s", 3, 1, 1, 2, "degraded"), ("t", 0, 0, 0, 1, "failed"), ("u", 0, 0, 0, 0, "healthy"), ("w", 1, 0, 0, 1, "failed")}


def test_numbered_and_chained_pages(spark):
    pages = spark.createDataFrame([("whole", 1, 2), ("whole", 2, 2), ("whole", 3, 9), ("gap", 1, 4), ("gap", 2, 4), ("gap", 4, 4), ("grows", 1, 2), ("grows", 2, 3), ("grows", 3, 3), ("long", 1, 7), ("long", 2, 7), ("long", 3, 7), ("late", 2, 2), ("mute", 1, None)], "source_id string, page int, last int")
    got = {r.source_id: (r.read, r.missing, r.deferred, r.status) for r in feeds.numbered_pages(pages, 3).collect()}
    assert got == {"whole": (2, 0, 0, "healthy"), "gap": (2, 1, 1, "degraded"), "grows": (3, 0, 0, "healthy"), "long": (3, 0, 4, "degraded"), "late": (0, 1, 0, "failed"), "mute": (1, 0, 0, "healthy")}
    chain = spark.createDataFrame([("whole", 0, 2, False), ("whole", 2, 1, True), ("empty", 0, 2, None), ("empty", 2, 0, None), ("cut", 0, 2, False), ("torn", 0, 2, False), ("torn", 5, 1, True), ("late", 3, 1, True)], "source_id string, start long, got long, done boolean")
    got = {r.source_id: (r.read, r["items"], r.ended, r.status) for r in feeds.chained_pages(chain).collect()}
    assert got == {"whole": (2, 3, True, "healthy"), "empty": (2, 2, True, "healthy"), "cut": (1, 2, False, "degraded"), "torn": (1, 2, False, "degraded"), "late": (0, 0, False, "failed")}


def test_company_without_signals_reads_further_pages_to_the_first_that_has_them(spark):
    site, long = "https://acme.io", "<p>" + "words of a page " * 40 + "</p>"
    more = "".join(f'<a href="/careers/page/{i}">{i}</a>' for i in range(2, 9))
    attempts = [
        (discovery.PROFILE + "acme/", 200, f'<div class="site"><a href="{site}" target="_blank" rel="nofollow">x</a></div>'), (site, 200, '<a href="/careers">Jobs</a>'), (f"{site}/careers", 200, long + more),
        (f"{site}/careers/page/2", 403, "swift"), (f"{site}/careers/page/3", 200, "Objective C"), (f"{site}/careers/page/4", 200, "flutter"), (f"{site}/careers/page/7", 200, "iPad"),
    ]
    r = discovery.inspect(spark.createDataFrame([("acme", False), ("lost", True)], "slug string, has_vacancies boolean"), spark.createDataFrame(attempts, "url string, status int, body string"))
    got = {x.slug: x for x in r.collect()}
    assert (got["acme"].career_state, got["acme"].career.ios, got["acme"].career.mobile, got["acme"].strength, got["acme"].listed) == ("read", ["objective c"], [], "ios", None)
    assert (got["lost"].career_state, got["lost"].career_url, got["lost"].strength) == ("no_site", None, None)


def test_strength_of_mobile_words(spark):
    rows = [("read", [], ["mobile"], None), ("read", [], ["react native"], "mobile_stack"), ("read", ["swift"], [], "ios"), ("js_rendered", ["swift"], [], None)]
    df = spark.createDataFrame([(a, {"ios": b, "mobile": c}, d) for a, b, c, d in rows], "state string, career struct<ios: array<string>, mobile: array<string>>, want string")
    none = F.lit(None).cast("struct<ios: array<string>, mobile: array<string>>")
    assert [r.want for r in df.collect()] == [r.s for r in df.select(discovery.strength(F.col("state"), F.col("career"), none).alias("s")).collect()]


RAW = "id string, seq long, pos long, company string, title string, url string, source string, location string, remote string, published_at string, description string, source_job_id string, track string, russian_company boolean, expected boolean"


def _case(id_, pos, title, url, description=None, expected=True, location="Kyiv"):
    return (id_, pos, pos, "Acme", title, url, "company", location, None, None, description, None, "ios", False, expected)


def test_groups_are_played_in_both_orders(spark):
    rows = [_case("a", 1, "iOS Developer", "https://x/1"), _case("a", 2, "iOS Developer", "https://x/2", "longer"), _case("b", 1, "iOS Developer", "https://x/1"), _case("c", 1, "Accountant", "https://x/9"), _case("c", 2, "iOS Developer", "https://x/1")]
    expected = spark.createDataFrame([("a", ["https://x/2"]), ("b", ["https://x/7"]), ("c", ["https://x/1"])], "id string, urls array<string>")
    got = {(r.id, r.backwards): (r.rows, r.normal, r.urls, r.ok) for r in run.evaluate_duplicates(spark.createDataFrame(rows, RAW), expected).collect()}
    for back in (False, True):
        assert got["a", back] == (2, 2, ["https://x/2"], True)
        assert got["b", back] == (1, 1, ["https://x/1"], False)
        assert got["c", back] == (2, 1, ["https://x/1"], False)


def test_labels_and_silent_attention(spark):
    cases = spark.createDataFrame([_case("a", 1, "Senior iOS Developer", "https://x/1"), _case("b", 2, "iOS Developer", "https://x/2", location=""), _case("c", 3, "iOS Developer", "https://x/3", expected=False, location="")], RAW)
    expected = spark.createDataFrame([("a", "level", "senior"), ("b", "level", "senior")], "id string, name string, value string")
    assert {(r.id, r.name, r.value, r.actual) for r in run.evaluate_labels(cases, expected).collect()} == {("b", "level", "senior", "unknown"), ("b", "attention", "false", "true")}


def test_reports_escape_cells(spark):
    report = spark.createDataFrame([(json.dumps({"status": "failed", "counts": {"raw": 1}, "sources": [{"id": "a", "name": "A|B", "status": "failed", "reason": "x\n<y>", "scanned": 0, "skipped": 0, "normalized": 0, "inbox_eligible": 0}]}),)], "report string")
    lines = [r.line for r in reports.summary_lines(report).orderBy("nth").collect()]
    assert lines[2] == "Status: **failed**" and lines[-1] == "| A / B | failed | 0 | 0 | 0 | 0 | x &lt;y> |"


def test_ranked_company_under_another_name(spark):
    companies = spark.createDataFrame([("EPAM", "epam", None)], "name string, slug string, career_url string").withColumn("career_url_source", F.lit(None).cast("string"))
    ranked = spark.createDataFrame([("EPAM Ukraine", 1), (" epam", 2), ("New Co!", 3), ("new co!", 4), ("Lost", 5), (None, 6)], "name string, rank int")
    links = spark.createDataFrame([("new-co", "https://n"), ("lost", "")], "slug string, career_url string")
    assert [(r.name, r.slug, r.career_url, r.career_url_source) for r in watchlist.add_ranked(companies, ranked, links).orderBy("slug").collect()] == [("EPAM", "epam", None, None), ("New Co!", "new-co", "https://n", "override")]


def test_problems_are_found_once_for_many_heartbeats(spark):
    """Summaries of long lists are rows of their own: what stands at each event is their lines, not the names."""
    s = spark.createDataFrame([(1, [f"s{i}" for i in range(9)], [], [], [])], "n int, failed_names array<string>, manual_names array<string>, degraded_names array<string>, skipped_names array<string>")
    found = reports.with_problems(s)
    assert found.columns == ["n", "problems"]
    clock = spark.sql("SELECT 1 AS n, TIMESTAMP_NTZ '2024-01-15 08:00:00' AS ts UNION ALL SELECT 2, TIMESTAMP_NTZ '2024-01-15 08:00:00'")
    told = {r.n: r.heartbeat for r in reports.heartbeat(clock.join(found, "n", "left"), F.col("ts"), "n").collect()}
    assert told[1].split("\n")[1] == "⚠️ Не ответили: s0, s1, s2 (+6)" and "🟢" in told[2]


def test_variants_are_normalised_once_for_both_orders(spark, sf_dir, monkeypatch):
    seen, normalize = [], run.postings.normalize
    monkeypatch.setattr(run.postings, "normalize", lambda df: (seen.append(df.columns), normalize(df))[1])
    rows = inspection.q_eval_duplicates(spark, sf_dir)
    assert len(seen) == 1 and rows.count() > 0


def test_links_are_resolved_and_scored_once(spark, monkeypatch):
    """A link was resolved again by the filter on it, and its score and host again for each filter, order and name of a host."""
    seen, best = [], watchlist.best_link

    def caught(links, *rest):
        seen.extend([links, best(links, *rest)])
        return seen[1]

    monkeypatch.setattr(watchlist, "best_link", caught)
    companies = spark.createDataFrame([("c", False)], "slug string, has_vacancies boolean")
    attempts = spark.createDataFrame([("https://jobs.dou.ua/companies/c/", 200, '<div class="site"> <a href="https://c.io" target="_blank" rel="nofollow">x</a></div>'), ("https://c.io", 200, '<a href="/careers">Careers</a>')], "url string, status int, body string")
    assert [(r.career_url, r.career_state) for r in discovery.inspect(companies, attempts).collect()] == [(None, "unreadable")]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    links = spark.range(2).select(F.col("id").cast("string").alias("a"), F.concat("id", F.lit("b")).alias("b"))
    once = plan(links.select(C.resolve_url(F.col("a"), F.col("b")).alias("url"))).count("https?://")
    assert once > 0 and plan(seen[0]).count("https?://") == once
    assert plan(seen[1]).count("greenhouse") == 1


def test_hosts_below_a_name(spark):
    df = spark.createDataFrame([("t.me", True), ("a.t.me", True), ("at.me", False), ("txme", False), ("t.me.io", False), ("t.me\n", False), ("", False), (None, None)], "host string, want boolean")
    assert [r.got for r in df.select(C.on_host(F.col("host"), ("x.io", "t.me")).alias("got")).collect()] == [r.want for r in df.collect()]
