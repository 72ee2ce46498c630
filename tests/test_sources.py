"""Parsers of captured bodies on small documents."""

import json

from pyspark.sql import functions as F

from jobloom.plans import storage
from jobloom.sources import feeds, html, messages, registry
from jobloom.streaming import delivery


def bronze(spark, *bodies, url="https://x.io/jobs"):
    return spark.createDataFrame([(f"s{i}", url, b) for i, b in enumerate(bodies)], "source_id string, url string, body string")


ITEMS = {
    "greenhouse": {"jobs": [{"id": 1, "title": "iOS", "absolute_url": "https://x/1", "location": {"name": "Kyiv"}, "content": "&lt;b&gt;"}, {"id": 2, "title": " ", "absolute_url": "https://x/2"}]},
    "lever": [{"id": "1", "text": "iOS", "hostedUrl": "https://x/1", "workplaceType": "remote", "categories": {"location": "Kyiv"}, "descriptionPlain": "a", "additionalPlain": "b"}],
    "ashby": {"jobs": [{"id": "1", "title": "iOS", "jobUrl": "https://x/1", "location": "Kyiv", "secondaryLocations": [{"location": "Lviv"}, {"location": "Kyiv"}], "isRemote": True}, {"id": "2", "title": "x", "jobUrl": "https://x/2", "isListed": False}]},
    "breezy": [{"id": "1", "name": "iOS", "url": "https://x/1", "locations": [{"name": "Kyiv", "is_remote": False}, {"name": "Lviv", "is_remote": True}]}],
    "recruitee": {"offers": [{"id": 1, "title": "iOS", "careers_url": "https://x/1", "location": "Kyiv", "description": "a", "requirements": "b", "remote": True}, {"id": 2, "title": "x", "careers_url": "https://x/2", "status": "closed"}]},
    "workable": {"jobs": [{"title": "iOS", "url": "https://x/1", "shortcode": "A", "locations": [{"city": "Kyiv", "country": "Ukraine"}], "telecommuting": True}, {"title": "x", "url": "http://x/2"}]},
}
WANT = {"greenhouse": ("Kyiv", None, "<b>"), "lever": ("Kyiv", "remote", "a\nb"), "ashby": ("Kyiv / Lviv", "remote", None), "breezy": ("Kyiv / Lviv", "remote", None), "recruitee": ("Kyiv", "remote", "a\nb"), "workable": ("Kyiv, Ukraine", "remote", None)}


def test_ats(spark):
    for ats, body in ITEMS.items():
        b = bronze(spark, json.dumps(body), "not json")
        got = feeds.parse_ats(b, ats).collect()
        assert [(r.title, r.url) for r in got] == [("iOS", "https://x/1")]
        assert (got[0].location, got[0].remote, got[0].description) == WANT[ats]
        assert {r.source_id: r.payload_ok for r in feeds.scanned_counts(b, ats).collect()}["s0"]


def test_rss_single_item_and_gate(spark):
    body = "<rss><channel><item><title>iOS Developer в Acme (a, b), Київ, від $2000, віддалено</title><link>https://j.io/v/12/?utm_x=1</link><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate><description>d</description></item></channel></rss>"
    r = feeds.parse_rss(bronze(spark, body)).first()
    assert (r.title, r.company, r.location, r.remote, r.url, r.source_job_id) == ("iOS Developer", "Acme (a, b)", "Київ", "remote", "https://j.io/v/12/", "12")
    other = body.replace("iOS Developer", "Accountant")
    assert feeds.parse_rss(bronze(spark, other)).count() == 0
    assert feeds.parse_rss(bronze(spark, body), named_company=False).first().company == ""


def test_paged_search(spark):
    page = lambda n, *d: json.dumps({"current_page": n, "last_page": 2, "data": list(d)})
    job = {"id": 1, "title": "iOS", "slug": "a", "company_title": "Unknown", "source_secondary": "Board", "work_format": ["hybrid", "remote"], "office_locations": ["kyiv ", "Kyiv"], "tldr": "t", "tags": [{"name": "swift"}]}
    got = feeds.parse_paged_search(bronze(spark, page(1, job, {**job, "is_scam": True}), page(3, job)), "https://b/").collect()
    assert [(r.company, r.url, r.location, r.remote, r.description) for r in got] == [("Board", "https://b/a", "Kyiv", "remote", "t\nswift")]


def test_career_page_merges_json_ld(spark):
    ld = {"@graph": [{"@type": "JobPosting", "title": "Senior iOS Engineer", "url": "/jobs/1", "description": "d", "jobLocationType": "TELECOMMUTE", "applicantLocationRequirements": {"name": "EU"}}]}
    page = f'<script type="application/ld+json">{json.dumps(ld)}</script><a href="/jobs/1">Apply iOS</a><a href="/jobs/1">again</a><a href="/jobs/2">Swift <b>Developer</b></a><a href="/about">About</a><script>var a = "<a href=x>no</a>"</script>'
    got = {(r.url, r.title, r.location) for r in html.career_page_jobs(bronze(spark, page, "")).collect()}
    assert got == {("https://x.io/jobs/1", "Senior iOS Engineer", "EU / Remote"), ("https://x.io/jobs/2", "Swift Developer", None)}


def test_sitemap_details(spark):
    state = {"props": {"pageProps": {"job": {"name": "iOS Engineer", "uid": "7", "description": "d", "metadata": {"country": [{"title": "Ukraine"}], "city": [{"title": "Kyiv"}], "vacancy_type": [{"title": "Remote"}]}}}}}
    details = spark.createDataFrame([("https://x/ios-1", f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(state)}</script>')], "url string, body string")
    maps = bronze(spark, "<urlset><url><loc> https://x/ios-1 </loc></url><url><loc>https://x/ios-2</loc></url><url><loc>https://x/other</loc></url></urlset>")
    r = registry.sitemap_details(maps, details, "ios", "E").first()
    assert (r.title, r.location, r.remote, r.job_id) == ("iOS Engineer", "Kyiv, Ukraine", "remote", "7")
    s = registry.sitemap_status(maps, details, "ios").first()
    assert (s.listed, s.scanned, s.status) == (2, 1, "degraded")


def test_json_sources(spark):
    jobs = [{"id": "1", "title": "iOS dev", "url": "https://x/1", "location": "Kyiv"}]
    bodies = {
        "flat_list": json.dumps([{**jobs[0], "technologies": ["Swift"]}, {**jobs[0]}]), "nested_data": json.dumps({"data": {"jobs": [{"id": "1", "name": "iOS dev", "link": "https://x/1", "city": "Kyiv"}]}}),
        "requisitions": json.dumps({"items": [{"requisitionList": [{"Id": "1", "Title": "iOS dev", "PrimaryLocation": "Kyiv"}]}]}), "next_data": '<script id="__NEXT_DATA__">' + json.dumps({"props": {"pageProps": {"vacancies": jobs}}}) + "</script>",
        "attribute": '<div data-vacancies="' + json.dumps([{"id": "1", "title": "iOS dev", "link": "https://x/1", "city": "Kyiv"}]).replace('"', "&quot;") + '">', "wordpress": json.dumps([{"id": 1, "link": "https://x/1", "title": {"rendered": "<b>iOS</b> dev"}, "content": {"rendered": "c"}}]),
        "paged": json.dumps({"pages": [{"items": [{"id": "1", "title": "iOS dev", "url": "https://x/1", "cities": [{"title": "Any city"}, {"title": "Kyiv"}]}]}]}),
        "named_lists": json.dumps({"results": [{"id": 1, "title": "", "name": "iOS dev", "slug": "/r/1", "location": "Kyiv"}, {"name": "iOS", "slug": ""}]}), "slug_list": json.dumps([{"id": 1, "title": " iOS dev ", "url": "/r-1", "remote": False}, {"title": "iOS", "url": "/"}]),
        "offset_list": json.dumps({"list": [{"id": "1", "title": " iOS dev ", "url": "/j/1", "offices": [" Kyiv ", " "]}], "page": {"itemTotal": 1}}), "session_pages": json.dumps({"vacancies": [{"id": "1", "name": "iOS dev", "urlSegment": "/ios-1", "city": "Kyiv"}, {"name": "iOS", "urlSegment": "/"}], "meta": {"last_page": 1}}),
        "two_queries": json.dumps({"vacancies": {"items": [{"title": "iOS dev", "slug": "r-1"}, {"title": "iOS again", "slug": "r-1"}, {"title": "iOS"}]}}), "located": "<p data-vacancies='" + json.dumps([{"id": "1", "title": "iOS dev", "countryLocations": [{"city": "Kyiv", "country": ""}], "relatedLocations": [" ", None]}, {"title": "iOS"}]).replace('"', "&quot;") + "'>",
    }
    assert set(bodies) == set(registry.JSON_SOURCES)
    for kind, body in bodies.items():
        got = registry.parse_json(bronze(spark, body), registry.JSON_SOURCES[kind], "Co").collect()
        assert [(r.company, r.title) for r in got] == [("Co", "iOS dev")], kind
        assert got[0].location in ("Kyiv", None)


def test_cards_and_crawl(spark):
    page = '<a href="/companies/x">X</a><a href="/companies/x/jobs/1">iOS</a><a href="https://emp/1">go</a><a href="/companies/x/jobs/1">iOS again</a><a href="/companies/y">Y</a><a href="/companies/y/jobs/2">Swift</a>'
    got = {(r.title, r.company, r.url) for r in registry.listing_cards(bronze(spark, page), "https://site").collect()}
    assert got == {("iOS", "X", "https://emp/1"), ("Swift", "Y", "https://site/companies/y/jobs/2")}
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("z", "y")], "url string, next string")
    assert {r.url for r in registry.follow_pages(spark.createDataFrame([("a",)], "url string"), links).collect()} == {"a", "b", "c"}


def test_named_lists_may_be_the_body_itself(spark):
    got = registry.parse_json(bronze(spark, json.dumps([{"id": 0, "title": "iOS dev", "url": "https://o/1"}]), "oops"), registry.JSON_SOURCES["named_lists"], "Co").collect()
    assert [(r.title, r.url, r.job_id) for r in got] == [("iOS dev", "https://o/1", None)]


def test_first_of_each_key_however_rows_are_dealt(spark):
    pages = [(f"s{i % 3}", f"https://x/{p}", p, json.dumps([{"id": str(j), "title": f"iOS dev {p}", "url": f"https://x/{j}"} for j in range(5)])) for i in range(9) for p in [i // 3]]
    df = spark.createDataFrame(pages, "source_id string, url string, page int, body string")
    runs = [sorted((r.source_id, r.url, r.title) for r in registry.parse_json(df.repartition(n), registry.JSON_SOURCES["flat_list"], "Co").collect()) for n in (1, 7)]
    assert runs[0] == runs[1] == sorted((f"s{i}", f"https://x/{j}", "iOS dev 0") for i in range(3) for j in range(5))


def test_follow_pages_goes_to_the_end_or_says_so(spark):
    import pytest

    links = spark.createDataFrame([(str(i), str(i + 1)) for i in range(5)], "url string, next string")
    seed = spark.createDataFrame([("0",)], "url string")
    assert registry.follow_pages(seed, links).count() == 6
    with pytest.raises(RuntimeError):
        registry.follow_pages(seed, links, max_rounds=3)


def test_links_know_what_stands_around_them(spark):
    page = '<ul><li><a href="/jobs/1">iOS <b>dev</b></a> in <i>Kyiv</i></li><li><a href="/jobs/2">Swift</a><a href="/jobs/3">Obj-C<span class="x country">UA</span></a></li></ul><a href="/about">us<a href="/jobs/4">open'
    rows = bronze(spark, page).select(F.explode(html.page_parts(F.col("body"))["anchors"]).alias("x")).select("x.*").orderBy("pos").collect()
    assert [(r.href, r.text, r.around, r.place) for r in rows] == [("/jobs/1", "iOS dev", "iOS dev in Kyiv", None), ("/jobs/2", "Swift", None, None), ("/jobs/3", "Obj-CUA", None, "UA"), ("/about", "us", None, None), ("/jobs/4", "open", None, None)]


def test_ranked_csv(spark):
    body = "period,rank,name\n01-2024,1,Old\n02-2024,2,B\n02-2024,1,A"
    assert [r.name for r in feeds.ranked_csv(bronze(spark, body), "period string, rank int, name string", "period", "rank").collect()] == ["A", "B"]


def message(spark, *texts):
    return spark.createDataFrame([("ch", i, t, None, None, []) for i, t in enumerate(texts)], "channel string, message_id long, text string, published_at timestamp, urls array<string>, entities array<struct<offset: int, length: int, url: string>>")


def test_messages(spark):
    texts = ["#vacancy\nHello all!\nSenior iOS Developer\nCompany: Acme Apps\nhttps://t.me/x https://acme.io/apply.", "Looking for opportunities, iOS developer #resume", "Acme Labs is hiring an iOS engineer", "We are looking for an iOS developer", "#vacancy\nAndroid dev", "", None]
    got = {r.source_job_id: r for r in messages.postings_from_messages(message(spark, *texts)).collect()}
    assert sorted(got) == ["ch:0", "ch:2", "ch:3"]
    assert (got["ch:0"].title, got["ch:0"].company, got["ch:0"].url) == ("Senior iOS Developer", "Acme Apps", "https://acme.io/apply")
    assert got["ch:2"].company == "Acme Labs" and got["ch:2"].url == "https://t.me/ch/2" and got["ch:3"].company == ""


def test_digest_offsets_are_utf16(spark):
    text = "🚀 iOS Developer @ Acme\nLocation: Kyiv\nSwift Engineer at Beta\n"
    e = [(3, 13, " https://a/1 "), (len("🚀 iOS Developer @ Acme\nLocation: Kyiv\n") + 1, len("Swift Engineer at Beta"), "https://a/2")]
    df = spark.createDataFrame([("ch", 1, text, None, e)], "channel string, message_id long, text string, published_at timestamp, entities array<struct<offset: int, length: int, url: string>>")
    got = [(r.title, r.company, r.url, r.location) for r in messages.postings_from_digests(df).orderBy("source_job_id").collect()]
    assert got == [("iOS Developer", "Acme", "https://a/1", "Kyiv"), ("Swift Engineer", "Beta", "https://a/2", None)]


def test_stream_delivers_once(spark, tmp_path):
    src, feed, check = (str(tmp_path / x) for x in ("src", "feed", "check"))
    put = lambda *rows: spark.createDataFrame(rows, "key string, n long").coalesce(1).write.mode("append").parquet(src)
    go = lambda: delivery.deliver(spark.readStream.schema("key string, n long").parquet(src), "key", "n", feed, check).awaitTermination()
    put(("a", 2), ("a", 1), ("b", 3))
    go()
    put(("b", 9), ("c", 4))
    go()
    go()
    assert {(r.key, r.n) for r in storage.read_table(spark, feed, "key string, n long").collect()} == {("a", 1), ("b", 3), ("c", 4)}


def test_status(spark):
    df = spark.createDataFrame([(0, ["x"]), (3, ["x"]), (0, []), (0, None)], "n int, e array<string>")
    assert [r.s for r in df.select(feeds.source_status(F.col("n"), F.col("e")).alias("s")).collect()] == ["failed", "degraded", "healthy", "healthy"]


def test_no_part_of_a_long_title_or_csv_is_lost(spark):
    tail = ", ".join(f"place{i:c}{i:c}" for i in range(0x4E00, 0x4E00 + 120))
    title = spark.createDataFrame([(f"Dev в Acme, {tail}, remote",)], "t string")
    r = title.select(*[v.alias(k) for k, v in feeds.split_item_title(F.col("t")).items()]).first()
    assert r.remote == "remote" and r.location == tail
    body = F.concat(F.lit("period,rank\n"), F.repeat(F.lit("01-2024,2\n"), 1_000_003), F.lit("02-2024,1"))
    got = feeds.ranked_csv(spark.range(1).select(body.alias("body")), "period string, rank int", "period", "rank").collect()
    assert [(r.period, r.rank) for r in got] == [("02-2024", 1)]


def test_words_around_links_are_read_once_an_element():
    """A listing's links lie in one element, whose links and words were read again for each of them."""
    class Counted(list):
        reads = 0

        def __iter__(self):
            Counted.reads += 1
            return super().__iter__()

    page = html._page("<main>" + "".join(f'<a href="/x/{i}">t {i}</a>' for i in range(50)) + "</main>")
    parent = page.links[0][1]
    parent.links = Counted(parent.links)
    assert {a[2] for a in page.anchors()} == {" ".join(f"t {i}" for i in range(50))}
    assert Counted.reads == 1


def test_deep_pages_keep_their_words_once():
    """Every open element kept each word below it, so that a page's cost grew with the square of its depth."""
    import tracemalloc

    body = "".join(f"<b>{i} " for i in range(3000)) + '<a href="/jobs/1">iOS'
    tracemalloc.start()
    page = html._page(body)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(page.anchors()) == [("/jobs/1", "iOS", "2999 iOS", None)]
    assert peak < 8_000_000


def test_json_ld_fields_of_any_type(spark):
    """A title that is no text failed the whole run."""
    page = '<script type="application/ld+json">[{"@type":"JobPosting","title":5,"url":"/a\\ud800","description":["x"]},{"@type":"JobPosting","title":[],"url":null}]</script>'
    want = [("5", "/a?", "['x']", None), (None, None, None, None)]
    for postings in (html.page_postings(F.col("body")), html.page_parts(F.col("body"))["postings"]):
        assert [tuple(p) for p in bronze(spark, page).select(postings).first()[0]] == want
