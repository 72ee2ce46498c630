"""Queries over captured bodies: each parser reads documents written from the shared tables, and its SQL says from the
tables themselves what must come back. Bodies hold at most about a hundred rows, so their number grows with the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators import health, incremental, reports, state_merge
from jobloom.plans import oracle, storage
from jobloom.plans.fixtures import RAW_SQL, raw_postings, table
from jobloom.sources import cards, feeds, html, messages, registry

c = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}
DASH = " | "


def checked(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _part(spark, d) -> DataFrame:
    """Parts with a title on topic for two of three, and the source whose body they stand in."""
    p, k = table(spark, d, "part"), c("p_partkey")
    return p.select(k.alias("k"), k.cast("string").alias("id"), F.concat(F.when(k % 3 == 0, "Clerk ").otherwise("iOS Engineer "), k.cast("string")).alias("title"), c("p_brand").alias("brand"), c("p_type").alias("kind"), c("p_size").alias("size"), F.floor(k / 100).alias("source_id"))


PART = "p AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN 'Clerk ' ELSE 'iOS Engineer ' END || p_partkey AS title, p_brand AS brand, p_type AS kind, p_size AS size, p_partkey // 100 AS source_id FROM part)"


def _bodies(rows: DataFrame, piece: Column, before: str, after: str, by: str = ",", key: str = "source_id", url: str = "https://x.io/careers/") -> DataFrame:
    """One captured body a source: the pieces of its rows, in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", piece.alias("piece")))), lambda x: x["piece"]), by)
    # Dealt, since the bodies are few bytes that are worth much work: a shuffle cut by bytes would gather them in a few tasks.
    return storage.deal(rows, key).groupBy(c(key).alias("source_id")).agg(F.concat(F.lit(before), joined, F.lit(after)).alias("body")).withColumn("url", F.lit(url))


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _link(kind: str = "https://x/") -> Column:
    return F.concat(F.lit(kind), "id")


# --- applicant-tracking systems



def _far() -> Column:
    return F.when(c("size") > 25, True).otherwise(False)


@checked(f"""WITH {PART}
SELECT 'ashby' AS ats, title, 'https://x/' || id AS url, brand || ' / ' || kind AS location, kind AS description, id AS job_id, CASE WHEN size > 25 THEN 'remote' END AS remote FROM p WHERE size % 7 <> 0
UNION ALL SELECT 'breezy', title, 'https://x/' || id, brand, kind, id, CASE WHEN size > 25 THEN 'remote' END FROM p
UNION ALL SELECT 'recruitee', title, 'https://x/' || id, brand, kind || chr(10) || brand, id, CASE WHEN size > 25 THEN 'remote' END FROM p WHERE size % 7 <> 0
UNION ALL SELECT 'workable', title, 'https://x/' || id, brand || ', UA', NULL, id, CASE WHEN size > 25 THEN 'remote' END FROM p WHERE size % 10 <> 0""")
def q_ats_boards(spark, d):
    """Boards of the other four systems; unlisted, closed and plain-http postings are out."""
    p = _part(spark, d)
    bodies = {
        "ashby": _bodies(p, _json(id=c("id"), title=c("title"), jobUrl=_link(), location=c("brand"), secondaryLocations=F.array(F.struct(c("kind").alias("location")), F.struct(c("brand").alias("location"))), isRemote=_far(), isListed=c("size") % 7 != 0, descriptionPlain=c("kind")), '{"jobs":[', "]}"),
        "breezy": _bodies(p, _json(id=c("id"), name=c("title"), url=_link(), locations=F.array(F.struct(c("brand").alias("name"), _far().alias("is_remote"))), description=c("kind")), "[", "]"),
        "recruitee": _bodies(p, _json(id=c("id"), title=c("title"), careers_url=_link(), location=c("brand"), status=F.when(c("size") % 7 == 0, "closed"), remote=_far(), description=c("kind"), requirements=c("brand")), '{"offers":[', "]}"),
        "workable": _bodies(p, _json(title=c("title"), url=F.when(c("size") % 10 == 0, _link("http://x/")), shortlink=_link(), shortcode=c("id"), locations=F.array(F.struct(c("brand").alias("city"), F.lit("UA").alias("country"))), telecommuting=_far()), '{"jobs":[', "]}"),
    }
    parts = [feeds.parse_ats(b, ats).select(F.lit(ats).alias("ats"), "title", "url", "location", "description", "job_id", "remote") for ats, b in bodies.items()]
    return feeds.union_results(*parts)


@checked(f"WITH {PART} SELECT source_id, CASE WHEN source_id % 4 = 3 THEN 0 ELSE count(*) END AS scanned, source_id % 4 <> 3 AS payload_ok FROM p GROUP BY source_id")
def q_scanned_counts(spark, d):
    b = _bodies(_part(spark, d), _json(id=c("id"), title=c("title")), '{"jobs":[', "]}")
    return feeds.scanned_counts(b.withColumn("body", F.when(c("source_id") % 4 == 3, "<html>").otherwise(c("body"))), "greenhouse").withColumn("scanned", c("scanned").cast("long"))


@checked(f"""WITH {PART} SELECT k // 500 AS source_id, CASE WHEN k % 4 = 0 THEN 'Board' ELSE brand END AS company, title, 'https://b/s' || id AS url, upper(kind[1]) || lower(kind[2:]) AS location, CASE WHEN size > 25 THEN 'remote' ELSE 'hybrid' END AS remote, kind || chr(10) || 'swift, ' || brand AS description, id AS job_id
FROM p WHERE k % 11 <> 0 AND k % 13 <> 0""")
def q_paged_search(spark, d):
    """Pages of fifty; the pages of a source are rows of it."""
    p = _part(spark, d).withColumns({"page": F.floor(c("k") % 500 / 50) + 1, "src": F.floor(c("k") / 500)})
    item = _json(id=c("id"), title=c("title"), slug=F.concat(F.lit("s"), "id"), company_title=F.when(c("k") % 4 == 0, "Confidential").otherwise(c("brand")), work_format=F.array(F.lit("hybrid"), F.when(c("size") > 25, "remote").otherwise("x")), office_locations=F.array(F.lower("kind")), tldr=c("kind"), tags=F.array(F.struct(F.lit("swift").alias("name")), F.struct(c("brand").alias("name"))), is_archived=c("k") % 11 == 0, is_scam=c("k") % 13 == 0, source_secondary=F.lit("Board"))
    joined = F.array_join(F.array_sort(F.collect_list(item)), ",")
    pages = p.groupBy(c("src").alias("source_id"), "page").agg(joined.alias("items")).select("source_id", F.concat(F.lit('{"current_page":'), "page", F.lit(',"last_page":10,"data":['), "items", F.lit("]}")).alias("body"))
    return feeds.parse_paged_search(pages, "https://b/")


# --- JSON of other shapes

#: What each shape gives back: url, location, description and job id.
_KINDS = {
    "flat_list": ("'https://x/' || id", "brand", "kind || ', ' || brand", "id"),
    "nested_data": ("'https://x/' || id", "brand", "NULL", "id"),
    "requisitions": ("'https://explore-jobs.ciklum.com/en/sites/ciklum-career/job/' || id", "NULL", "NULL", "id"),
    "next_data": ("'https://x/' || id", "brand", "NULL", "id"),
    "wordpress": ("'https://x/' || id", "NULL", "kind", "id"),
    "paged": ("'https://x/' || id", "brand", "NULL", "id"),
    "named_lists": ("'https://themindstudios.com/careers/r-' || id", "brand", "NULL", "id"),
    "slug_list": ("'https://zone3000.com/careers/r-' || id", "CASE WHEN size > 25 THEN 'Remote' END", "NULL", "id"),
    "two_queries": ("'https://www.dataart.team/vacancies/r-' || id", "NULL", "NULL", "NULL"),
}


def _kinds() -> dict[str, tuple]:
    """How an item of each shape is written, and what stands around the items."""
    return {
        "flat_list": (dict(id=c("id"), title=c("title"), url=_link(), location=c("brand"), technologies=F.array("kind", "brand")), "[", "]"),
        "nested_data": (dict(id=c("id"), name=c("title"), link=_link(), city=c("brand")), '{"data":{"jobs":[', "]}}"),
        "requisitions": (dict(Id=c("id"), Title=c("title"), PrimaryLocation=c("brand")), '{"items":[{"requisitionList":[', "]}]}"),
        "next_data": (dict(id=c("id"), title=c("title"), url=_link(), location=c("brand")), '<p><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"vacancies":[', "]}}}</script>"),
        "wordpress": (dict(id=c("id"), link=_link(), title=F.struct(F.concat(F.lit("<b>"), "title", F.lit("</b>")).alias("rendered")), content=F.struct(c("kind").alias("rendered"))), "[", "]"),
        "paged": (dict(id=c("id"), title=c("title"), url=_link(), cities=F.array(F.struct(F.lit("Any city").alias("title")), F.struct(c("brand").alias("title")))), '{"pages":[{"items":[', "]}]}"),
        "named_lists": (dict(id=c("id"), name=c("title"), slug=F.concat(F.lit("r-"), "id"), location=c("brand")), '{"results":[', "]}"),
        "slug_list": (dict(id=c("id"), title=c("title"), url=F.concat(F.lit("/r-"), "id"), remote=_far()), "[", "]"),
        "two_queries": (dict(title=c("title"), slug=F.concat(F.lit("r-"), "id")), '{"vacancies":{"items":[', "]}}"),
    }


@checked(f"WITH {PART} " + " UNION ALL ".join(f"SELECT '{k}' AS kind, source_id, 'Co' AS company, title, {v[0]} AS url, {v[1]} AS location, {v[2]} AS description, {v[3]} AS job_id FROM p WHERE k % 3 <> 0" for k, v in _KINDS.items()))
def q_json_sources(spark, d):
    """Each shape's bodies, every posting twice (the first counts), off-topic ones among them."""
    p, out = _part(spark, d), []
    for kind, (fields, before, after) in _kinds().items():
        b = _bodies(p, F.concat(_json(**fields), F.lit(","), _json(**fields)), before, after)
        out.append(registry.parse_json(b, registry.JSON_SOURCES[kind], "Co").select(F.lit(kind).alias("kind"), "source_id", "company", "title", "url", "location", "description", "job_id"))
    return feeds.union_results(*out)


@checked(f"""WITH {PART}
SELECT 'attribute' AS kind, source_id, title, 'https://x/' || id AS url, brand AS location FROM p WHERE k % 3 <> 0
UNION ALL SELECT 'located', source_id, title, 'https://www.griddynamics.com/careers/vacancy/' || id, brand || ', UA / ' || kind FROM p WHERE k % 3 <> 0""")
def q_attribute_json(spark, d):
    """JSON that stands, escaped, in an attribute of a page."""
    p = _part(spark, d)
    escaped = lambda **f: F.replace(_json(**f), F.lit('"'), F.lit("&quot;"))
    a = _bodies(p, escaped(id=c("id"), title=c("title"), link=_link(), city=c("brand")), '<div data-vacancies="[', ']"></div>')
    b = _bodies(p, escaped(id=c("id"), title=c("title"), countryLocations=F.array(F.struct(c("brand").alias("city"), F.lit("UA").alias("country"))), relatedLocations=F.array(F.concat(F.lit(" "), "kind"), F.lit(" "))), "<div data-vacancies='[", "]'></div>")
    rows = [registry.parse_json(x, registry.JSON_SOURCES[k], "Co").select(F.lit(k).alias("kind"), "source_id", "title", "url", "location") for k, x in (("attribute", a), ("located", b))]
    return feeds.union_results(*rows)


@checked(f"""WITH {PART} SELECT source_id, title, 'https://www.dataart.team/vacancies/r-' || id AS url, CASE WHEN source_id % 3 = 1 THEN 'degraded' ELSE 'healthy' END AS status
FROM p WHERE k % 3 <> 0 AND (source_id % 3 <> 1 OR k % 2 = 0)""")
def q_two_queries(spark, d):
    """A narrow query's page and the page of all, told by slug; where the second was refused the source is degraded."""
    p = _part(spark, d)
    item = _json(title=c("title"), slug=F.concat(F.lit("r-"), "id"))
    first = _bodies(p.where("k % 2 = 0"), item, '{"items":[', "]}").withColumn("page", F.lit(0))
    second = _bodies(p, item, '{"vacancies":{"items":[', "]}}").where("source_id % 3 <> 1").withColumn("page", F.lit(1))
    both = first.unionByName(second)
    missing = F.when(F.count("*") < 2, F.array(F.lit("all"))).otherwise(F.array().cast("array<string>"))
    status = both.groupBy("source_id").agg(feeds.source_status(F.lit(1), missing).alias("status"))
    return registry.parse_json(both, registry.JSON_SOURCES["two_queries"], "Co").select("source_id", "title", "url").join(status, "source_id")


# --- sitemaps and details


def _site(spark, d) -> tuple[DataFrame, DataFrame]:
    p = _part(spark, d)
    loc = F.concat(F.lit("<url><loc>"), _link("https://x/ios-"), F.lit(" </loc></url><url><loc>"), _link("https://x/other/"), F.lit("</loc></url>"))
    state = F.to_json(F.struct(F.struct(F.struct(F.struct(c("title").alias("name"), c("id").alias("uid"), c("kind").alias("description"), (c("k") % 7 == 0).alias("is_expired"), F.struct(F.array(F.struct(F.lit("UA").alias("title"))).alias("country"), F.array(F.struct(c("brand").alias("title"))).alias("city"), F.array(F.struct(F.when(c("size") > 25, "Remote").otherwise("Office").alias("title"))).alias("vacancy_type")).alias("metadata")).alias("job")).alias("pageProps")).alias("props")))
    details = p.where("k % 5 <> 0").select(_link("https://x/ios-").alias("url"), F.concat(F.lit('<script id="__NEXT_DATA__">'), state, F.lit("</script>")).alias("body"))
    return _bodies(p, loc, "<urlset>", "</urlset>", ""), details


@checked(f"WITH {PART} SELECT source_id, 'Co' AS company, title, 'https://x/ios-' || id AS url, brand || ', UA' AS location, CASE WHEN size > 25 THEN 'remote' ELSE 'onsite' END AS remote, kind AS description, id AS job_id FROM p WHERE k % 5 <> 0 AND k % 7 <> 0")
def q_sitemap_details(spark, d):
    return registry.sitemap_details(*_site(spark, d), "^ios-", "Co")


@checked(f"WITH {PART}, n AS (SELECT source_id, count(DISTINCT 'https://x/ios-' || id) AS listed, count(*) FILTER (WHERE k % 5 <> 0) AS scanned FROM p GROUP BY 1) SELECT *, CASE WHEN scanned = 0 THEN 'failed' WHEN scanned < listed THEN 'degraded' ELSE 'healthy' END AS status FROM n")
def q_sitemap_status(spark, d):
    return registry.sitemap_status(*_site(spark, d), "^ios-")


# --- pages



def _ld() -> Column:
    return F.when(c("size") > 25, F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"Senior '), "title", F.lit('","url":"/jobs/'), "id", F.lit('","description":"'), "kind", F.lit('","jobLocation":{"address":{"addressLocality":"'), "brand", F.lit('","addressCountry":"UA"}}}]}</script>'))).otherwise("")


def _career_pages(spark, d) -> DataFrame:
    """A page a part: a posting's link with words and a country next to it, its JSON-LD on some, and links that are none."""
    text = F.concat(F.lit('<h1>Jobs</h1><div><a href="/jobs/'), "id", F.lit('">'), "title", F.lit(' <i class="country">'), "kind", F.lit("</i></a> apply now<br>today</div>"), _ld(), F.lit('<p><a href="/about">About</a></p>'))
    return _part(spark, d).select(c("k").alias("source_id"), F.lit("https://x.io/careers/").alias("url"), text.alias("body"))


@checked(f"""WITH {PART} SELECT k AS source_id, 'https://x.io/jobs/' || id AS url, CASE WHEN size > 25 THEN 'Senior ' || title ELSE title || ' ' || kind END AS title,
  CASE WHEN size > 25 THEN kind ELSE title || ' ' || kind || ' apply now today' END AS description, CASE WHEN size > 25 THEN brand || ', UA' ELSE kind END AS location FROM p WHERE k % 3 <> 0""")
def q_career_pages(spark, d):
    return html.career_page_jobs(_career_pages(spark, d)).withColumn("description", C.squeeze(c("description")))


@checked(f"""WITH {PART} SELECT k AS source_id, 'https://x.io/jobs/' || id AS url, 'Senior ' || title AS title, kind AS description, brand || ', UA' AS location FROM p WHERE size > 25 AND k % 2 = 0""")
def q_detail_matches(spark, d):
    """Listing rows whose detail page holds a posting of the same title."""
    p = _part(spark, d)
    url = F.concat(F.lit("https://x.io/jobs/"), "id")
    listing = p.select(c("k").alias("source_id"), url.alias("url"), F.concat(F.when(c("k") % 2 == 0, "  SENIOR ").otherwise("Junior "), "title").alias("title"))
    return registry.detail_matches(listing, p.select(url.alias("url"), _ld().alias("body"))).withColumn("title", F.concat(F.lit("Senior "), F.regexp_replace("title", "^  SENIOR ", "")))


@checked(f"""WITH {PART} SELECT source_id, title, 'Org ' || brand AS company, CASE WHEN k % 4 = 0 THEN 'https://emp/' || id ELSE 'https://site/companies/c/jobs/' || id END AS url FROM p""")
def q_listing_cards(spark, d):
    a = lambda href, text: F.concat(F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>"))
    job = a(F.concat(F.lit("/companies/c/jobs/"), "id"), c("title"))
    card = F.concat(a(F.lit("/companies/c"), F.concat(F.lit("Org "), "brand")), job, F.when(c("k") % 4 == 0, a(_link("https://emp/"), F.lit("go"))).otherwise(""), job)
    return registry.listing_cards(_bodies(_part(spark, d), card, "<main>", "</main>", ""), "https://site")


def _cards(spark, d, card: Column, before: str = "<main>", after: str = "</main>") -> DataFrame:
    return _bodies(_part(spark, d), card, before, after, "")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(x) if isinstance(x, str) and not x.startswith("$") else c(x[1:]) for x in parts])


@checked(f"""WITH {PART}
SELECT 'paged_fragments' AS kind, title, 'http://mobilunity.com/vacancy/' || id || '/' AS url, brand AS location, CAST(NULL AS VARCHAR) AS remote FROM p WHERE k % 3 <> 0
UNION ALL SELECT 'json_fragments', CASE WHEN k % 3 = 0 THEN title ELSE 'iOS ' || kind END, 'https://career.sigma.software/v/' || id, NULL, NULL FROM p WHERE source_id % 4 <> 3
UNION ALL SELECT 'job_boxes', title, 'https://www.globallogic.com/ua/careers/x-irc' || id, brand || ', UA', 'Remote' FROM p WHERE k % 3 <> 0
UNION ALL SELECT 'bookmarked', title, 'https://career.luxoft.com/jobs/x-' || id, CASE WHEN size > 25 THEN brand || ', Ukraine' ELSE kind END, NULL FROM p WHERE k % 3 <> 0
UNION ALL SELECT 'positions', title, 'https://jobs.mwdn.com/careers/x/p' || id || '/all', NULL, NULL FROM p WHERE k % 3 <> 0""")
def q_cards(spark, d):
    """Cards of five listings, each card twice."""
    bodies = {
        "paged_fragments": _cards(spark, d, _text('<div class="one-vacancy big"><h5 class="svacancy-name"><a href="/vacancy/', "$id", '/">', "$title", '</a></h5><div class="svacancy-excerpt">', "$kind", '</div><p class="vacancy-country"><img src=x alt="', "$brand", '"></p></div>')),
        "json_fragments": _bodies(_part(spark, d).withColumn("title", F.when(c("k") % 3 == 0, c("title"))), F.replace(F.concat(F.lit('<a class="vacancy-card-new" href="/v/'), "id", F.lit('"><h3 class="vacancy-card-new__title">'), F.coalesce("title", F.lit("")), F.lit('</h3><div class="vacancy-card-new__technologies"><span>iOS</span><span>'), "kind", F.lit("</span></div></a>")), F.lit('"'), F.lit('\\"')), '{"success":true,"data":{"has_more":false,"html":"', '"}}', "").withColumn("body", F.when(c("source_id") % 4 == 3, '{"success":false}').otherwise(c("body"))),
        "job_boxes": _cards(spark, d, _text('<a class="job_box" href="/ua/careers/x-irc', "$id", '"><h4>', "$title", ' IRC77</h4><span class="job_location">', "$brand", '</span><span class="job_location">UA</span><span class="job_tag">Remote</span></a><a class="job_box" href="/ua/careers/none">iOS none</a>')),
        "bookmarked": _cards(spark, d, F.concat(F.lit('<a class="job" href="/jobs/x-'), "id", F.lit('"><h2>'), "title", F.lit("</h2>"), F.when(c("size") > 25, F.concat(F.lit('<span data-job="{&quot;city&quot;:&quot;'), "brand", F.lit('&quot;,&quot;location&quot;:&quot;Ukraine&quot;}"></span>'))).otherwise(""), F.lit('<em class="job-location">'), "kind", F.lit("</em></a>"))),
        "positions": _cards(spark, d, _text('<a class="comeet-position" href="/careers/x/p', "$id", '/all"><div class="comeet-position-name">', "$title", "</div></a>")),
    }
    doubled = lambda kind, b: b if kind == "json_fragments" else b.withColumn("body", F.concat("body", "body"))
    return feeds.union_results(*[cards.parse_cards(doubled(k, b), cards.CARD_SOURCES[k], "Co").select(F.lit(k).alias("kind"), "title", "url", "location", "remote") for k, b in bodies.items()])


@checked(f"""WITH {PART}, s AS (SELECT source_id, count(*) FILTER (WHERE k % 100 // 20 + 1 <> 3 OR source_id % 2 = 0) AS scanned, max(k % 100 // 20 + 1) AS last, bool_or(k % 100 // 20 + 1 = 3) AS third FROM p GROUP BY 1)
SELECT source_id, scanned, CASE WHEN source_id % 2 = 1 AND third THEN '3' ELSE '' END AS missing, CASE WHEN source_id % 2 = 1 AND third THEN 'degraded' ELSE 'healthy' END AS status FROM s WHERE last = 5 AND source_id > 0""")
def q_page_status(spark, d):
    """Five pages of twenty cards, the third not captured for every other source."""
    p = _part(spark, d).withColumn("page", F.floor(c("k") % 100 / 20) + 1).where("source_id > 0")
    whole = p.groupBy("source_id").agg(F.max("page").alias("last")).where("last = 5").select("source_id")
    card = _text('<div class="one-vacancy"><h5><a href="/vacancy/', "$id", '/">', "$title", "</a></h5></div>")
    body = F.array_join(F.collect_list(card), "")
    pages = p.join(whole, "source_id", "left_semi").groupBy("source_id", "page").agg(body.alias("body")).where("page <> 3 OR source_id % 2 = 0")
    first = F.when(c("page") == 1, F.regexp_extract(F.lit('<div class="vacancies-wrap" data-max="5">'), r'data-max="(\d+)"', 1).cast("int"))
    out = cards.page_status(pages.withColumn("page", c("page").cast("int")).withColumn("url", F.lit("u")), first, cards.CARD_SOURCES["paged_fragments"])
    return out.withColumn("missing", F.array_join("missing", ","))


@checked(f"""WITH {PART} SELECT source_id, title, 'https://h/ua/careers/ios-engineer-' || id || '-irc1' AS url FROM p WHERE source_id % 2 = 0 AND k % 3 <> 0
UNION ALL SELECT source_id, 'ios engineer ' || id, 'https://h/ua/careers/ios-engineer-' || id || '-irc1' FROM p WHERE source_id % 2 = 1 AND k % 3 <> 0""")
def q_slug_fallback(spark, d):
    """Sources without any card posting give the links in their text, titled by slug."""
    p = _part(spark, d)
    url = F.concat(F.lit("https://h/ua/careers/"), F.when(c("k") % 3 == 0, "clerk-").otherwise("ios-engineer-"), "id", F.lit("-irc1"))
    found = p.where("source_id % 2 = 0 AND k % 3 <> 0").select("source_id", F.lit("Co").alias("company"), "title", url.alias("url"))
    out = cards.slug_fallback(_bodies(p, url, "", "", " "), found, r"https://h/ua/careers/[a-z0-9-]+-irc\d+", r"\s*irc\d+\s*$", "Co")
    return out.select("source_id", "title", "url")


@checked(f"""WITH {PART} SELECT id, CASE WHEN size > 40 THEN brand WHEN k % 2 = 0 THEN kind || ', ' || CASE WHEN size > 25 THEN 'Ukraine' ELSE 'XX' END END AS location FROM p""")
def q_detail_places(spark, d):
    p = _part(spark, d)
    listing = p.select("id", _link().alias("url"), F.when(c("size") > 40, c("brand")).alias("location"))
    ld = F.concat(F.lit('<script type="application/ld+json">[{"@type":"JobPosting","title":"t","jobLocation":{"address":{"addressLocality":"'), "kind", F.lit('","addressCountry":"'), F.when(c("size") > 25, "ua").otherwise("XX"), F.lit('"}}}]</script>'))
    return cards.locations_from_details(listing, p.where("k % 2 = 0").select(_link().alias("url"), ld.alias("body"))).drop("url")


@checked("""WITH a AS (SELECT s_suppkey AS k, n, CASE n WHEN 1 THEN 403 WHEN 2 THEN CASE WHEN s_suppkey % 3 = 0 THEN 429 WHEN s_suppkey % 3 = 1 THEN 500 ELSE 200 END ELSE 200 END AS status FROM supplier, (VALUES (1), (2), (3)) t(n))
SELECT k, arg_min(status, n) AS status, CASE WHEN arg_min(status, n) = 200 THEN 'body ' || min(n) END AS body FROM a WHERE status NOT IN (403, 429, 454) GROUP BY k""")
def q_usable_captures(spark, d):
    """A refused capture is tried again another way; one that failed is not."""
    a = table(spark, d, "supplier").select(c("s_suppkey").alias("source_id"), F.lit("u").alias("url"), F.explode(F.array(*[F.lit(n) for n in (1, 2, 3)])).alias("attempt"))
    k = c("source_id") % 3
    a = a.withColumn("status", F.when(c("attempt") == 1, 403).when(c("attempt") == 2, F.when(k == 0, 429).when(k == 1, 500).otherwise(200)).otherwise(200))
    return cards.usable_captures(a.withColumn("body", F.concat(F.lit("body "), "attempt"))).select(c("source_id").alias("k"), "status", "body")


# --- tables and indexes


@checked("""WITH s AS (SELECT *, CASE WHEN s_suppkey % 40 BETWEEN 1 AND 9 THEN '1500+' WHEN s_suppkey % 40 BETWEEN 10 AND 19 THEN '800-1500' WHEN s_suppkey % 40 BETWEEN 20 AND 29 THEN '200-800' END AS size_band FROM supplier)
SELECT s_name AS name, 's' || s_suppkey AS slug, size_band, 'from ' || size_band AS size_label, round(s_suppkey % 97 / 10.0, 1) AS rating_score, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 50 AS DOUBLE) END AS compensation_score, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey AS INTEGER) END AS survey_count, 'https://r/companies/S' || s_suppkey || '/' AS company_url
FROM s WHERE size_band IS NOT NULL""")
def q_ratings_table(spark, d):
    """Ratings pages of forty companies under four size headings, the last of a band that does not count."""
    k = c("s_suppkey")
    s = table(spark, d, "supplier").select(k.alias("k"), c("s_name"), (k % 40).alias("at"))
    band = F.when(c("at") < 10, "1500+").when(c("at") < 20, "800—1500").when(c("at") < 30, "200–800").otherwise("80-200")
    # a heading stands above each row, so that a page's cut does not matter
    shown = F.regexp_replace(band, "[—–]", "-")
    row = F.concat(F.lit('<tr><td><h3 id="'), band, F.lit('">from <b>'), shown, F.lit('</b></h3></td></tr><tr><td class="company-name"><a href="https://r/companies/S'), "k", F.lit('/poll/">'), "s_name", F.lit('</a></td><td><div class="score all" title="'), F.format_number((c("k") % 97) / 10, 1), F.lit('">x</div><div class="score">'), F.when(c("k") % 2 == 0, (c("k") % 50).cast("string")).otherwise("n/a"), F.lit('</div></td><td><span class="count">'), F.when(c("k") % 3 == 0, "none").otherwise(F.concat("k", F.lit(" answers"))), F.lit("</span></td></tr>"))
    bronze = _bodies(s.where("at > 0").withColumn("source_id", F.floor(c("k") / 40)), row, '<table><tr><td class="company-name"><a href="https://r/companies/none/poll/">None</a></td></tr>', "</table>", "")
    return cards.ratings_table(bronze).drop("source_id", "pos").withColumn("rating_score", F.round("rating_score", 1))


@checked("""SELECT CASE WHEN s_suppkey % 40 BETWEEN 1 AND 9 THEN '1500+' WHEN s_suppkey % 40 BETWEEN 10 AND 19 THEN '800-1500' ELSE '200-800' END AS size_band, count(*) AS companies FROM supplier WHERE s_suppkey % 40 BETWEEN 1 AND 29 GROUP BY 1""")
def q_band_counts(spark, d):
    return cards.band_counts(q_ratings_table(spark, d))


@checked("""SELECT s_suppkey // 50 AS source_id, 'c-' || s_suppkey AS slug, s_name AS name, CASE WHEN s_suppkey // 50 % 2 = 1 OR s_suppkey % 4 = 0 THEN 0 ELSE CAST(s_suppkey % 30 AS INTEGER) END AS vacancy_count, 'https://jobs.dou.ua/companies/c-' || s_suppkey || '/vacancies/' AS vacancies_url FROM supplier""")
def q_catalogue_index(spark, d):
    """Pages of cards, and of bare links for every other source."""
    k = c("s_suppkey")
    s = table(spark, d, "supplier").select(k.alias("k"), "s_name", F.floor(k / 50).alias("source_id"))
    link = F.concat(F.lit('<a class="cn-a" href="https://jobs.dou.ua/companies/C-'), "k", F.lit('/">'), "s_name", F.lit("</a>"))
    site = F.concat(F.lit('<p>x</p><div class="site"><a href="u">s</a>'), F.when(c("k") % 4 == 0, "").otherwise(F.concat(F.lit('<a href="https://y/vacancies/"><span>Вакансії</span> '), c("k") % 30, F.lit("</a>"))), F.lit("</div>"))
    piece = F.concat(link, F.when(c("source_id") % 2 == 0, site).otherwise("<br>"))
    return cards.catalogue_index(_bodies(s, F.concat(piece, piece), "<ul>", "</ul>", ""))


@checked("""SELECT 's' || c_custkey AS slug, CASE WHEN c_custkey % 5 = 0 THEN 's' || c_custkey ELSE c_name END AS name FROM customer WHERE c_custkey % 7 <> 0""")
def q_catalogue_seed(spark, d):
    k = c("c_custkey")
    return cards.catalogue_seed(table(spark, d, "customer").select(F.when(k % 7 == 0, " ").otherwise(F.concat(F.lit(" S"), k.cast("string"))).alias("slug"), F.when(k % 5 != 0, c("c_name")).alias("name")))


@checked(f"WITH {PART} SELECT source_id, title, 'https://x.io/careers/job/' || id AS url FROM p WHERE k % 3 <> 0 AND size % 5 <> 0")
def q_plain_careers(spark, d):
    a = F.concat(F.lit('<a class=x href="'), F.when(c("size") % 5 == 0, F.lit("mailto:")).otherwise(F.lit("job/")), "id", F.lit('"> '), "title", F.lit(" </a>"))
    return cards.plain_careers(_bodies(_part(spark, d), F.concat(a, a), "", "", ""), "Co").drop("company")


@checked("SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN url END AS site FROM pages")
def q_company_site(spark, d):
    shown = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    profile = F.concat(F.lit('<h1>x</h1><div class="site">\n <a href="'), shown, F.when(c("page_id") % 3 == 0, '">').otherwise('" target="_blank" rel="nofollow">'), F.lit("s</a></div>"))
    return table(spark, d, "pages").select("page_id", cards.company_site(profile).alias("site"))


@checked(f"""WITH {PART} SELECT k AS source_id, 'https://x.io/careers/' AS url, next, rank FROM p, (VALUES ('https://x.io/vacancies', 1), ('https://x.io/careers/page/1/', 2), ('https://x.io/careers/page/2/', 3), ('https://x.io/careers/?page=3', 4), ('https://x.io/careers/page/4', 5)) t(next, rank)""")
def q_extra_pages(spark, d):
    links = ["/careers/page/1/", "https://other/page/9/", "/careers/page/2/", "/vacancies", "?page=3", "/open-roles", "/careers#top", "page/4", "page/5", "/about"]
    body = "".join(f'<a href="{x}">x</a>' for x in links)
    return cards.extra_pages(_part(spark, d).select(c("k").alias("source_id"), F.lit("https://x.io/careers/").alias("url"), F.lit(body).alias("body")))


@checked(f"""WITH {PART} SELECT id, CASE WHEN k % 4 = 0 THEN 'greenhouse:co' || id || ' | lever:co' || id ELSE 'workable:co' || id END AS hints FROM p""")
def q_board_hints(spark, d):
    body = F.when(c("k") % 4 == 0, _text('<a href="https://jobs.lever.co/Co', "$id", '/1">x</a> https://boards.greenhouse.io/embed/job_board?for=co', "$id", " https://boards.greenhouse.io/Co", "$id")).otherwise(_text("https://apply.workable.com/co", "$id", "/j/1"))
    hints = registry.board_hints(body)
    return _part(spark, d).select("id", F.array_join(F.transform(hints, lambda h: F.concat_ws(":", h["ats"], h["token"])), DASH).alias("hints"))


@checked(r"SELECT s_suppkey, array_to_string(list_filter(list_distinct([replace(lower(s_name), '#', ''), replace(lower(s_name), '#', '-'), string_split(lower(s_name), '#')[1]]), lambda x: length(x) >= 3 AND x <> ''), '') <> '' AS some, replace(lower(s_name), '#', '') AS joined, replace(lower(s_name), '#', '-') AS hyphened, string_split(lower(s_name), '#')[1] AS first_word FROM supplier")
def q_slug_guesses(spark, d):
    g = registry.slug_guesses(c("s_name"))
    return table(spark, d, "supplier").select("s_suppkey", (F.size(g) > 0).alias("some"), F.get(g, 0).alias("joined"), F.get(g, 1).alias("hyphened"), F.get(g, 2).alias("first_word"))


@checked("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'ios' WHEN page_id % 4 = 1 THEN 'mobile' WHEN page_id % 4 = 2 THEN 'unknown' ELSE 'none' END AS verdict FROM pages")
def q_discovery_verdict(spark, d):
    k = c("page_id") % 4
    words = lambda on, w: F.when(on, F.array(F.lit(w))).otherwise(F.array().cast("array<string>"))
    return table(spark, d, "pages").select("page_id", registry.discovery_verdict(words(k == 0, "swift"), words(k <= 1, "flutter"), F.when(k == 2, "blocked").otherwise("read")).alias("verdict"))


@checked("SELECT page_id, CASE WHEN page_id % 5 < 3 THEN 'degraded' ELSE 'healthy' END AS status FROM pages")
def q_structure_status(spark, d):
    on = [F.when(c("page_id") % 5 == i, 0).otherwise(3) for i in range(3)]
    return table(spark, d, "pages").select("page_id", registry.structure_status(*on).alias("status"))


_BASE_ORIGIN = "https://Example.com/x"


@checked(r"""WITH p AS (SELECT page_id, regexp_replace(url, '^https?://[^/?#]*', '') AS tail, url FROM pages),
u AS (SELECT page_id, CASE page_id % 14 WHEN 0 THEN 'https://example.com' || tail WHEN 1 THEN 'https://EXAMPLE.com' || tail WHEN 2 THEN 'https://me@example.com' || tail WHEN 3 THEN 'https://example.com:443' || tail WHEN 4 THEN 'http://example.com' || tail WHEN 5 THEN url
  WHEN 6 THEN 'https://localhost' || tail WHEN 7 THEN 'https://a.local' || tail WHEN 8 THEN 'https://10.' || page_id % 256 || '.0.1' || tail WHEN 9 THEN 'https://93.184.' || page_id % 256 || '.1' || tail WHEN 10 THEN 'https://172.' || page_id % 40 || '.0.1' || tail WHEN 11 THEN 'https://100.' || page_id % 256 || '.1.1' || tail WHEN 12 THEN 'https://[::1]' || tail ELSE 'https://[2606:4700::1]' || tail END AS target FROM p),
b AS (SELECT page_id, target, CASE WHEN page_id % 14 BETWEEN 6 AND 13 THEN regexp_extract(target, '^https://[^/?#]*') || '/list' ELSE 'https://Example.com/x' END AS base FROM u),
h AS (SELECT *, lower(regexp_extract(target, '^https://([^/?#]*)', 1)) AS t, lower(regexp_extract(base, '^https://([^/?#]*)', 1)) AS b FROM b),
o AS (SELECT *, CASE WHEN regexp_matches(t, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN list_transform(string_split(t, '.'), lambda x: x::INT) END AS v4 FROM h)
SELECT page_id, starts_with(target, 'https://') AND t <> '' AND t = b AND NOT contains(t, '@') AND t <> 'localhost' AND NOT suffix(t, '.local') AND t <> '[::1]'
  AND NOT coalesce(v4[1] = 10 OR v4[1] = 0 OR v4[1] = 127 OR v4[1] >= 240 OR (v4[1] = 172 AND v4[2] BETWEEN 16 AND 31) OR (v4[1] = 192 AND v4[2] = 168) OR (v4[1] = 100 AND v4[2] BETWEEN 64 AND 127), false) AS same FROM o""")
def q_same_origin(spark, d):
    """Links from a list to a page: other hosts, users, ports, this machine, and addresses that are not public are refused."""
    k, tail = c("page_id"), F.regexp_replace("url", "^https?://[^/?#]*", "")
    at = lambda host: F.concat(F.lit("https://"), host, tail)
    hosts = [F.lit("example.com"), F.lit("EXAMPLE.com"), F.lit("me@example.com"), F.lit("example.com:443"), None, None, F.lit("localhost"), F.lit("a.local"), F.concat(F.lit("10."), k % 256, F.lit(".0.1")), F.concat(F.lit("93.184."), k % 256, F.lit(".1")), F.concat(F.lit("172."), k % 40, F.lit(".0.1")), F.concat(F.lit("100."), k % 256, F.lit(".1.1")), F.lit("[::1]"), F.lit("[2606:4700::1]")]
    target = c("url")
    for i, host in enumerate(hosts):
        target = F.when(k % 14 == i, at(host) if host is not None else F.concat(F.lit("http://example.com"), tail) if i == 4 else c("url")).otherwise(target)
    base = F.when((k % 14).between(6, 13), F.concat(F.regexp_extract(target, "^https://[^/?#]*", 0), F.lit("/list"))).otherwise(_BASE_ORIGIN)
    return table(spark, d, "pages").select("page_id", C.same_origin(target, base).alias("same"))


@checked(f"WITH {PART} SELECT id, k % 4 <> 3 AS allowed FROM p")
def q_place_allowed(spark, d):
    k = c("k") % 4
    place = F.when(k == 0, " Remote ").when(k == 1, None).when(k == 2, "Berlin").otherwise("Berlin")
    return _part(spark, d).select("id", html.place_allowed(F.when(k == 2, "Other").otherwise(" Zoolatech"), place).alias("allowed"))


@checked("SELECT period, rank, name FROM (SELECT strftime(o_orderdate, '%m-%Y') AS period, CAST(o_orderkey AS INTEGER) AS rank, 'n' || o_orderkey AS name, max(strftime(o_orderdate, '%Y-%m')) OVER () AS last, strftime(o_orderdate, '%Y-%m') AS mine FROM orders) WHERE mine = last")
def q_ranked_csv(spark, d):
    o = table(spark, d, "orders").select(c("o_orderkey").alias("k"), F.floor(c("o_orderkey") / 1000).alias("source_id"), F.concat_ws(",", F.date_format("o_orderdate", "MM-yyyy"), "o_orderkey", F.concat(F.lit("n"), c("o_orderkey").cast("string"))).alias("line"))
    return feeds.ranked_csv(_bodies(o, c("line"), "period,rank,name\n", "\n", "\n"), "period string, rank int, name string", "period", "rank")


# --- messages


@checked(f"""WITH {PART} SELECT 'telegram' AS source, title AS title, brand AS company, 'https://a/' || id AS url, 'ch:' || id || ':0' AS source_job_id, kind AS location FROM p WHERE k % 3 <> 0
UNION ALL SELECT 'telegram', 'Swift Dev ' || id, 'B ' || id, 'https://b/' || id, 'ch:' || id || ':1', NULL FROM p""")
def q_message_digests(spark, d):
    """Digests of two links behind characters outside the basic plane, whose offsets count twice."""
    head, tail = F.concat(F.lit("🚀🚀 "), "title", F.lit(" @ "), "brand", F.lit("\nLocation: "), "kind", F.lit("\n")), F.concat(F.lit("Swift Dev "), "id", F.lit(" at B "), "id")
    span = lambda at, text, url: F.struct(at.cast("int").alias("offset"), F.length(text).cast("int").alias("length"), url.alias("url"))
    m = _part(spark, d).select(F.lit("ch").alias("channel"), c("k").alias("message_id"), F.concat(head, tail).alias("text"), F.lit(None).cast("timestamp").alias("published_at"), F.array(span(F.lit(5), c("title"), _link(" https://a/")), span(F.length(head) + 2, tail, _link("https://b/"))).alias("entities"))
    return messages.postings_from_digests(m).select("source", "title", "company", "url", "source_job_id", "location")


@checked("SELECT event_id, event_id % 9 = 0 OR ts >= TIMESTAMP '2024-02-10' - INTERVAL 30 DAY AS recent FROM events")
def q_is_recent(spark, d):
    at = F.when(c("event_id") % 9 != 0, c("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", messages.is_recent(at, F.lit("2024-02-10 00:00:00").cast("timestamp")).alias("recent"))


@checked(rf"""WITH {RAW_SQL}, m AS (
  SELECT seq, CASE WHEN seq % 5 = 0 THEN 'ch' ELSE 'hirifyme_bot' END AS channel, CASE seq % 6 WHEN 0 THEN title || ' в Acme' || chr(10) || 'https://hirify.me/jobs/' || seq WHEN 1 THEN title || ' в Acme' || chr(10) || 'https://other.io/' || seq WHEN 2 THEN 'По подписке: ' || title WHEN 3 THEN title || ' и точка' WHEN 4 THEN '#резюме' || chr(10) || title || ' в Acme' || chr(10) || 'https://hirify.me/jobs/' || seq END AS text FROM raw),
j AS (SELECT *, regexp_matches(text, '(?m)^\s*.+?\s+в\s+[^\n]+?\s*$') AS heading, {oracle.target("text", "NULL")} AS target FROM m)
SELECT channel, count(*) AS messages, count(*) FILTER (WHERE channel = 'hirifyme_bot' AND target AND (heading OR contains(lower(text), 'по подписке:')) AND NOT (heading AND NOT contains(text, '#резюме') AND contains(text, 'https://hirify.me/jobs/'))) AS malformed FROM j GROUP BY 1""")
def q_malformed_messages(spark, d):
    """The bot's messages that announce a posting and give none: no heading, no link to the board, or a candidate's."""
    raw, k = raw_postings(spark, d), c("seq")
    line = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    text = F.when(k % 6 == 0, line(c("title"), " в Acme\nhttps://hirify.me/jobs/", k)).when(k % 6 == 1, line(c("title"), " в Acme\nhttps://other.io/", k)).when(k % 6 == 2, line("По подписке: ", c("title")))
    text = text.when(k % 6 == 3, line(c("title"), " и точка")).when(k % 6 == 4, line("#резюме\n", c("title"), " в Acme\nhttps://hirify.me/jobs/", k))
    m = raw.select(F.when(k % 5 == 0, "ch").otherwise("hirifyme_bot").alias("channel"), k.alias("message_id"), text.alias("text"), F.array().cast("array<string>").alias("urls"))
    return messages.malformed_counts(m)


# --- state and reports


@checked("WITH x AS (SELECT user_id % 60 AS channel, event_id AS cursor FROM events) SELECT channel, max(cursor) AS cursor FROM x GROUP BY channel")
def q_merge_cursors(spark, d):
    e = table(spark, d, "events").select((c("user_id") % 60).alias("channel"), c("event_id").alias("cursor"))
    local, remote = (e.where(w).groupBy("channel").agg(F.max("cursor").alias("cursor")) for w in ("cursor % 2 = 0", "cursor % 2 = 1"))
    return state_merge.merge_max(local, remote, key="channel", value="cursor")


@checked("SELECT DISTINCT CAST(ts AS DATE) AS day, CASE WHEN hour(ts) < 12 THEN 8 ELSE 14 END AS slot FROM events UNION SELECT DATE '2024-03-01', 8")
def q_slots_marked(spark, d):
    """Slots of two histories as one set, and one more that is marked twice."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), F.when(F.hour("ts") < 12, 8).otherwise(14).alias("slot"), "event_id")
    slots = state_merge.merge_union(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), columns=["day", "slot"])
    for _ in range(2):
        slots = incremental.mark_slot(slots, F.lit("2024-03-01").cast("date"), F.lit(8))
    return slots


@checked("SELECT o_custkey, o_orderkey, CASE WHEN o_custkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 'failed' WHEN o_orderkey % 4 = 0 THEN 'degraded' ELSE 'healthy' END AS status FROM orders")
def q_run_status(spark, d):
    k = c("o_orderkey")
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", health.run_status(c("o_custkey") % 3 != 0, k % 5 == 0, k % 4 == 0).alias("status"))


@checked("SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_partkey % 2 = 0 THEN 'failed' WHEN p_size % 3 = 0 THEN 'degraded' ELSE 'healthy' END AS status FROM part")
def q_source_status(spark, d):
    errors = F.when(c("p_size") % 3 == 0, F.array(F.lit("timeout")))
    return table(spark, d, "part").select("p_partkey", feeds.source_status(F.when(c("p_partkey") % 2 == 0, 0).otherwise(5), errors).alias("status"))


@checked("""WITH n AS (SELECT s_nationkey, list_sort(list(s_name)) AS l FROM supplier GROUP BY 1)
SELECT s_nationkey, array_to_string(l[1:3], ', ') || CASE WHEN len(l) > 3 THEN ' (+' || (len(l) - 3) || ')' ELSE '' END AS names FROM n""")
def q_short_list(spark, d):
    return table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_name")).alias("l")).select("s_nationkey", C.short_list(c("l")).alias("names"))


@checked("""WITH n AS (SELECT s_nationkey, list_sort(list(s_name)) AS l FROM supplier GROUP BY 1), s AS (SELECT s_nationkey, array_to_string(l[1:3], ', ') || CASE WHEN len(l) > 3 THEN ' (+' || (len(l) - 3) || ')' ELSE '' END AS x FROM n)
SELECT s_nationkey, '⚠️ Не ответили: ' || x || CASE WHEN s_nationkey % 3 = 0 THEN chr(10) || '⚠️ Telegram: jobs, Telegram ' ELSE '' END || CASE WHEN s_nationkey % 2 = 0 THEN chr(10) || '🔑 Telegram без ключей: ' || x ELSE '' END AS problems FROM s""")
def q_problem_lines(spark, d):
    """Sites and channels that failed stand in lines of their own."""
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_name")).alias("l"))
    none = F.array().cast("array<string>")
    channels = F.when(c("s_nationkey") % 3 == 0, F.array(F.lit("Telegram @jobs"), F.lit("Telegram "))).otherwise(none)
    s = s.withColumns({"failed_names": F.concat(F.slice(channels, 1, 1), "l", F.slice(channels, 2, 1)), "manual_names": none, "degraded_names": none, "skipped_names": F.when(c("s_nationkey") % 2 == 0, c("l")).otherwise(none)})
    return reports.problem_lines(s, "s_nationkey")


@checked("SELECT n, '📬 +' || n || ' ' || CASE WHEN n % 10 = 1 AND n % 100 <> 11 THEN 'новая вакансия' WHEN n % 10 BETWEEN 2 AND 4 AND n % 100 NOT BETWEEN 12 AND 14 THEN 'новые вакансии' ELSE 'новых вакансий' END AS header FROM (SELECT p_partkey AS n FROM part)")
def q_new_header(spark, d):
    return table(spark, d, "part").select(c("p_partkey").alias("n"), reports.new_header(c("p_partkey")).alias("header"))


@checked("SELECT CAST(o_orderkey AS VARCHAR) AS key, '{\"first_seen\":\"' || strftime(o_orderdate, '%Y-%m-%d') || '\",\"title\":\"' || o_orderpriority || '\"}' AS entry FROM orders")
def q_history_json(spark, d):
    """History for consumers that read documents: private fields out, by key."""
    o = table(spark, d, "orders").select(c("o_orderkey").cast("string").alias("key"), c("o_orderpriority").alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_seen"), F.lit("x").alias("disposition"), F.lit("y").alias("applied_at"))
    return storage.sorted_json(incremental.sanitize_seen(o), "key")


@checked("SELECT o_orderkey AS k, o_orderstatus AS v, CAST(NULL AS BIGINT) AS more FROM orders WHERE o_orderkey % 3 <> 0")
def q_replaced_table(spark, d):
    """A stored table replaced by a selection of itself."""
    import uuid

    path = f"{storage.shared_dir(spark)}/table-{uuid.uuid4().hex}"
    storage.replace_table(table(spark, d, "orders").select(c("o_orderkey").alias("k"), c("o_orderstatus").alias("v")), path)
    schema = "k long, v string, more long"
    storage.replace_table(storage.read_table(spark, path, schema).where("k % 3 <> 0").select("k", "v"), path)
    return storage.read_table(spark, path, schema)
