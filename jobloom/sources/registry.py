"""Per-source JSON parsers as configuration: where the items are, and which column holds what.

A source is a row of this registry, so adding one needs no code: a schema, the item array, and Column-valued
fields. Bodies are captured documents (``bronze``); pages of one source are rows of it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions.entities import unescape
from jobloom.plans import storage
from jobloom.sources import cards, feeds, html

Fields = Callable[[Column], dict[str, Column]]


@dataclass(frozen=True)
class JsonSource:
    """``schema`` of a body, its ``items``, their ``fields`` (title, url and optional location, remote, description,
    job_id), and ``body``, which finds the JSON within the captured text."""

    schema: str
    items: Callable[[Column], Column]
    fields: Fields
    body: Callable[[Column], Column] = field(default=lambda b: b)
    key: str = "url"


def parse_json(bronze: DataFrame, source: JsonSource, company: str, gate: bool = True) -> DataFrame:
    """Postings of a source's pages, the first of each key by page and place; off-topic titles are out unless ``gate`` is off.

    Pages are told apart by a ``page`` number where the captures have one, else by their url.
    """
    body = source.body(F.col("body"))
    parsed = F.try_parse_json(body) if source.schema == "variant" else F.from_json(body, source.schema)
    page = F.col("page" if "page" in bronze.columns else "url")
    rows = bronze.select("source_id", page.alias("_page"), F.posexplode(source.items(parsed)).alias("_pos", "_item"))
    fields = {"location": F.lit(None).cast("string"), "remote": F.lit(None).cast("string"), "description": F.lit(None).cast("string"), "job_id": F.lit(None).cast("string")}
    fields |= source.fields(F.col("_item"))
    df = rows.select("source_id", F.lit(company).alias("company"), *[v.alias(k) for k, v in fields.items()], F.struct("_page", "_pos").alias("_at"))
    df = df.where((C.strip(C.text(F.col("title"))) != "") & (C.text(F.col("url")) != ""))
    df = df.where(C.is_target_job(F.col("title"), F.col("description"))) if gate else df
    columns = ["source_id", "company", *fields]
    first = df.groupBy("source_id", F.col(source.key).alias("_key")).agg(F.min_by(F.struct(*columns), "_at").alias("_first"))
    return first.select("_first.*")


def _named(items: Column) -> Column:
    return F.nullif(F.array_join(F.array_distinct(F.transform(items, lambda x: x["title"])), ", "), F.lit(""))


_LOOSE = "array<struct<id: string, title: string, name: string, slug: string, url: string, location: string>>"

#: Shapes that the bespoke sources share, under the kind of their payload.
JSON_SOURCES: dict[str, JsonSource] = {
    "flat_list": JsonSource("array<struct<id: string, title: string, url: string, location: string, technologies: array<string>>>", lambda b: b, lambda j: {"title": j["title"], "url": j["url"], "location": j["location"], "description": F.array_join(j["technologies"], ", "), "job_id": j["id"]}),
    "nested_data": JsonSource("data struct<jobs: array<struct<id: string, name: string, link: string, city: string>>>", lambda b: b["data"]["jobs"], lambda j: {"title": j["name"], "url": j["link"], "location": j["city"], "job_id": j["id"]}),
    "requisitions": JsonSource("items array<struct<requisitionList: array<struct<Id: string, Title: string>>>>", lambda b: F.flatten(F.transform(b["items"], lambda i: i["requisitionList"])), lambda j: {"title": j["Title"], "url": F.concat(F.lit("https://explore-jobs.ciklum.com/en/sites/ciklum-career/job/"), F.nullif(j["Id"], F.lit(""))), "job_id": j["Id"]}, key="job_id"),
    "next_data": JsonSource("props struct<pageProps: struct<vacancies: array<struct<id: string, title: string, url: string, location: string>>>>", lambda b: b["props"]["pageProps"]["vacancies"], lambda j: {"title": j["title"], "url": j["url"], "location": j["location"], "job_id": j["id"]}, lambda b: F.regexp_extract(b, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)),
    "attribute": JsonSource("array<struct<id: string, title: string, link: string, city: string>>", lambda b: b, lambda j: {"title": j["title"], "url": j["link"], "location": j["city"], "job_id": j["id"]}, lambda b: unescape(F.regexp_extract(b, r'(?s)data-vacancies="([^"]*)"', 1))),
    "wordpress": JsonSource("array<struct<id: string, link: string, title: struct<rendered: string>, content: struct<rendered: string>>>", lambda b: b, lambda j: {"title": C.squeeze(C.strip(C.html_text(j["title"]["rendered"]))), "url": j["link"], "description": j["content"]["rendered"], "job_id": j["id"]}),
    "paged": JsonSource("pages array<struct<items: array<struct<id: string, title: string, url: string, cities: array<struct<title: string>>>>>>", lambda b: F.flatten(F.transform(b["pages"], lambda p: p["items"])), lambda j: {"title": j["title"], "url": j["url"], "location": _named(F.filter(j["cities"], lambda x: ~F.lower(x["title"]).contains("any city"))), "job_id": j["id"]}),
    # pages of a list with the number of all its items
    "offset_list": JsonSource("list array<struct<id: string, title: string, url: string, offices: array<string>>>, page struct<itemTotal: long>", lambda b: b["list"], lambda j: {"title": C.strip(j["title"]), "url": cards.resolve(C.strip(C.text(j["url"])), "https://www.valtech.com"), "location": F.nullif(F.array_join(F.filter(F.transform(j["offices"], C.strip), lambda o: o != ""), " / "), F.lit("")), "job_id": j["id"]}),
    # pages of a session, with the number of the last in each
    "session_pages": JsonSource("data struct<vacancies: array<struct<id: string, name: string, urlSegment: string, city: string>>>, vacancies array<struct<id: string, name: string, urlSegment: string, city: string>>, meta struct<last_page: int>", lambda b: F.coalesce(b["data"]["vacancies"], b["vacancies"]), lambda j: {"title": C.strip(j["name"]), "url": F.when(F.ltrim(C.strip(C.text(j["urlSegment"])), F.lit("/")) != "", F.concat(F.lit("https://career.softserveinc.com/en-us/vacancies/"), F.ltrim(C.strip(j["urlSegment"]), F.lit("/")))), "location": F.nullif(C.strip(j["city"]), F.lit("")), "job_id": j["id"]}),
    # one list under any of three names, or the body itself
    "named_lists": JsonSource("variant", lambda b: F.coalesce(*[F.try_variant_get(b, p, _LOOSE) for p in ("$.data", "$.results", "$.vacancies", "$")]), lambda j: {"title": F.coalesce(F.nullif(C.strip(j["title"]), F.lit("")), C.strip(j["name"])), "url": F.when(C.text(F.coalesce(j["slug"], j["url"])) != "", cards.resolve(C.strip(F.coalesce(F.nullif(j["slug"], F.lit("")), j["url"])), "https://themindstudios.com/careers/")), "location": j["location"], "job_id": F.nullif(j["id"], F.lit("0"))}),
    "slug_list": JsonSource("array<struct<id: string, title: string, url: string, remote: boolean>>", lambda b: b, lambda j: {"title": C.strip(j["title"]), "url": F.when(F.ltrim(C.strip(C.text(j["url"])), F.lit("/")) != "", F.concat(F.lit("https://zone3000.com/careers/"), F.ltrim(C.strip(j["url"]), F.lit("/")))), "location": F.when(j["remote"], "Remote"), "job_id": j["id"]}),
    # a narrow query's page before the page of all, told by slug; the list may stand one level down
    "two_queries": JsonSource("vacancies struct<items: array<struct<title: string, slug: string>>>, items array<struct<title: string, slug: string>>", lambda b: F.coalesce(b["vacancies"]["items"], b["items"]), lambda j: {"title": j["title"], "url": F.when(C.text(j["slug"]) != "", F.concat(F.lit("https://www.dataart.team/vacancies/"), j["slug"]))}),
    "located": JsonSource("array<struct<id: string, title: string, countryLocations: array<struct<city: string, country: string>>, relatedLocations: array<string>>>", lambda b: b, lambda j: {"title": j["title"], "url": F.concat(F.lit("https://www.griddynamics.com/careers/vacancy/"), F.nullif(j["id"], F.lit(""))), "location": F.nullif(F.array_join(F.filter(F.concat(F.coalesce(F.transform(j["countryLocations"], lambda p: F.concat_ws(", ", F.nullif(p["city"], F.lit("")), F.nullif(p["country"], F.lit("")))), F.array().cast("array<string>")), F.coalesce(F.transform(j["relatedLocations"], C.strip), F.array().cast("array<string>"))), lambda x: C.text(x) != ""), " / "), F.lit("")), "job_id": j["id"]}, lambda b: unescape(F.regexp_extract(b, r"(?s)data-vacancies='([^']+)'", 1))),
}

DETAIL = "props struct<pageProps: struct<job: struct<name: string, uid: string, text: string, description: string, is_expired: boolean, metadata: struct<country: array<struct<title: string>>, city: array<struct<title: string>>, vacancy_type: array<struct<title: string>>>>>>"


def sitemap_details(sitemaps: DataFrame, details: DataFrame, slug_pattern: str, company: str) -> DataFrame:
    """Sitemap links joined to their captured detail pages; expired and unreadable ones are out."""
    links = feeds.parse_sitemap(sitemaps, slug_pattern)
    df = links.join(details.select(F.col("url"), "body"), "url").withColumn("j", feeds.next_data(F.col("body"), DETAIL)["props"]["pageProps"]["job"])
    df = df.where(F.col("j.name").isNotNull() & ~F.coalesce("j.is_expired", F.lit(False)))
    place = F.nullif(F.concat_ws(", ", _named(F.col("j.metadata.city")), _named(F.col("j.metadata.country"))), F.lit(""))
    kinds = F.lower(C.text(_named(F.col("j.metadata.vacancy_type"))))
    mode = F.when(kinds.contains("remote"), "remote").when(kinds.contains("hybrid"), "hybrid").when(kinds.contains("office"), "onsite")
    return df.select("source_id", F.lit(company).alias("company"), F.col("j.name").alias("title"), "url", place.alias("location"), mode.alias("remote"), F.coalesce("j.text", "j.description").alias("description"), F.col("j.uid").alias("job_id"))


def sitemap_status(sitemaps: DataFrame, details: DataFrame, slug_pattern: str) -> DataFrame:
    """For each source: links listed, details read, and its status: failed where none could be read."""
    links = feeds.parse_sitemap(sitemaps, slug_pattern)
    df = links.join(details.select("url", F.lit(1).alias("read")).distinct(), "url", "left").groupBy("source_id").agg(F.count("*").alias("listed"), F.count("read").alias("scanned"))
    return df.withColumn("status", F.when(F.col("scanned") == 0, "failed").when(F.col("scanned") < F.col("listed"), "degraded").otherwise("healthy"))


CARD_JOB, CARD_COMPANY = r"^/companies/[^/?#]+/jobs/[^/?#]+", r"^/companies/[^/?#]+/?$"


def listing_cards(bronze: DataFrame, base: str) -> DataFrame:
    """Cards of a listing page: each job link with the company link before it and an outside link after it, if
    one stands before the next job. Repeated links count once; the outside link is preferred."""
    from pyspark.sql import Window

    links = bronze.select("source_id", F.explode(html.page_links(F.col("body"))).alias("x")).select("source_id", "x.pos", "x.href", "x.text")
    job, org = F.col("href").rlike(CARD_JOB), F.col("href").rlike(CARD_COMPANY)
    outside = F.col("href").rlike("^https?://") & ~F.startswith("href", F.lit(base))
    w = Window.partitionBy("source_id").orderBy("pos")
    df = links.withColumn("card", F.sum(F.when(job, 1).otherwise(0)).over(w)).withColumn("org", F.last(F.when(org, F.col("text")), True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = df.groupBy("source_id", "card").agg(F.min_by(F.struct("href", "text", "org"), F.when(job, F.col("pos"))).alias("j"), F.min_by("href", F.when(outside, F.col("pos"))).alias("employer"))
    df = found.where("j IS NOT NULL").select("source_id", "card", F.col("j.text").alias("title"), F.col("j.org").alias("company"), F.coalesce("employer", F.concat(F.lit(base), "j.href")).alias("url"), F.col("j.href").alias("href"))
    return df.groupBy("source_id", "href").agg(F.min_by(F.struct("title", "company", "url"), "card").alias("c")).select("source_id", "c.*")


def structure_status(found: Column, readable: Column, located: Column) -> Column:
    """A listing whose structure changed: no cards, none readable, or none with a place."""
    return F.when(found == 0, "degraded").when(readable == 0, "degraded").when(located == 0, "degraded").otherwise("healthy")


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder; one of our own only where none is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(storage.shared_dir(df.sparkSession))
    return df.checkpoint()


def follow_pages(seeds: DataFrame, links: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Pages reachable from ``seeds(url)`` over ``links(url, next)``: a frontier join a round, each round's new urls
    anti-joined with those reached, until none is new. ``max_rounds`` is a crawl's own depth limit; a chain of more links than
    that raises, since the pages found would not be all."""
    reached, frontier, rounds = seeds.select("url").distinct(), seeds.select("url").distinct(), 0
    while True:
        frontier = frontier.join(links, "url").select(F.col("next").alias("url")).distinct().join(reached, "url", "left_anti").transform(_cut)
        if frontier.isEmpty():
            return reached
        if max_rounds is not None and rounds == max_rounds:
            raise RuntimeError(f"pages deeper than {max_rounds} links")
        reached, rounds = reached.union(frontier).transform(_cut), rounds + 1


def detail_matches(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Listing rows with the JSON-LD posting of their detail page whose title is the same, the first of them."""
    data = details.select(F.col("url"), F.posexplode(html.page_postings(F.col("body"))).alias("pos", "d"))
    same = C.normalize_token(F.col("title")) == C.normalize_token(F.col("d.title"))
    both = listing.join(data, "url").where(same).groupBy("source_id", "url", "title").agg(F.min_by("d", "pos").alias("d"))
    return both.select("source_id", "url", "title", F.col("d.description").alias("description"), F.col("d.location").alias("location"))


def discovery_verdict(native: Column, mobile: Column, state: Column) -> Column:
    """What an inspected company is: an Apple employer, a mobile one, unreadable, or neither."""
    return F.when(F.size(native) > 0, "ios").when(F.size(mobile) > 0, "mobile").when(state.isin("failed", "blocked"), "unknown").otherwise("none")


def slug_guesses(name: Column) -> Column:
    """Board tokens to try for a company: its letters joined, hyphenated, and its first word, three letters or more."""
    low = C.normalize_token(name)
    words = F.filter(F.split(low, r"[^a-z0-9]+"), lambda w: w != "")
    return F.filter(F.array_distinct(F.array(F.array_join(words, ""), F.array_join(words, "-"), F.get(words, 0))), lambda x: F.length(x) >= 3)


def board_hints(body: Column) -> Column:
    """``(ats, token)`` pairs that a page links to, in order and once each."""
    pair = lambda ats, pattern: F.transform(F.regexp_extract_all(body, F.lit(pattern), 1), lambda t: F.struct(F.lit(ats).alias("ats"), F.lower(t).alias("token")))
    return F.array_distinct(F.concat(
        pair("greenhouse", r"(?i)boards(?:\.eu)?\.greenhouse\.io/(?:embed/job_board\?for=)?([a-z0-9_-]+)"), pair("lever", r"(?i)jobs(?:\.eu)?\.lever\.co/([a-z0-9_-]+)"), pair("ashby", r"(?i)jobs\.ashbyhq\.com/([a-z0-9_.-]+)"),
        pair("breezy", r"(?i)([a-z0-9-]+)\.breezy\.hr"), pair("recruitee", r"(?i)([a-z0-9-]+)\.recruitee\.com"), pair("workable", r"(?i)apply\.workable\.com/([a-z0-9-]+)"),
    ))
