"""Parsers of captured bodies: RSS, applicant-tracking JSON, paged JSON, sitemaps, listings and CSV.

Fetching is not part of the plan: each parser takes ``bronze(source_id, url, body)`` with one row a captured
document and gives raw postings. Declared schemas keep parsing in ``from_json`` and ``from_xml``; a body
that cannot be parsed gives no rows and shows in ``payload_ok``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions.entities import unescape

RSS = "channel struct<item: array<struct<title: string, link: string, description: string, pubDate: string, guid: string, category: string>>>"


def rfc822(c: Column) -> Column:
    """``Mon, 01 Jan 2024 10:00:00 +0200`` as a timestamp, null where unreadable."""
    bare = F.regexp_replace(C.strip(C.text(c)), r"^\w+,\s*", "")
    return F.try_to_timestamp(F.regexp_replace(bare, r"\b(GMT|UTC)$", "+0000"), F.lit("d MMM yyyy HH:mm:ss Z"))


def split_item_title(title: Column) -> dict[str, Column]:
    """``role в company, places, pay, remote`` -> its parts, split at the last `` в `` and at commas outside brackets."""
    role = C.strip(F.regexp_extract(title, r"(?s)^(.*) в (.*)$", 1))
    tail = F.regexp_extract(title, r"(?s)^(.*) в (.*)$", 2)
    parts = F.transform(F.split(tail, r",(?![^(]*\))"), C.strip)
    rest = F.filter(F.slice(parts, 2, F.size(parts)), lambda p: ~C.matches(p, r"[$€₴]|\d{3,}") & (p != ""))
    remote = F.exists(rest, lambda p: C.matches(p, r"\b(?:remote|віддалено|удаленно)\b"))
    places = F.filter(rest, lambda p: ~C.matches(p, r"\b(?:remote|віддалено|удаленно)\b"))
    return {"title": F.when(role == "", C.strip(title)).otherwise(role), "company": F.when(role == "", "").otherwise(parts[0]), "location": F.nullif(F.array_join(places, ", "), F.lit("")), "remote": F.when(remote, "remote")}


def parse_rss(bronze: DataFrame, named_company: bool = True, title_filter: Callable[[Column], Column] | None = None, track: str = "ios") -> DataFrame:
    """One row an item. ``named_company`` feeds carry the employer in the title, others never name it.

    ``title_filter`` is a Column predicate; the default is the topic gate.
    """
    items = bronze.select("source_id", F.explode(F.from_xml("body", RSS)["channel"]["item"]).alias("i"))
    title = unescape(C.text(F.col("i.title")))
    parts = split_item_title(title) if named_company else {"title": C.strip(title), "company": F.lit(""), "location": F.lit(None).cast("string"), "remote": F.lit(None).cast("string")}
    url = C.strip_tracking(C.strip(C.text(F.col("i.link"))))
    df = items.select("source_id", *[v.alias(k) for k, v in parts.items()], url.alias("url"), rfc822(F.col("i.pubDate")).alias("published_at"), unescape(C.text(F.col("i.description"))).alias("description"), F.nullif(F.regexp_extract(url, r"/(\d+)", 1), F.lit("")).alias("source_job_id"), F.lit(track).alias("track"))
    gate = title_filter(F.col("title")) if title_filter else C.is_target_job(F.col("title"), F.col("description"))
    return df.where((F.col("title") != "") & (F.col("url") != "") & gate)


def _joined(*cs: Column) -> Column:
    return F.nullif(F.array_join(F.filter(F.array(*cs), lambda x: C.text(x) != ""), "\n"), F.lit(""))


def _places(names: Column) -> Column:
    return F.nullif(F.array_join(F.array_distinct(F.filter(names, lambda x: C.text(x) != "")), " / "), F.lit(""))


#: For each system: the body's schema, the item array within it, and the columns of one item.
ATS: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], dict[str, Column]]]] = {
    "greenhouse": ("jobs array<struct<id: string, title: string, absolute_url: string, location: struct<name: string>, content: string>>", lambda b: b["jobs"], lambda j: {"title": j["title"], "url": j["absolute_url"], "location": j["location"]["name"], "description": unescape(j["content"]), "job_id": j["id"], "remote": F.lit(None).cast("string")}),
    "lever": ("array<struct<id: string, text: string, hostedUrl: string, workplaceType: string, categories: struct<location: string>, descriptionPlain: string, additionalPlain: string>>", lambda b: b, lambda j: {"title": j["text"], "url": j["hostedUrl"], "location": j["categories"]["location"], "description": _joined(j["descriptionPlain"], j["additionalPlain"]), "job_id": j["id"], "remote": F.when(F.lower(j["workplaceType"]) == "remote", "remote")}),
    "ashby": ("jobs array<struct<id: string, title: string, jobUrl: string, location: string, secondaryLocations: array<struct<location: string>>, isRemote: boolean, isListed: boolean, descriptionPlain: string>>", lambda b: F.filter(b["jobs"], lambda j: F.coalesce(j["isListed"], F.lit(True))), lambda j: {"title": j["title"], "url": j["jobUrl"], "location": _places(F.concat(F.array(j["location"]), F.coalesce(F.transform(j["secondaryLocations"], lambda s: s["location"]), F.array().cast("array<string>")))), "description": j["descriptionPlain"], "job_id": j["id"], "remote": F.when(j["isRemote"], "remote")}),
    "breezy": ("array<struct<id: string, name: string, url: string, location: struct<name: string, is_remote: boolean>, locations: array<struct<name: string, is_remote: boolean>>, description: string>>", lambda b: b, lambda j: {"title": j["name"], "url": j["url"], "location": _places(F.transform(F.when(F.size(j["locations"]) > 0, j["locations"]).otherwise(F.array(j["location"])), lambda p: p["name"])), "description": j["description"], "job_id": j["id"], "remote": F.when(F.exists(F.when(F.size(j["locations"]) > 0, j["locations"]).otherwise(F.array(j["location"])), lambda p: F.coalesce(p["is_remote"], F.lit(False))), "remote")}),
    "recruitee": ("offers array<struct<id: string, title: string, careers_url: string, location: string, status: string, remote: boolean, description: string, requirements: string>>", lambda b: F.filter(b["offers"], lambda j: F.coalesce(j["status"], F.lit("published")) == "published"), lambda j: {"title": j["title"], "url": j["careers_url"], "location": j["location"], "description": _joined(j["description"], j["requirements"]), "job_id": j["id"], "remote": F.when(j["remote"], "remote")}),
    "workable": ("jobs array<struct<title: string, url: string, shortlink: string, shortcode: string, locations: array<struct<city: string, country: string>>, telecommuting: boolean>>", lambda b: b["jobs"], lambda j: {"title": j["title"], "url": F.coalesce(j["url"], j["shortlink"]), "location": _places(F.transform(j["locations"], lambda p: F.concat_ws(", ", p["city"], p["country"]))), "description": F.lit(None).cast("string"), "job_id": j["shortcode"], "remote": F.when(j["telecommuting"], "remote")}),
}


def parse_ats(bronze: DataFrame, ats: str) -> DataFrame:
    """All postings of a system's captured boards, on or off topic, with a title and an https link."""
    schema, items, fields = ATS[ats]
    rows = bronze.select("source_id", F.explode(items(F.from_json("body", schema))).alias("j"))
    df = rows.select("source_id", *[v.alias(k) for k, v in fields(F.col("j")).items()])
    return df.where((C.strip(C.text(F.col("title"))) != "") & F.lower(C.text(F.col("url"))).startswith("https://"))


def scanned_counts(bronze: DataFrame, ats: str) -> DataFrame:
    """Items of each source before any filter, and whether the payload had the expected shape."""
    schema, items, _ = ATS[ats]
    n = F.size(items(F.from_json("body", schema)))
    return bronze.select("source_id", F.greatest(n, F.lit(0)).alias("scanned"), F.coalesce(n >= 0, F.lit(False)).alias("payload_ok"))


PAGED = "current_page int, last_page int, data array<struct<id: string, title: string, slug: string, company_title: string, work_format: array<string>, office_locations: array<string>, tldr: string, tags: array<struct<name: string>>, is_archived: boolean, is_scam: boolean, source_secondary: string>>"


def parse_paged_search(bronze: DataFrame, base: str, max_pages: int = 10, placeholder: tuple[str, ...] = ("", "unknown", "confidential")) -> DataFrame:
    """A search API's captured pages up to ``last_page``; archived and scam items are out."""
    page = bronze.select("source_id", F.from_json("body", PAGED).alias("p")).where((F.col("p.current_page") <= F.least("p.last_page", F.lit(max_pages))))
    df = page.select("source_id", F.explode("p.data").alias("d")).where(~F.coalesce("d.is_archived", F.lit(False)) & ~F.coalesce("d.is_scam", F.lit(False)))
    company = C.strip(C.text(F.col("d.company_title")))
    places = F.array_distinct(F.transform(F.coalesce("d.office_locations", F.array().cast("array<string>")), lambda x: F.initcap(C.strip(x))))
    mode = F.coalesce(*[F.when(F.array_contains("d.work_format", m), m) for m in ("remote", "hybrid", "onsite")])
    body = F.concat_ws("\n", "d.tldr", F.array_join(F.transform("d.tags", lambda t: t["name"]), ", "))
    return df.select("source_id", F.when(F.lower(company).isin(*placeholder), F.coalesce("d.source_secondary", F.lit(""))).otherwise(company).alias("company"), C.strip(F.col("d.title")).alias("title"), F.concat(F.lit(base), "d.slug").alias("url"), F.nullif(F.array_join(places, ", "), F.lit("")).alias("location"), mode.alias("remote"), body.alias("description"), F.col("d.id").alias("job_id"))


def numbered_pages(pages: DataFrame, most: int) -> DataFrame:
    """``source_id, read, missing, deferred, status`` of ``pages(source_id, page, last)``: captures that each say which page is the last.

    A reader goes on to the last page that the page before named, at most ``most``; a page without a word of it is the last. ``read`` counts the
    pages from the first on without a gap, ``missing`` those named that were not captured, ``deferred`` those beyond the bound. Pages after
    the end that a reader would see do not count.
    """
    w = Window.partitionBy("source_id").orderBy("page")
    seen = pages.where("page >= 1").groupBy("source_id", "page").agg(F.max("last").alias("last"))
    seen = seen.withColumns({"nth": F.row_number().over(w), "named": F.lag(F.coalesce("last", F.col("page"))).over(w)})
    chain = seen.withColumn("on", (F.col("page") == F.col("nth")) & (F.col("nth") <= most) & (F.coalesce("named", F.lit(1)) >= F.col("page")))
    chain = chain.withColumn("on", F.min("on").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    read = chain.groupBy("source_id").agg(F.count_if("on").alias("read"), F.max(F.when(F.col("on"), F.struct("page", F.coalesce("last", F.col("page")).alias("last"))))["last"].alias("last"))
    every = pages.select("source_id").distinct().join(read, "source_id", "left").select("source_id", F.coalesce("read", F.lit(0)).alias("read"), F.greatest(F.coalesce("last", F.lit(1)), F.lit(1)).alias("last"))
    counts = every.withColumns({"missing": F.greatest(F.least("last", F.lit(most)) - F.col("read"), F.lit(0)).cast("long"), "deferred": F.greatest(F.col("last") - most, F.lit(0)).cast("long")})
    return counts.select("source_id", "read", "missing", "deferred", bounded_status(F.col("read"), F.col("missing") + F.col("deferred")).alias("status"))


def chained_pages(pages: DataFrame, most: int | None = None) -> DataFrame:
    """``source_id, read, items, ended, status`` of ``pages(source_id, start, got, done)``: captures of a list from an offset on, how many items
    each gave, and whether it said to be the last.

    A page follows where the one before ended; the chain is whole when a page gave nothing or said that it was the last. A chain that breaks
    off, or has more than ``most`` pages, is degraded: its end was not seen.
    """
    w = Window.partitionBy("source_id").orderBy("start")
    seen = pages.groupBy("source_id", "start").agg(F.max("got").alias("got"), F.bool_or("done").alias("done"))
    seen = seen.withColumns({"nth": F.row_number().over(w), "expected": F.coalesce(F.lag(F.col("start") + F.col("got")).over(w), F.lit(0)), "over": F.coalesce(F.lag((F.col("got") == 0) | F.coalesce("done", F.lit(False))).over(w), F.lit(False))})
    on = (F.col("start") == F.col("expected")) & ~F.col("over") & (F.lit(True) if most is None else F.col("nth") <= most)
    chain = seen.withColumn("on", on).withColumn("on", F.min("on").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ended = F.coalesce(F.bool_or(F.col("on") & ((F.col("got") == 0) | F.coalesce("done", F.lit(False)))), F.lit(False))
    counts = chain.groupBy("source_id").agg(F.count_if("on").alias("read"), F.coalesce(F.sum(F.when(F.col("on"), F.col("got"))), F.lit(0)).alias("items"), ended.alias("ended"))
    return counts.withColumn("status", bounded_status(F.col("read"), F.when(F.col("ended"), 0).otherwise(1)))


def bounded_status(read: Column, missing: Column) -> Column:
    """Failed where nothing was read, degraded where something is missing."""
    return F.when((read == 0) & (missing > 0), "failed").when(missing > 0, "degraded").otherwise("healthy")


def search_status(bronze: DataFrame, max_pages: int = 10) -> DataFrame:
    """How much of a search API's pages was captured, as ``numbered_pages`` tells it: a search of more pages than are read is degraded."""
    page = bronze.select("source_id", F.from_json("body", "current_page int, last_page int").alias("p"))
    return numbered_pages(page.select("source_id", F.col("p.current_page").alias("page"), F.col("p.last_page").alias("last")), max_pages)


def parse_sitemap(bronze: DataFrame, slug_pattern: str = ".") -> DataFrame:
    """Distinct ``<loc>`` links whose last segment matches."""
    df = bronze.select("source_id", F.explode(F.regexp_extract_all("body", F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), 1)).alias("url")).distinct()
    return df.where(F.regexp_extract(F.regexp_replace("url", "/+$", ""), r"([^/]*)$", 1).rlike(slug_pattern))


def parse_listing(bronze: DataFrame, pattern: str, url_group: int, title_group: int, base: str) -> DataFrame:
    """Link and title by a pattern over a listing page; the first of each url, in page order."""
    df = bronze.select("source_id", F.posexplode(F.arrays_zip(F.regexp_extract_all("body", F.lit(pattern), url_group).alias("u"), F.regexp_extract_all("body", F.lit(pattern), title_group).alias("t"))).alias("pos", "x"))
    url = F.when(F.col("x.u").rlike("^https?://"), F.col("x.u")).otherwise(F.concat(F.lit(base), F.regexp_replace("x.u", "^/*", "/")))
    df = df.select("source_id", "pos", url.alias("url"), C.squeeze(C.strip(C.html_text(F.col("x.t")))).alias("title")).where("title <> ''")
    first = df.groupBy("source_id", "url").agg(F.min(F.struct("pos", "title")).alias("f"))
    return first.select("source_id", "url", F.col("f.title").alias("title"), F.col("f.pos").alias("pos"))


def next_data(body: Column, schema: str) -> Column:
    """The page's embedded application state."""
    return F.from_json(F.regexp_extract(body, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1), schema)


def attribute_json(body: Column, attribute: str, schema: str) -> Column:
    """JSON held, escaped, in an attribute."""
    return F.from_json(unescape(F.regexp_extract(body, rf'(?s){attribute}="([^"]*)"', 1)), schema)


def union_results(*parts: DataFrame) -> DataFrame:
    """One table of the parsers' outputs; columns that a parser lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def source_status(scanned: Column, errors: Column) -> Column:
    """failed with errors and nothing read, degraded with errors and something, else healthy."""
    n = F.size(F.coalesce(errors, F.array().cast("array<string>")))
    return F.when((n > 0) & (scanned == 0), "failed").when(n > 0, "degraded").otherwise("healthy")


def ranked_csv(bronze: DataFrame, schema: str, period: str, rank: str) -> DataFrame:
    """Lines of a CSV body (header skipped) of the latest period, by rank."""
    from jobloom.operators.watchlist import latest_period

    lines = F.split(C.strip(F.col("body")), r"\r?\n")
    lines = bronze.select(F.explode(F.slice(lines, 2, F.size(lines))).alias("line"))
    rows = lines.select(F.from_csv("line", schema).alias("r")).select("r.*")
    return latest_period(rows, period).orderBy(rank)
