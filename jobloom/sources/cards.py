"""Listing pages whose postings are cards: markup cut at each card's opening tag, and fields read by patterns.

A source is a row of ``CARD_SOURCES``: the opening tag of a card, where the markup is within the captured body, and
Column-valued fields. Everything is built-in expressions over ``bronze(source_id, url, body)``; several pages of a source
are rows with a ``page`` number, and the first card of each key counts, by page and then by place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions.entities import unescape
from jobloom.sources import feeds, html


def opening(tag: str, css_class: str) -> str:
    """A pattern for an opening tag that has a class."""
    return rf"<{tag}\b[^>]*\bclass=[\"'](?:[^\"']*\s)?{css_class}(?:\s[^\"']*)?[\"'][^>]*>"


def inner(card: Column, tag: str, css_class: str | None = None) -> Column:
    """The text of the first such element of a card, '' where there is none."""
    start = opening(tag, css_class) if css_class else rf"<{tag}\b[^>]*>"
    return tidy(F.regexp_extract(card, rf"(?is){start}(.*?)</{tag}\s*>", 1))


def inners(card: Column, tag: str, css_class: str | None = None) -> Column:
    """The texts of all such elements, in order, blank ones left out."""
    start = opening(tag, css_class) if css_class else rf"<{tag}\b[^>]*>"
    return F.filter(F.transform(F.regexp_extract_all(card, F.lit(rf"(?is){start}(.*?)</{tag}\s*>"), 1), tidy), lambda x: x != "")


def tidy(markup: Column) -> Column:
    return C.squeeze(C.strip(C.html_text(markup)))


def attribute(markup: Column, name: str) -> Column:
    """The first value of an attribute, its entities decoded."""
    return C.strip(unescape(F.regexp_extract(markup, rf"(?is)\s{name}=[\"']([^\"']*)[\"']", 1)))


def resolve(href: Column, base: str) -> Column:
    """An absolute link: links with a scheme stay, ``//host`` and ``/path`` take what they lack from ``base``, others stand below it."""
    scheme, _, rest = base.partition("://")
    root = f"{scheme}://{rest.split('/')[0]}"
    folder = base if base.endswith("/") else base[: base.rfind("/") + 1] if "/" in rest else base + "/"
    return F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href).when(href.startswith("//"), F.concat(F.lit(scheme + ":"), href)).when(href.startswith("/"), F.concat(F.lit(root), href)).otherwise(F.concat(F.lit(folder), href))


@dataclass(frozen=True)
class CardSource:
    """``fields`` of a card: title, href and optional description, location, remote, key (what repeats are told by, the url
    if not given). ``keep`` is a pattern that the absolute link must match; ``gate`` may look at more than title and description."""

    card: str
    base: str
    fields: Callable[[Column], dict[str, Column]]
    body: Callable[[Column], Column] = field(default=lambda b: b)
    keep: str = "^https?://"
    gate: Callable[[dict[str, Column]], Column] = field(default=lambda f: C.is_target_job(f["title"], f["description"]))


def _numbered(bronze: DataFrame) -> DataFrame:
    return bronze if "page" in bronze.columns else bronze.withColumn("page", F.lit(0))


def cards(bronze: DataFrame, source: CardSource) -> DataFrame:
    """``source_id, url, title, description, location, remote``: the first card of each key, on topic or not."""
    cut = F.filter(F.split(source.body(F.col("body")), f"(?is)(?={source.card})"), lambda x: x.rlike(f"(?is)^{source.card}"))
    df = _numbered(bronze).select("source_id", "page", F.posexplode(cut).alias("pos", "card"))
    none = F.lit(None).cast("string")
    fields = {"description": none, "location": none, "remote": none} | source.fields(F.col("card"))
    df = C.once(df, "f", F.struct(*[v.alias(k) for k, v in fields.items()])).select("source_id", F.struct("page", "pos").alias("at"), "f.*")
    df = C.once(df, "url", resolve(F.col("href"), source.base))
    df = df.where((F.col("href") != "") & F.col("url").rlike(source.keep))
    key = "key" if "key" in df.columns else "url"
    first = df.groupBy("source_id", F.col(key).alias("key")).agg(F.min_by(F.struct("url", "title", "description", "location", "remote"), "at").alias("f"))
    return first.select("source_id", "f.*")


def parse_cards(bronze: DataFrame, source: CardSource, company: str) -> DataFrame:
    """Postings of a source's cards that are on topic."""
    df = cards(bronze, source)
    on_topic = source.gate({c: F.col(c) for c in df.columns})
    return df.where((F.col("title") != "") & on_topic).select("source_id", F.lit(company).alias("company"), "title", "url", "location", "remote", "description")


def page_status(bronze: DataFrame, declared: Column, source: CardSource) -> DataFrame:
    """``source_id, scanned, missing, status`` of paged listings: how many distinct cards were read, which pages of the number
    that the first one declares were not captured, and so whether the source is healthy, degraded or failed."""
    pages = _numbered(bronze)
    want = pages.where("page <= 1").select("source_id", F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce(declared, F.lit(1)), F.lit(1)))).alias("page"))
    have = pages.where("body IS NOT NULL").select("source_id", F.greatest("page", F.lit(1)).alias("page")).distinct()
    lost = want.join(have, ["source_id", "page"], "left_anti").groupBy("source_id").agg(F.array_sort(F.collect_set("page")).alias("missing"))
    read = cards(bronze, source).groupBy("source_id").agg(F.count("*").alias("scanned"))
    df = pages.select("source_id").distinct().join(read, "source_id", "left").join(lost, "source_id", "left").na.fill(0, ["scanned"])
    missing = F.coalesce("missing", F.array().cast("array<int>"))
    return df.select("source_id", "scanned", missing.alias("missing"), feeds.source_status(F.col("scanned"), missing).alias("status"))


def usable_captures(attempts: DataFrame, blocked: tuple[int, ...] = (403, 429, 454)) -> DataFrame:
    """``attempts(source_id, url, attempt, status, body)`` -> the captured body of each url: the first attempt that was not
    refused, or null where all were; an attempt that failed otherwise ends the search."""
    tried = F.when(F.col("status").isin(*blocked), None).otherwise(F.struct("attempt", "status", "body"))
    first = attempts.groupBy("source_id", "url").agg(F.min(tried).alias("a"))
    return first.select("source_id", "url", F.when(F.col("a.status") == 200, F.col("a.body")).alias("body"), F.col("a.status").alias("status"))


def _unique_join(values: Column, by: str) -> Column:
    return F.nullif(F.array_join(F.array_distinct(values), by), F.lit(""))


def _slug_title(href: Column, drop: str) -> Column:
    return C.strip(F.regexp_replace(C.title_from_slug(href), f"(?i){drop}", ""))


def _tech_or_title(card: Column) -> dict[str, Column]:
    tech = F.array_join(inners(F.regexp_extract(card, r"(?is)(<div\b[^>]*vacancy-card-new__technologies.*?</div>)", 1), "span"), " ")
    title = inner(card, "h3", "vacancy-card-new__title")
    return {"title": C.let(title, lambda t: F.when(t == "", tech).otherwise(t)), "href": attribute(card, "href"), "description": C.let(tech, lambda t: F.nullif(t, F.lit("")))}


def _box(card: Column) -> dict[str, Column]:
    heading, whole = inner(card, "h4"), tidy(F.regexp_extract(card, r"(?is)^(.*?)</a\s*>", 1))
    title = C.strip(F.regexp_replace(C.let(heading, lambda h: F.when(h == "", whole).otherwise(h)), r"\s+IRC\d+\s*$", ""))
    any_of = lambda name: _unique_join(F.concat(*[inners(card, t, name) for t in ("span", "div", "p")]), ", " if name == "job_location" else " ")
    return {"title": title, "href": attribute(card, "href"), "location": any_of("job_location"), "remote": any_of("job_tag")}


def _bookmarked(card: Column) -> dict[str, Column]:
    """Title from the heading or else the card's own words; place from the bookmark's JSON, then from a node named for it."""
    raw, heading = tidy(F.regexp_extract(card, r"(?is)^(.*?)</a\s*>", 1)), inner(card, "h2")
    meta = F.from_json(unescape(F.regexp_extract(card, r"(?is)\sdata-job=(?:\"([^\"]*)\"|'([^']*)')", 1)), "city string, location string")
    place = F.nullif(F.array_join(F.filter(F.array(C.strip(C.text(meta["city"])), C.strip(C.text(meta["location"]))), lambda x: x != ""), ", "), F.lit(""))
    node = F.nullif(tidy(F.regexp_extract(card, r"(?is)<(\w+)\b[^>]*\bclass=[\"'][^\"']*location[^\"']*[\"'][^>]*>(.*?)</\1\s*>", 2)), F.lit(""))
    filled = lambda x: C.let(x, lambda v: F.nullif(v, F.lit("")))
    words = lambda raw: C.strip(F.regexp_replace(F.get(F.split(raw, r"\s+Facebook\s+", 2), 0), r"(?i)\s+iOS\s*\(Objective-C/Swift\).*$", ""))
    title = lambda raw: F.coalesce(filled(heading), filled(words(raw)), C.title_from_slug(attribute(card, "href")))
    short = lambda x: F.coalesce(filled(C.strip(F.get(F.split(x["raw"], " iOS ", 2), 0))), x["title"])
    shown = lambda x: F.when(C.is_target_job(x["title"]), x["title"]).otherwise(F.when(C.is_target_job(x["raw"]), short(x)).otherwise(x["title"]))
    return {"title": C.let(raw, lambda r: C.let(F.struct(r.alias("raw"), title(r).alias("title")), shown)), "href": attribute(card, "href"), "location": F.coalesce(place, node), "description": raw}


#: Shapes of card listings, by what tells them apart.
CARD_SOURCES: dict[str, CardSource] = {
    # pages of fragments behind a first page that declares how many there are
    "paged_fragments": CardSource(opening("div", "one-vacancy"), "http://mobilunity.com/vacancy/", lambda x: {"title": inner(F.regexp_extract(x, r"(?is)(<h5\b.*?</h5\s*>)", 1), "a"), "href": attribute(F.regexp_extract(x, r"(?is)<h5\b[^>]*>(.*?)</h5\s*>", 1), "href"), "description": F.nullif(inner(x, "div", "svacancy-excerpt"), F.lit("")), "location": F.nullif(attribute(F.regexp_extract(x, r"(?is)vacancy-country.*?(<img\b[^>]*>)", 1), "alt"), F.lit(""))}, keep=r"^https?://mobilunity\.com/vacancy/."),
    # fragments inside JSON, gated by the title or the technologies
    "json_fragments": CardSource(opening("a", "vacancy-card-new"), "https://career.sigma.software/", _tech_or_title, lambda b: F.get_json_object(F.when(F.get_json_object(b, "$.success") == "true", b), "$.data.html"), gate=lambda f: C.is_target_job(f["title"]) | C.is_target_job(C.text(f["description"]))),
    "job_boxes": CardSource(opening("a", "job_box"), "https://www.globallogic.com/", _box, keep=r"(?i)/ua/careers/.*-irc"),
    "bookmarked": CardSource(r"<a\b[^>]*\bhref=[\"'][^\"']*/jobs/[a-z0-9-]+-\d+/?[^>]*>", "https://career.luxoft.com/", _bookmarked),
    # repeats are told by the position's name, the last but one segment of its link
    "positions": CardSource(opening("a", "comeet-position"), "https://jobs.mwdn.com/", lambda x: {"title": F.coalesce(*[F.nullif(inner(x, t, "comeet-position-name"), F.lit("")) for t in ("div", "span", "h3")], C.title_from_slug(attribute(x, "href"))), "href": attribute(x, "href"), "key": F.element_at(F.split(F.regexp_replace(attribute(x, "href"), "/+$", ""), "/+"), -2)}),
}


def slug_fallback(bronze: DataFrame, found: DataFrame, link: str, drop: str, company: str) -> DataFrame:
    """``found`` and, for sources that have no posting in it, the links that match ``link`` anywhere in the body, titled by their slugs."""
    df = bronze.join(found.select("source_id").distinct(), "source_id", "left_anti").select("source_id", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(f"(?i)({link})"), 1))).alias("url"))
    df = df.distinct().withColumn("title", _slug_title(F.col("url"), drop)).where(C.is_target_job(F.col("title")))
    return found.unionByName(df.withColumn("company", F.lit(company)), allowMissingColumns=True)


#: Country codes that detail pages use.
COUNTRY_NAMES = {"MY": "Malaysia", "IN": "India", "EG": "Egypt", "PL": "Poland", "UA": "Ukraine", "DE": "Germany", "RO": "Romania", "BG": "Bulgaria", "PT": "Portugal", "MX": "Mexico", "US": "United States", "GB": "United Kingdom", "UK": "United Kingdom"}


def locations_from_details(postings: DataFrame, details: DataFrame) -> DataFrame:
    """``postings`` with the place of their captured detail page (``details(url, body)``) where they name none: the first
    JSON-LD posting's place, its country code written out."""
    names = F.create_map(*[F.lit(x) for pair in COUNTRY_NAMES.items() for x in pair])
    data = details.select("url", F.posexplode(html.page_postings(F.col("body"))).alias("pos", "d")).where("d.location IS NOT NULL")
    first = data.groupBy("url").agg(F.min_by("d.location", "pos").alias("place"))
    parts = F.split("place", ", ")
    named = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(names, F.upper(p)), p)), ", ")
    df = postings.join(first.select("url", named.alias("_place")), "url", "left")
    return df.withColumn("location", F.coalesce("location", "_place")).drop("_place").select(*postings.columns)


# --- tables and indexes in pages

#: The size bands of large companies.
LARGE_BANDS = ("1500+", "800-1500", "200-800")


def ratings_table(bronze: DataFrame) -> DataFrame:
    """Companies of a ratings page with the size heading above them; rows of other bands, or above any heading, are out."""
    from jobloom.operators.watchlist import carry_forward

    rows = bronze.select("source_id", F.posexplode(F.filter(F.split("body", r"(?i)(?=<tr\b)"), lambda r: r.rlike(r"(?i)^<tr\b"))).alias("pos", "row"))
    head = F.regexp_extract("row", r"(?is)(<h3\b[^>]*\bid=[^>]*>.*?</h3\s*>)", 1)
    band = F.struct(F.regexp_replace(attribute(head, "id"), "[—–]", "-").alias("band"), tidy(head).alias("label"))
    rows = carry_forward(rows.withColumn("heading", F.when(head != "", band)), "source_id", "pos", "heading").where(F.col("heading").isNull() & F.col("carried.band").isin(*LARGE_BANDS))
    cell = F.regexp_extract("row", rf"(?is){opening('td', 'company-name')}(.*?)</td\s*>", 1)
    href = attribute(cell, "href")
    score = F.regexp_extract("row", rf"(?is)({opening('div', 'score all')}.*?</div\s*>)", 1)
    scores = inners(F.col("row"), "div", "score")
    df = rows.select(
        "source_id", "pos", inner(cell, "a").alias("name"), F.lower(F.regexp_extract(href, r"/companies/([^/]+)/poll/?", 1)).alias("slug"), F.col("carried.band").alias("size_band"), F.nullif(F.col("carried.label"), F.lit("")).alias("size_label"),
        F.coalesce(F.nullif(attribute(score, "title"), F.lit("")), tidy(score)).alias("rating_score"), F.get(scores, 1).alias("compensation_score"), F.regexp_extract(F.coalesce(*[F.nullif(inner(F.col("row"), t, "count"), F.lit("")) for t in ("span", "div", "td")]), r"(\d+)", 1).alias("survey_count"), F.regexp_replace(href, "poll/?$", "").alias("company_url"),
    )
    cast = {"rating_score": "double", "compensation_score": "double", "survey_count": "int"}
    return df.where((F.col("name") != "") & (F.col("slug") != "")).withColumns({c: F.expr(f"try_cast({c} AS {t})") for c, t in cast.items()})


def band_counts(companies: DataFrame) -> DataFrame:
    return companies.groupBy("size_band").agg(F.count("*").alias("companies"))


CARD_LINK = r'<a class="cn-a" href="https://jobs\.dou\.ua/companies/([a-z0-9-]+)/">([^<]+)</a>'


def catalogue_index(bronze: DataFrame) -> DataFrame:
    """Companies of a catalogue's pages, the first of each slug: of cards with a site block, which also hold the number of
    vacancies, or of bare links on pages of a source without any such card."""
    site = r'((?:(?!<div class="site">)[\s\S])*)<div class="site">([\s\S]*?)</div>'
    at = lambda pattern, g: F.regexp_extract_all("body", F.lit(f"(?i){pattern}"), g)
    zipped = F.arrays_zip(at(CARD_LINK + site, 1).alias("s"), at(CARD_LINK + site, 2).alias("n"), at(CARD_LINK + site, 4).alias("b"))
    bare = F.arrays_zip(at(CARD_LINK, 1).alias("s"), at(CARD_LINK, 2).alias("n"), F.transform(at(CARD_LINK, 1), lambda _: F.lit("")).alias("b"))
    df = _numbered(bronze).select("source_id", "page", F.posexplode(F.when(F.size(zipped) > 0, zipped).otherwise(bare)).alias("pos", "x"))
    slug, count = F.lower("x.s"), F.regexp_extract("x.b", r'(?i)/vacancies/[^"]*"><span>Вакансії</span>\s*(\d*)', 1)
    row = F.struct(C.strip(unescape(F.col("x.n"))).alias("name"), F.coalesce(F.nullif(count, F.lit("")).cast("int"), F.lit(0)).alias("vacancy_count"))
    first = df.groupBy("source_id", slug.alias("slug")).agg(F.min_by(row, F.struct("page", "pos")).alias("r"))
    return first.select("source_id", "slug", "r.name", "r.vacancy_count", F.concat(F.lit("https://jobs.dou.ua/companies/"), "slug", F.lit("/vacancies/")).alias("vacancies_url"))


def catalogue_seed(seed: DataFrame) -> DataFrame:
    """Rows of a stored catalogue; those without a slug are dropped, a missing name is the slug."""
    slug = F.lower(C.strip(C.text(F.col("slug"))))
    return seed.withColumn("slug", slug).where("slug <> ''").withColumn("name", F.coalesce(F.nullif(C.strip(C.text(F.col("name"))), F.lit("")), "slug"))


ANCHOR = r'<a[^>]+href="([^"]+)"[^>]*>\s*([^<]+)\s*</a>'
JOB_TOKENS = r"vacanc|job|career|position|opening"


def plain_careers(bronze: DataFrame, company: str) -> DataFrame:
    """Links of a plain careers page that are on topic by their text or address and look like a posting's, the first of each."""
    both = F.arrays_zip(F.regexp_extract_all("body", F.lit(f"(?is){ANCHOR}"), 1).alias("u"), F.regexp_extract_all("body", F.lit(f"(?is){ANCHOR}"), 2).alias("t"))
    df = bronze.select("source_id", F.col("url").alias("page_url"), F.posexplode(both).alias("pos", "x"))
    df = df.select("source_id", "pos", C.strip(unescape(F.col("x.t"))).alias("title"), C.strip(unescape(F.col("x.u"))).alias("href"), "page_url").where((F.col("title") != "") & (C.is_platform_job(F.col("title")) | C.is_platform_job(F.col("href"))))
    df = df.withColumn("url", html.absolute(F.col("page_url"), F.col("href"))).where(F.col("url").rlike("(?i)^http") & C.matches(F.col("url"), JOB_TOKENS))
    return df.groupBy("source_id", "url").agg(F.min_by("title", "pos").alias("title")).select("source_id", F.lit(company).alias("company"), "title", "url")


def company_site(profile: Column) -> Column:
    """The outside link of a company's profile page, null where it has none."""
    return F.nullif(C.strip(unescape(F.regexp_extract(profile, r'(?is)<div class="site">\s*<a href="([^"]+)" target="_blank" rel="nofollow">', 1))), F.lit(""))


PAGE_LINK = r"(?:/page/\d+/?$|[?&](?:page|p)=\d+)"
LIST_LINK = r"(?:vacanc|open[ -]?(?:position|role)|all[ -]?(?:jobs|positions|vacancies)|job[ -]?openings|вакансі|вакансии|відкриті|открытые)"


def extra_pages(bronze: DataFrame, limit: int = 5) -> DataFrame:
    """Further pages of the same host to read: ``source_id, url, next, rank``, the first list link and then pagination, at most
    ``limit`` a source. The limit is the feature: a crawl's budget."""
    from pyspark.sql import Window

    links = C.once(bronze.select("source_id", "url", F.explode(html.page_links(F.col("body"))).alias("x")), "next", html.absolute(F.col("url"), F.col("x.href"))).select("source_id", "url", "x.pos", "x.text", "next")
    bare = lambda u: F.regexp_replace(F.regexp_replace(u, "#.*$", ""), "/+$", "")
    links = links.where((C.host_of(F.regexp_extract("next", "^[^:]*://([^/?#]*)", 1)) == C.host_of(F.regexp_extract("url", "^[^:]*://([^/?#]*)", 1))) & (bare(F.col("next")) != bare(F.col("url"))))
    kind = F.when(C.matches(F.col("next"), PAGE_LINK), 1).when(C.matches(F.concat_ws(" ", "next", "text"), LIST_LINK), 0)
    first = C.once(links, "kind", kind).where("kind IS NOT NULL").groupBy("source_id", "url", "next").agg(F.min(F.struct("kind", "pos")).alias("at"))
    lists = F.row_number().over(Window.partitionBy("source_id", "url", "at.kind").orderBy("at.pos"))
    rank = F.row_number().over(Window.partitionBy("source_id", "url").orderBy("at.kind", "at.pos"))
    kept = first.withColumn("_n", lists).where("at.kind = 1 OR _n = 1").withColumn("rank", rank).where(F.col("rank") <= limit)
    return kept.select("source_id", "url", "next", "rank")
