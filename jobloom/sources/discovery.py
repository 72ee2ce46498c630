"""Whether a company's own careers page shows platform or mobile hiring, told from captured attempts.

``attempts(url, status, body)`` is what was fetched: status 200 with a body, or a refusal, which is not tried again. The way from a company
to its careers page is a chain of joins with the attempts; a company whose way ends keeps its state and takes no further part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators import watchlist
from jobloom.plans.storage import stash
from jobloom.sources import cards, html

# --- fixed values: words of hiring, hosts that are no company site, pages that only talk about careers
IOS = r"(?iu)(?<![a-z0-9])(?:ios|swift|swiftui|iphone|ipad|objective[- ]?c)(?![a-z0-9])"
MOBILE = r"(?iuU)(?<![a-zа-яіїєґ0-9])(?:mobile|android|flutter|react[ -]?native|kotlin multiplatform|kmm|мобільн\w*|мобильн\w*)(?![a-zа-яіїєґ0-9])"
MOBILE_STACK = ("android", "flutter", "react native", "react-native", "reactnative", "kmm", "kotlin multiplatform")
SKIPPED_SITES = ("dou.ua", "facebook.com", "linkedin.com", "instagram.com", "t.me")
NOT_CAREERS = r"(?:event|webinar|course|lesson|/blog|/news)"
LEAST_TEXT, EXTRA_PAGES = 400, 5
PROFILE = "https://jobs.dou.ua/companies/"


def page_text(body: Column) -> Column:
    """What a reader of the page sees, in one line."""
    hidden = F.regexp_replace(C.text(body), r"(?is)<(script|style|noscript|svg)\b.*?</\1\s*>", " ")
    return C.strip(C.squeeze(C.html_text(hidden)))


def _found(text: Column, pattern: str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), F.lower)))


def signals(text: Column) -> Column:
    """Sorted distinct words of platform and of mobile hiring."""
    return F.struct(_found(text, IOS).alias("ios"), _found(text, MOBILE).alias("mobile"))


def verdict(found: Column) -> Column:
    return F.when(F.size(found["ios"]) > 0, "ios").when(F.size(found["mobile"]) > 0, "mobile").otherwise("none")


def strength(state: Column, career: Column, listed: Column) -> Column:
    """``ios`` or ``mobile_stack`` for a readable careers page with a strong signal there or among the listed vacancies, else null."""
    words = lambda x, part: F.coalesce(x[part], F.array().cast("array<string>"))
    ios = F.concat(words(career, "ios"), words(listed, "ios"))
    stack = F.arrays_overlap(F.concat(words(career, "mobile"), words(listed, "mobile")), F.array(*[F.lit(w) for w in MOBILE_STACK]))
    return F.when(state == "read", F.when(F.size(ios) > 0, "ios").when(stack, "mobile_stack"))


def _host(url: Column) -> Column:
    return C.host_of(C.authority(url))


def _bare(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))


def inspect(companies: DataFrame, attempts: DataFrame) -> DataFrame:
    """``slug, listed, career_url, career_state, career, strength`` of ``companies(slug, has_vacancies)``.

    States: ``no_site``, ``unreadable`` (the site or its careers page refused), ``career_not_found``, ``on_dou``, ``read``, and
    ``js_rendered`` where a read page shows too little text to judge. Further pages of a careers page without any signal are read up to the
    first that shows platform hiring; those that refused are passed over. One row an attempted url is taken, the first by status.
    """
    c = F.col
    tried = stash(attempts.groupBy("url").agg(F.min(F.struct("status", "body")).alias("a")).select("url", "a.status", "a.body"), "attempts")
    read = lambda out: tried.select(F.col("url").alias("_url"), F.when(F.col("status") == 200, F.coalesce("body", F.lit(""))).alias(out))
    follow = lambda df, url, out: df.join(read(out), url == F.col("_url"), "left").drop("_url")

    profile = F.concat(F.lit(PROFILE), "slug", F.lit("/"))
    df = follow(companies.select("slug", "has_vacancies"), F.when(c("has_vacancies"), F.concat(profile, F.lit("vacancies/"))), "vacancies")
    listed = F.when(c("vacancies").isNotNull(), signals(F.concat_ws(" ", cards.inners(c("vacancies"), "a", "vt"))))
    df = follow(df.withColumn("listed", listed).drop("vacancies"), profile, "profile").withColumn("site", cards.company_site(c("profile"))).drop("profile")
    df = df.withColumn("state", F.when(c("site").isNull() | C.on_host(_host(c("site")), SKIPPED_SITES), "no_site"))
    df = stash(follow(df, F.when(c("state").isNull(), c("site")), "home").withColumn("state", F.coalesce("state", F.when(c("home").isNull(), "unreadable"))), "homes")

    anchors = df.where("state IS NULL").select("slug", "site", F.explode(html.page_links(c("home"))).alias("x")).select("slug", "site", C.strip("x.href").alias("href"), F.col("x.text").alias("label"))
    anchors = anchors.where((C.text(c("href")) != "") & ~c("href").rlike("^(mailto:|tel:|javascript:)"))
    anchors = C.once(anchors, "url", html.absolute(c("site"), c("href"))).select("slug", "url", "label").where(c("url").rlike("(?i)^https?:"))
    best = watchlist.best_link(anchors, "slug", watchlist.candidate_score(c("url"), c("label")), "url").select("slug", F.col("url").alias("found"))
    df = df.join(best, "slug", "left").withColumn("career_url", F.when(c("state").isNull(), F.when(watchlist.candidate_score(c("site"), F.lit("")) >= 50, c("site")).otherwise(c("found"))))
    path = F.regexp_extract(c("career_url"), r"^[^:]*:(?://[^/?#]*)?([^?#]*)", 1)
    lost = c("career_url").isNull() | path.isin("", "/") | C.matches(c("career_url"), NOT_CAREERS)
    df = df.withColumn("state", F.coalesce("state", F.when(lost, "career_not_found").when(_host(c("career_url")).endswith("dou.ua"), "on_dou")))
    home = _bare(c("career_url")) == _bare(c("site"))
    df = follow(df, F.when(c("state").isNull() & ~home, c("career_url")), "page").withColumn("page", F.when(c("state").isNull(), F.when(home, c("home")).otherwise(c("page"))))
    df = df.withColumn("state", F.coalesce("state", F.when(c("page").isNull(), "unreadable"))).drop("home", "site", "found")
    df = stash(df.withColumn("text", page_text(c("page"))).withColumn("own", signals(c("text"))), "careers")

    silent = df.where(c("state").isNull() & (verdict(c("own")) == "none"))
    more = cards.extra_pages(silent.select(c("slug").alias("source_id"), c("career_url").alias("url"), c("page").alias("body")), EXTRA_PAGES)
    more = follow(more.select(c("source_id").alias("slug"), "next", "rank"), c("next"), "page").where("page IS NOT NULL")
    more = stash(more.select("slug", "rank", page_text(c("page")).alias("text")).withColumn("own", signals(c("text"))), "extra")
    until = more.where(F.size("own.ios") > 0).groupBy("slug").agg(F.min("rank").alias("until"))
    more = more.join(until, "slug", "left").where(c("until").isNull() | (c("rank") <= c("until")))
    words = lambda part: F.flatten(F.collect_list(f"own.{part}")).alias(part)
    more = more.groupBy("slug").agg(words("ios"), words("mobile"), F.sum(F.length("text") + 1).alias("extra"))
    none = F.array().cast("array<string>")
    df = df.join(more, "slug", "left")
    all_of = lambda part: F.array_sort(F.array_distinct(F.concat(c(f"own.{part}"), F.coalesce(part, none)))).alias(part)
    shown = F.length("text") + F.coalesce("extra", F.lit(0)) >= LEAST_TEXT
    df = df.withColumn("career_state", F.coalesce("state", F.when(shown, "read").otherwise("js_rendered")))
    df = df.withColumn("career", F.when(c("career_state") == "read", F.struct(all_of("ios"), all_of("mobile"))))
    url = F.when(c("career_state").isin("read", "js_rendered"), c("career_url"))
    return df.select("slug", "listed", url.alias("career_url"), "career_state", "career", strength(c("career_state"), c("career"), c("listed")).alias("strength"))


def watchlist_entries(companies: DataFrame, inspected: DataFrame, readings: DataFrame) -> DataFrame:
    """Rows to add to the watchlist: companies with a ``strength`` whose careers page the watchlist's own reader could read.

    ``companies(slug, name)``, ``readings(source_id, status, items_scanned)`` of a trial run under the watchlist's source id. A page that
    fails or gives nothing would stay degraded for ever and is left out.
    """
    c = F.col
    good = readings.where("status <> 'failed' AND items_scanned > 0").select(F.regexp_extract("source_id", "(?s)^company-watchlist:(.*)$", 1).alias("slug")).distinct()
    df = inspected.where("strength IS NOT NULL").join(good, "slug", "left_semi").join(companies.select("slug", "name"), "slug")
    none = lambda kind: F.lit(None).cast(kind)
    return df.select(
        F.coalesce(F.nullif("name", F.lit("")), "slug").alias("name"), "slug", none("double").alias("rating_score"), none("double").alias("compensation_score"), none("int").alias("survey_count"), F.concat(F.lit(PROFILE), "slug", F.lit("/")).alias("dou_company_url"),
        none("string").alias("company_site_url"), c("career_url"), F.lit("discovery").alias("career_url_source"), F.lit(True).alias("enabled"),
    )


#: Where each system's board lists its postings, and the field of their title.
BOARD_LISTS = {"greenhouse": ("$.jobs", "title"), "lever": ("$", "text"), "workable": ("$.jobs", "title"), "ashby": ("$.jobs", "title"), "recruitee": ("$.offers", "title"), "breezy": ("$", "name")}


def board_titles(ats: Column, body: Column) -> Column:
    """The titles on a board, '' for a posting without one; null where the body is no board of that system."""
    board, out = F.try_parse_json(body), F.lit(None).cast("array<string>")
    for name, (path, field) in BOARD_LISTS.items():
        items = F.try_variant_get(board, path, "array<variant>")
        items = items if path == "$" else F.when(F.schema_of_variant(board).startswith("OBJECT"), F.coalesce(items, F.array().cast("array<variant>")))
        out = F.when(ats == name, F.transform(items, lambda x: C.text(F.try_variant_get(x, f"$.{field}", "string")))).otherwise(out)  # noqa: B023
    return out


def discovered_boards(candidates: DataFrame, answers: DataFrame) -> DataFrame:
    """``slug, ats, token, evidence, jobs, ios_titles, sample_titles``: the boards that companies turn out to have.

    ``candidates(slug, nth, ats, token, evidence)`` are tried in order, ``answers(ats, token, body)`` is what the boards gave, no row or a
    null body where they refused. A board counts once a company, whatever the case of its token, under the first candidate that answers; an empty
    board counts only where the company's page names it, since some systems give one for any guess.
    """
    c = F.col
    boards = answers.groupBy("ats", "token").agg(F.max("body").alias("body")).select("ats", "token", board_titles(c("ats"), c("body")).alias("titles")).where("titles IS NOT NULL")
    hits = candidates.join(boards, ["ats", "token"]).where((F.size("titles") > 0) | (c("evidence") != "slug-guess"))
    first = hits.groupBy("slug", "ats", F.lower("token").alias("low")).agg(F.min_by(F.struct("token", "evidence", "titles"), "nth").alias("b"))
    titles = c("b.titles")
    return first.select("slug", "ats", "b.token", "b.evidence", F.size(titles).alias("jobs"), F.slice(F.filter(titles, lambda t: C.is_platform_job(t)), 1, 10).alias("ios_titles"), F.slice(titles, 1, 5).alias("sample_titles"))
