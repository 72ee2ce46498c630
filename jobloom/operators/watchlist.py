"""Company dimension tables: overrides, merges, precedence and top-n selections."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C

ATS = ("greenhouse", "lever", "ashby", "breezy", "recruitee", "workable")


def ats_boards(boards: DataFrame) -> DataFrame:
    """``(slug, ats, token)`` of supported systems with a token; others are dropped, never fatal."""
    return boards.where(F.lower("ats").isin(*ATS) & (C.strip(C.text(F.col("token"))) != "")).select("slug", F.lower("ats").alias("ats"), C.strip(F.col("token")).alias("token"))


def build_registry(bespoke: DataFrame, watchlist: DataFrame, boards: DataFrame) -> DataFrame:
    """Sources to read: bespoke ones, enabled watchlist companies that are not bespoke, and boards of neither.

    A disabled watchlist company also switches its bespoke reader off; one that is not listed is on.
    """
    enabled = watchlist.select("slug", F.coalesce("enabled", F.lit(True)).alias("enabled"))
    own = bespoke.select("slug").join(enabled, "slug", "left").where(F.coalesce("enabled", F.lit(True))).select("slug", F.lit("bespoke").alias("kind"))
    listed = enabled.where("enabled").join(bespoke.select("slug"), "slug", "left_anti").select("slug", F.lit("watchlist").alias("kind"))
    rest = boards.select("slug").join(bespoke.select("slug"), "slug", "left_anti").join(watchlist.select("slug"), "slug", "left_anti").select("slug", F.lit("board").alias("kind"))
    return own.unionByName(listed).unionByName(rest)


def route(watchlist: DataFrame, boards: DataFrame) -> DataFrame:
    """How each company is read: failed without a link, by its board, or by its page."""
    df = watchlist.join(boards, "slug", "left")
    has = C.text(F.col("career_url")) != ""
    return df.withColumn("route", F.when(~has & F.col("ats").isNull(), "failed").when(F.col("ats").isNotNull(), F.col("ats")).otherwise("page"))


def apply_overrides(companies: DataFrame, overrides: DataFrame, discovered: DataFrame) -> DataFrame:
    """The career link of each company: override, then discovered, then its own; with where it came from."""
    df = companies.join(overrides.select("slug", F.col("career_url").alias("_o")), "slug", "left").join(discovered.select("slug", F.col("career_url").alias("_d")), "slug", "left")
    source = F.when(F.col("_o").isNotNull(), "override").when(F.col("_d").isNotNull(), "discovered").when(F.col("career_url").isNotNull(), "own")
    return df.withColumns({"career_url_source": source, "career_url": F.coalesce("_o", "_d", "career_url")}).drop("_o", "_d")


def add_missing(base: DataFrame, extra: DataFrame, order: str) -> DataFrame:
    """``base`` and the rows of ``extra`` whose slug it lacks, the first of each slug."""
    new = extra.join(base.select("slug"), "slug", "left_anti")
    first = new.groupBy("slug").agg(F.min_by(F.struct(*base.columns), F.struct(order)).alias("_first"))
    return base.unionByName(first.select("_first.*"))


# --- fixed values: names that a ranking gives to companies known by another
RANKED_NAMES = {"epam ukraine": "epam", "globallogic ukraine": "globallogic", "grid dynamics group": "grid dynamics"}


def add_ranked(companies: DataFrame, ranked: DataFrame, overrides: DataFrame, order: str = "rank") -> DataFrame:
    """``companies(name, slug, career_url, ...)`` and the companies of a ranking that they lack and that have a link in ``overrides(slug, career_url)``.

    Names are compared without case and outer space, and under the other names that some go by; a ranked company is told by a slug made of its
    name. Of several of one name the first by ``order`` counts. Columns that a ranking does not have are null; ``career_url_source`` is ``override``.
    """
    low = lambda c: F.lower(C.strip(C.text(c)))
    other = F.create_map(*[F.lit(x) for pair in RANKED_NAMES.items() for x in pair])
    names = companies.select(low(F.col("name")).alias("_known")).distinct()
    new = ranked.select(C.strip(C.text(F.col("name"))).alias("name"), F.col(order).alias("_order")).withColumn("_name", F.lower("name"))
    new = new.groupBy("_name").agg(F.min_by("name", "_order").alias("name"))
    new = new.withColumn("_other", F.coalesce(F.try_element_at(other, F.col("_name")), F.col("_name")))
    new = new.join(names, F.col("_name") == F.col("_known"), "left_anti").join(names, F.col("_other") == F.col("_known"), "left_anti")
    new = new.withColumn("slug", F.btrim(F.regexp_replace("_name", "[^a-z0-9]+", "-"), F.lit("-")))
    links = overrides.select("slug", F.col("career_url").alias("_link")).where("_link IS NOT NULL AND _link <> ''")
    found = new.join(links, "slug")
    values = {"name": F.col("name"), "slug": F.col("slug"), "career_url": F.col("_link"), "career_url_source": F.lit("override"), "enabled": F.lit(True)}
    return companies.unionByName(found.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in companies.schema]))


def preserve_state(fresh: DataFrame, stored: DataFrame, fields: list[str]) -> DataFrame:
    """Fill what a fresh row leaves null from the stored row of its slug."""
    old = stored.select("slug", *[F.col(f).alias(f"_old_{f}") for f in fields])
    df = fresh.join(old, "slug", "left")
    return df.withColumns({f: F.coalesce(f, f"_old_{f}") for f in fields}).drop(*[f"_old_{f}" for f in fields])


def catalog_page(slug: Column) -> Column:
    return F.concat(F.lit("https://jobs.dou.ua/companies/"), slug, F.lit("/vacancies/"))


def merge_catalog(stored: DataFrame, fresh: DataFrame, order: str = "seq") -> DataFrame:
    """The company catalogue with a fresh reading of it: ``slug, name, site_url, vacancies_url, vacancy_count`` and how many
    fresh rows ``added``, ``updated`` or left it ``unchanged``.

    Both sides have those five columns, ``fresh`` also the ``order`` it was read in. Slugs are compared without case and outer space, and
    rows without one are out; of stored rows with one slug the last by name stays. A fresh name and count replace the stored ones, where there are any; a site and
    a page of vacancies only fill what is missing. Several fresh rows of a slug apply one after another: the first to bring a new slug adds it.
    """
    tidy = lambda df, nth, name: df.select(F.lower(C.strip(C.text(F.col("slug")))).alias("slug"), nth.alias("_nth"), name.alias("name"), F.nullif("site_url", F.lit("")).alias("site_url"), F.nullif("vacancies_url", F.lit("")).alias("vacancies_url"), F.col("vacancy_count").cast("long").alias("vacancy_count")).where("slug <> ''")
    named = F.coalesce(F.nullif("name", F.lit("")), "slug")
    old = tidy(stored, F.lit(None).cast("long"), F.col("name")).withColumn("name", named)
    old = old.groupBy("slug").agg(F.max(F.struct("name", "site_url", "vacancies_url", "vacancy_count")).alias("o")).select("slug", F.lit(None).cast("long").alias("_nth"), "o.*")
    old = old.withColumn("vacancies_url", F.coalesce("vacancies_url", catalog_page(F.col("slug"))))
    new = tidy(fresh, F.col(order).cast("long"), F.col("name")).withColumns({"name": F.nullif(C.strip(named), F.lit("")), "vacancies_url": F.coalesce("vacancies_url", catalog_page(F.col("slug")))})

    at = Window.partitionBy("slug").orderBy(F.col("_nth").asc_nulls_first())
    before = at.rowsBetween(Window.unboundedPreceding, -1)
    rows = old.unionByName(new).withColumns({"_at": F.row_number().over(at), "_name": F.last("name", True).over(before), "_count": F.last("vacancy_count", True).over(before), "_site": F.first("site_url", True).over(before)})
    # A company that is added without a count has 0, which the next count then replaces.
    had = F.when(F.col("_at") > 1, F.coalesce("_count", F.when(~F.col("_first_is_old"), F.lit(0))))
    rows = rows.withColumn("_first_is_old", F.first(F.col("_nth").isNull()).over(before)).withColumn("_had", had)
    count = F.col("vacancy_count")
    changed = (F.col("name") != F.col("_name")) | (count.isNotNull() & ~count.eqNullSafe(F.col("_had"))) | (F.col("site_url").isNotNull() & F.col("_site").isNull())
    what = F.when(F.col("_nth").isNull(), "kept").when(F.col("_at") == 1, "added").when(F.coalesce(changed, F.lit(False)), "updated").otherwise("unchanged")
    rows = rows.withColumn("_what", what)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at")))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at")))
    known = F.bool_or(F.col("_what") == "kept")
    total = F.when(known, last("vacancy_count")).otherwise(F.coalesce(last("vacancy_count"), F.lit(0)))
    return rows.groupBy("slug").agg(last("name").alias("name"), first("site_url").alias("site_url"), first("vacancies_url").alias("vacancies_url"), total.alias("vacancy_count"), *[F.count_if(F.col("_what") == w).alias(w) for w in ("added", "updated", "unchanged")])


def catalog_stats(merged: DataFrame) -> DataFrame:
    """One row: fresh rows that added, updated and changed nothing, and the companies there are."""
    return merged.agg(*[F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in ("added", "updated", "unchanged")], F.count("*").alias("total"))


def collect_list(manual: DataFrame, catalog: DataFrame, least: int, limit: int = 300) -> DataFrame:
    """Manual companies first, then the catalogue by vacancies, at most ``limit``: a top-n, not a full sort."""
    a = manual.select("slug", "name", F.lit(0).alias("_rank"), F.lit(None).cast("long").alias("vacancy_count"))
    b = catalog.where(F.col("vacancy_count") >= least).join(manual.select("slug"), "slug", "left_anti").select("slug", "name", F.lit(1).alias("_rank"), "vacancy_count")
    return a.unionByName(b).orderBy("_rank", F.desc_nulls_last("vacancy_count"), F.lower("name"), "slug").limit(limit).drop("_rank")


def recheck_list(catalog: DataFrame, known: DataFrame, state: DataFrame, cutoff: Column, limit: int = 300) -> DataFrame:
    """Companies to look at: all new ones, then the stalest re-checks, at most ``limit`` of those."""
    df = catalog.join(known.select("slug"), "slug", "left_anti").join(state, "slug", "left")
    new = df.where("checked_at IS NULL").select("slug", F.lit("new").alias("why"), "checked_at")
    stale = df.where(F.col("checked_at") < cutoff).orderBy("checked_at", "slug").limit(limit).select("slug", F.lit("stale").alias("why"), "checked_at")
    return new.unionByName(stale)


def carry_forward(rows: DataFrame, partition: str, order: str, heading: str) -> DataFrame:
    """Each row with the last heading at or before it."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("carried", F.last(heading, ignorenulls=True).over(w))


def latest_period(rows: DataFrame, period: str) -> DataFrame:
    """Rows of the latest ``dd-mm-yyyy`` or ``mm-yyyy`` period: a maximum over reversed parts, joined back."""
    parts = F.reverse(F.split(period, "-"))
    top = rows.agg(F.max(parts).alias("_top"))
    return rows.withColumn("_parts", parts).join(F.broadcast(top), F.col("_parts") == F.col("_top")).drop("_parts", "_top")


# --- fixed values: hosts of applicant-tracking systems, words of career links and of other pages
ATS_HOSTS = ("ashbyhq.com", "bamboohr.com", "comeet.co", "greenhouse.io", "jobs.lever.co", "oraclecloud.com", "recruitee.com", "smartrecruiters.com", "teamtailor.com", "workable.com")
CAREER_TOKENS = ("career", "careers", "job", "jobs", "vacanc", "open-position", "open_position")
OTHER_TOKENS = ("blog", "news", "article")


def candidate_score(url: Column, label: Column) -> Column:
    """How much a link looks like a careers page: 100 for the host of an applicant-tracking system or one below it, 50 for a
    careers word in the url, 30 for one in the label, less 80 for a word of other pages in the url."""
    low = F.lower(C.text(url))
    any_of = lambda c, words: c.rlike("|".join(map(re.escape, words)))
    ats = C.on_host(C.host_of(C.authority(C.text(url))), ATS_HOSTS)
    points = lambda on, n: F.when(on, n).otherwise(0)
    return points(ats, 100) + points(any_of(low, CAREER_TOKENS), 50) + points(any_of(F.lower(C.text(label)), CAREER_TOKENS), 30) - points(any_of(low, OTHER_TOKENS), 80)


def best_link(links: DataFrame, group: str, score: Column, url: str) -> DataFrame:
    """For each group the link of the highest score, the shortest, then the smallest; links that score nothing are out."""
    scored = C.once(links, "score", score).where("score > 0")
    first = F.min_by(F.struct(*scored.columns), F.struct(-F.col("score"), F.length(url), F.col(url)))
    return scored.groupBy(F.col(group).alias("_group")).agg(first.alias("_first")).select("_first.*")


def join_sections(items: DataFrame, sections: DataFrame, item_key: str, section_key: str) -> DataFrame:
    """Items with their section; an item without one fails the job when the column is computed."""
    s = sections.select(F.col(section_key).alias("_key"), *[c for c in sections.columns if c != section_key])
    df = items.join(s, items[item_key] == F.col("_key"), "left")
    found = F.assert_true(F.col("_key").isNotNull(), F.concat(F.lit("no section for "), F.col(item_key).cast("string")))
    return df.where(found.isNull()).drop("_key")
