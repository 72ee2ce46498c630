"""Crawls over captured pages: a frontier that follows links to a bound, and details listed in several places.

A crawl's bound is a source's budget, so what lies beyond it is counted and makes the source degraded; it is never left out
unseen. Bounds count in the order a reader would meet the pages: level by level, within a level by the page that links and the
place of the link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.plans.storage import stash
from jobloom.sources import html
from jobloom.sources.feeds import bounded_status


def page_links(bronze: DataFrame) -> DataFrame:
    """``source_id, url, pos, href, text, next``: the links of each page, ``next`` being where they lead."""
    links = bronze.select("source_id", "url", F.explode(html.page_links(F.col("body"))).alias("x")).select("source_id", "url", "x.pos", "x.href", "x.text")
    links = links.where(F.col("href").isNotNull() & (C.strip("href") != ""))
    return links.withColumn("next", html.absolute(F.col("url"), F.col("href")))


def visit(seeds: DataFrame, links: DataFrame, most: int = 20) -> DataFrame:
    """``source_id, url, nth, visited`` of the pages that ``seeds(source_id, url)`` lead to over ``links(source_id, url, pos, next)``.

    Pages are numbered as they are found; the first ``most`` of a source are visited and their links followed, the others are
    ``visited`` false. Each round joins the pages found last with their links and drops those known, so cycles end and the rounds
    are at most the depth of what is visited. Repeated links count once.
    """
    first = seeds.groupBy("source_id").agg(F.min("url").alias("url")).select("source_id", "url", F.lit(1).cast("long").alias("nth"))
    known = frontier = stash(first, "seeds")
    steps = stash(links.groupBy("source_id", "url", "next").agg(F.min("pos").alias("pos")), "steps")
    while True:
        found = frontier.where(F.col("nth") <= most).join(steps, ["source_id", "url"]).groupBy("source_id", F.col("next").alias("url")).agg(F.min(F.struct("nth", "pos")).alias("at"))
        new = found.join(known.select("source_id", "url"), ["source_id", "url"], "left_anti")
        before = known.groupBy("source_id").agg(F.max("nth").alias("before"))
        place = F.row_number().over(Window.partitionBy("source_id").orderBy("at", "url"))
        frontier = stash(new.withColumn("place", place).join(before, "source_id").select("source_id", "url", (F.col("before") + F.col("place")).alias("nth")), "frontier")
        if frontier.isEmpty():
            return known.withColumn("visited", F.col("nth") <= most)
        known = stash(known.union(frontier), "known")


def crawl_jobs(bronze: DataFrame, seeds: DataFrame, company: str, job: Column, page: Column, most: int = 20) -> tuple[DataFrame, DataFrame]:
    """Postings and states of crawled listings: ``job`` and ``page`` tell job links and links to further pages by ``href``.

    Postings are the distinct targets of job links on visited pages, the first link of each by the page's number and its place, titled by the
    link or its address, on topic. A source is degraded where pages were left unvisited or could not be read, and failed where none was read.
    """
    links = stash(page_links(bronze), "links")
    pages = visit(seeds, links.where(page), most)
    pages = stash(pages.join(bronze.select("source_id", "url", F.lit(True).alias("read")).distinct(), ["source_id", "url"], "left"), "visited")
    jobs = links.where(job).join(pages.where("visited").select("source_id", "url", "nth"), ["source_id", "url"])
    first = jobs.groupBy("source_id", F.col("next").alias("url")).agg(F.min_by("text", F.struct("nth", "pos")).alias("text"))
    first = stash(first.withColumn("title", F.coalesce(F.nullif(C.squeeze(C.strip(C.text(F.col("text")))), F.lit("")), C.title_from_slug(F.col("url")))), "targets")
    scanned = first.groupBy("source_id").agg(F.count("*").alias("scanned"))
    states = pages.groupBy("source_id").agg(F.count_if(F.col("visited") & F.col("read")).alias("pages"), F.count_if(F.col("visited") & F.col("read").isNull()).alias("unread"), F.count_if(~F.col("visited")).alias("deferred"))
    states = states.join(scanned, "source_id", "left").select("source_id", "pages", "unread", "deferred", F.coalesce("scanned", F.lit(0)).alias("scanned"), bounded_status(F.col("pages"), F.col("deferred") + F.col("unread")).alias("status"))
    return first.where(C.is_target_job(F.col("title"))).select("source_id", F.lit(company).alias("company"), "title", "url"), states


def listed_details(places: DataFrame, details: DataFrame, pattern: str, link: Column, most: int = 60) -> tuple[DataFrame, DataFrame]:
    """Details that several places list: ``places(source_id, place, body)``, where a body that could not be fetched is null.

    The distinct addresses that ``pattern`` finds in the bodies, made links by ``link`` over ``slug``, in the order of the places and within
    them; the first ``most`` are read from ``details(url, title, body)``, where a null title is a page without a verified one. Gives
    ``source_id, url, nth, title, body`` of those and ``source_id, listed, deferred, read, errors, status``: errors count unfetched
    places, unverified details, and the remainder as one. A source none of whose places was fetched, or none of whose details was read, failed.
    """
    slugs = places.select("source_id", "place", F.posexplode(F.regexp_extract_all(F.col("body"), F.lit(pattern), 1)).alias("pos", "slug"))
    first = slugs.select("source_id", link.alias("url"), F.struct("place", "pos").alias("at")).groupBy("source_id", "url").agg(F.min("at").alias("at"))
    numbered = stash(first.withColumn("nth", F.row_number().over(Window.partitionBy("source_id").orderBy("at")).cast("long")).drop("at"), "listed")
    read = stash(numbered.where(F.col("nth") <= most).join(details, "url", "left"), "details")
    good = read.where("title IS NOT NULL").select("source_id", "url", "nth", "title", "body")
    fetched = places.groupBy("source_id").agg(F.count_if(F.col("body").isNull()).alias("unfetched"), F.count_if(F.col("body").isNotNull()).alias("fetched"))
    listed = numbered.groupBy("source_id").agg(F.count("*").alias("listed"))
    counts = read.groupBy("source_id").agg(F.count("title").alias("read"), F.count_if(F.col("title").isNull()).alias("unverified"))
    states = fetched.join(listed, "source_id", "left").join(counts, "source_id", "left").na.fill(0)
    deferred = F.greatest(F.col("listed") - most, F.lit(0))
    errors = F.col("unfetched") + F.col("unverified") + F.when(deferred > 0, 1).otherwise(0)
    status = F.when(F.col("fetched") == 0, "failed").when(errors == 0, "healthy").when((F.col("listed") > 0) & (F.col("read") == 0), "failed").otherwise("degraded")
    return good, states.select("source_id", "listed", deferred.alias("deferred"), "read", errors.alias("errors"), status.alias("status"))
