"""Pages: links with their text and JSON-LD postings, read by a small HTML parser in Arrow UDFs."""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.plans.storage import stash

LINKS = "array<struct<pos: int, href: string, text: string>>"
ANCHORS = "array<struct<pos: int, href: string, text: string, around: string, place: string>>"
POSTINGS = "array<struct<title: string, url: string, description: string, location: string>>"
_LINKS, _ANCHORS, _POSTINGS = (pa.list_(pa.struct([(n, pa.int32() if n == "pos" else pa.string()) for n in names.split()])) for names in ("pos href text", "pos href text around place", "title url description location"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
JOB_TOKENS = ("career", "job", "vacanc", "position", "opening")


class _Element:
    """An element: where its words and links begin among the page's, which it takes once it has closed if they are asked for, and what an
    anchor adds."""

    __slots__ = ("tag", "word", "link", "words", "links", "href", "country", "place", "holds", "_around")

    def __init__(self, tag: str, attrs: dict, word: int, link: int):
        self.tag, self.word, self.link = tag, word, link
        self.words, self.links, self.holds = (), (), False
        self.href = attrs.get("href") if tag == "a" else None
        self.country = "class" in attrs and "country" in (attrs["class"] or "").split()
        self.place, self._around = None, ...

    def text(self) -> str:
        return " ".join("".join(self.words).split())

    @property
    def around(self) -> str | None:
        """The words of an element that has closed, unless it holds several job links."""
        if self._around is ...:
            jobs = [h for h in map(str.lower, self.links) if any(t in h for t in JOB_TOKENS)]
            self._around = None if len(jobs) > 1 or self.tag == "" else " ".join(" ".join(self.words).split()) or None
        return self._around


class _Page(HTMLParser):
    """Collects anchors, with the element around each, and JSON-LD scripts of one page. Words and links are kept once, however deep
    they lie."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links, self.scripts, self._json, self._skip = [], [], None, 0
        self._words, self._hrefs, self._anchor, self._tags = [], [], None, {}
        self._open = [_Element("", {}, 0, 0)]

    def updatepos(self, i, j):
        """Lines are not counted."""
        return j

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self._json = [] if tag == "script" and dict(attrs).get("type") == "application/ld+json" else None
            self._skip += 1
        elif tag not in VOID:
            if tag == "a" and self._anchor is not None:
                self.handle_endtag("a")
            e = _Element(tag, dict(attrs), len(self._words), len(self._hrefs))
            self._anchor = e if tag == "a" else self._anchor
            self._tags[tag] = self._tags.get(tag, 0) + 1
            self._open.append(e)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            if self._json is not None:
                self.scripts.append("".join(self._json))
            self._json, self._skip = None, max(0, self._skip - 1)
        elif self._tags.get(tag):
            while self._close() != tag:
                pass

    def _close(self) -> str:
        e = self._open.pop()
        self._tags[e.tag] -= 1
        if e.country or e.href or e.holds:
            e.words = self._words[e.word :]
        if e.holds:
            e.links = self._hrefs[e.link :]
        if e.tag == "a":
            self._anchor = None
        if e.country and self._anchor is not None:
            self._anchor.place = self._anchor.place or e.text() or None
        if e.href:
            self._hrefs.append(e.href)
            self._open[-1].holds = True
            self.links.append((e, self._open[-1]))
        return e.tag

    def handle_data(self, data):
        if self._json is not None:
            self._json.append(data)
        elif not self._skip:
            self._words.append(data)

    def close(self):
        super().close()
        while len(self._open) > 1:
            self._close()

    def anchors(self):
        """``(href, text, around, place)`` of each anchor: the words of the element around it, unless that holds several
        job links, and the text of a ``country`` node in it."""
        for e, parent in self.links:
            yield e.href, e.text(), parent.around, e.place


def _page(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


def _job_postings(node):
    """JobPosting objects anywhere in a JSON-LD tree."""
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack += reversed(x)
        elif isinstance(x, dict):
            kind = x.get("@type")
            if kind == "JobPosting" or (isinstance(kind, list) and "JobPosting" in kind):
                yield x
            else:
                stack += [v for v in reversed(list(x.values())) if isinstance(v, (list, dict))]


def _location(job: dict) -> str | None:
    places = job.get("jobLocation") or []
    out = []
    for p in places if isinstance(places, list) else [places]:
        address = p.get("address") if isinstance(p, dict) else None
        if isinstance(address, dict):
            country = address.get("addressCountry")
            parts = [address.get("addressLocality"), address.get("addressRegion"), country.get("name") if isinstance(country, dict) else country]
            out.append(", ".join(str(x) for x in parts if x))
        elif isinstance(address, str):
            out.append(address)
    if job.get("jobLocationType") == "TELECOMMUTE":
        limits = job.get("applicantLocationRequirements") or []
        out += [str(x.get("name")) for x in (limits if isinstance(limits, list) else [limits]) if isinstance(x, dict) and x.get("name")]
        out.append("Remote")
    return " / ".join(dict.fromkeys(x for x in out if x)) or None


def page_links(body: Column) -> Column:
    @F.arrow_udf(LINKS)
    def run(bodies: pa.Array) -> pa.Array:
        return pa.array([[{"pos": i, "href": e.href, "text": e.text()} for i, (e, _) in enumerate(_page(h).links)] for h in bodies.to_pylist()], _LINKS)

    return run(body)


def _said(value) -> str | None:
    """A field of JSON-LD as text, whatever its type; without lone surrogates, which are no text."""
    if value is None or not isinstance(value, str) and not value:
        return None
    return str(value).encode("utf-8", "replace").decode()


def _postings(page: _Page) -> list[dict]:
    out = []
    for script in page.scripts:
        try:
            tree = json.loads(script)
        except ValueError:
            continue
        out += [{"title": _said(j.get("title")), "url": _said(j.get("url")), "description": _said(j.get("description")), "location": _said(_location(j))} for j in _job_postings(tree)]
    return out


def page_postings(body: Column) -> Column:
    @F.arrow_udf(POSTINGS)
    def run(bodies: pa.Array) -> pa.Array:
        return pa.array([_postings(_page(h)) for h in bodies.to_pylist()], _POSTINGS)

    return run(body)


def page_parts(body: Column) -> Column:
    """``anchors`` and ``postings`` of a page that is parsed once: links as ``page_links`` has them, with the words around each and its
    country, and JSON-LD postings."""

    @F.arrow_udf(f"anchors {ANCHORS}, postings {POSTINGS}")
    def run(bodies: pa.Array) -> pa.Array:
        anchors, postings = [], []
        for h in bodies.to_pylist():
            page = _page(h)
            anchors.append([{"pos": i, "href": a, "text": t, "around": d, "place": p} for i, (a, t, d, p) in enumerate(page.anchors())])
            postings.append(_postings(page))
        return pa.StructArray.from_arrays([pa.array(anchors, _ANCHORS), pa.array(postings, _POSTINGS)], ["anchors", "postings"])

    return run(body)


absolute = C.resolve_url


#: Places that count for a company whose board lists others as well.
ALLOWED_PLACES = {"zoolatech": ("central europe", "eastern europe", "europe", "remote", "ukraine")}


def place_allowed(company: Column, location: Column, allowed: dict[str, tuple[str, ...]] = ALLOWED_PLACES) -> Column:
    """False where the company has a list of places and the posting names another; unknown places pass."""
    lists = F.create_map(*[x for name, places in allowed.items() for x in (F.lit(name), F.array(*[F.lit(p) for p in places]))])
    mine = F.try_element_at(lists, F.lower(C.strip(C.text(company))))
    return F.coalesce(F.array_contains(mine, F.lower(C.strip(location))), F.lit(True)) | (C.text(location) == "")


def career_page_jobs(bronze: DataFrame, company: Column | None = None) -> DataFrame:
    """Postings of career pages: anchors merged with JSON-LD by url, JSON-LD's title first.

    The first anchor of a url wins; a JSON-LD posting without a url stands for the page itself. Anchors lend the words and
    the country next to them where JSON-LD has none; ``company`` brings its list of places into play.
    """
    pages = stash(bronze.select("source_id", "url", page_parts(F.col("body")).alias("p")).select("source_id", "url", "p.*"), "pages")
    links = pages.select("source_id", "url", F.explode("anchors").alias("x"))
    links = links.select("source_id", absolute(F.col("url"), F.col("x.href")).alias("job_url"), "x.*").where("text <> ''")
    first = links.groupBy("source_id", "job_url").agg(F.min_by(F.struct("text", "around", "place"), "pos").alias("a"))
    data = pages.select("source_id", "url", F.posexplode("postings").alias("pos", "x"))
    data = data.select("source_id", "pos", absolute(F.col("url"), F.coalesce("x.url", "url")).alias("job_url"), "x.title", "x.description", "x.location")
    one = data.groupBy("source_id", "job_url").agg(F.min_by(F.struct("title", "description", "location"), "pos").alias("d"))
    df = first.join(one, ["source_id", "job_url"], "full_outer")
    df = df.select("source_id", F.col("job_url").alias("url"), F.coalesce("d.title", "a.text").alias("title"), F.coalesce("d.description", "a.around").alias("description"), F.coalesce("d.location", "a.place").alias("location"))
    return df.where(C.is_target_job(F.col("title"), F.col("description")) & (place_allowed(company, F.col("location")) if company is not None else F.lit(True)))


def page_title(body: Column) -> Column:
    return C.squeeze(C.strip(F.regexp_extract(body, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def page_signals(body: Column, words: tuple[str, ...]) -> Column:
    """Sorted distinct words of a list that a page's text has."""
    pattern = r"(?iu)(?<![a-z0-9])(" + "|".join(words) + r")(?![a-z0-9])"
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(C.html_text(body), F.lit(pattern), 1), F.lower)))


def count_gaps(pages: DataFrame, group: str, page: str, shown: str) -> DataFrame:
    """Pages whose declared count does not advance over the page before."""
    before = F.lag(shown).over(Window.partitionBy(group).orderBy(page))
    return pages.withColumn("before", before).where(F.col("before").isNotNull() & (F.col(shown) <= F.col("before")))
