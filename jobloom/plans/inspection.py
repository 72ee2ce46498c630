"""Queries over crawls, discovery, evaluation and a run's reports, with the SQL that says from the tables what they must give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators import reports, watchlist
from jobloom.plans import catalogue, oracle, run, storage
from jobloom.plans.fixtures import raw_postings, table
from jobloom.sources import crawl, discovery, feeds, registry

c = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}


def checked(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# --- crawls

_MOST = 20
#: Pages of a source are a heap of 64: page j leads to 2j + 1 and 2j + 2, twice to the first, to its parent and to itself.
_HEAP = f"""RECURSIVE o AS (SELECT DISTINCT o_orderkey AS k, o_orderkey // 64 AS s, o_orderkey % 64 AS j FROM orders),
here AS (SELECT s, j, k FROM o WHERE j % 11 <> 5),
reach AS (SELECT DISTINCT s, 0::BIGINT AS j FROM o UNION ALL SELECT r.s, 2 * r.j + i FROM reach r JOIN here h ON h.s = r.s AND h.j = r.j, range(1, 3) t(i) WHERE 2 * r.j + i < 64),
ranked AS (SELECT s, j, row_number() OVER (PARTITION BY s ORDER BY j) AS nth FROM reach),
known AS (SELECT r.s, r.j, r.nth, r.nth <= {_MOST} AS visited, h.k FROM ranked r LEFT JOIN ranked p ON p.s = r.s AND p.j = (r.j - 1) // 2 AND r.j > 0 LEFT JOIN here h ON h.s = r.s AND h.j = r.j WHERE r.j = 0 OR p.nth <= {_MOST}),
links AS (SELECT s, nth, 0 AS pos, 'https://s' || s || '.io/jobs/ios-' || k AS url, CASE k % 3 WHEN 0 THEN 'Senior iOS Developer' WHEN 1 THEN 'Accountant' ELSE 'ios ' || k END AS title FROM known WHERE visited AND k IS NOT NULL
  UNION ALL SELECT s, nth, 1, 'https://s' || s || '.io/jobs/Swift_Engineer-' || k % 7, 'Swift Engineer ' || k % 7 FROM known WHERE visited AND k IS NOT NULL)"""


def _heap(spark, d) -> tuple[DataFrame, DataFrame]:
    o = storage.deal(table(spark, d, "orders").select(c("o_orderkey").alias("k")), "k").distinct()
    o = o.select("k", F.floor(c("k") / 64).alias("source_id"), (c("k") % 64).alias("j"))
    page = lambda j: _text("https://s", c("source_id"), ".io/p/", j)
    to = lambda href, text="": _text('<a href="', href, f'">{text}</a>')
    child = lambda i: F.when(2 * c("j") + i < 64, to(_text("/p/", 2 * c("j") + i), "next")).otherwise("")
    job = _text('<a href="/jobs/ios-', c("k"), '">', F.when(c("k") % 3 == 0, "Senior iOS &#68;eveloper").when(c("k") % 3 == 1, "Accountant").otherwise(""), "</a>")
    body = _text("<p>", job, to(_text("/jobs/Swift_Engineer-", c("k") % 7)), child(1), child(2), child(1), to(_text("/p/", F.floor((c("j") - 1) / 2)), "up"), to(page(c("j")), "self"), "</p>")
    return o.where("j % 11 <> 5").select("source_id", page(c("j")).alias("url"), body.alias("body")), o.select("source_id", page(F.lit(0)).alias("url")).distinct()


def _crawled(spark, d) -> tuple[DataFrame, DataFrame]:
    return crawl.crawl_jobs(*_heap(spark, d), "Co", c("href").startswith("/jobs/"), ~c("href").startswith("/jobs/") & ~c("href").contains("-1"), _MOST)


@checked(f"WITH {_HEAP} SELECT s AS source_id, 'Co' AS company, title, url FROM (SELECT *, row_number() OVER (PARTITION BY s, url ORDER BY nth, pos) AS n FROM links) WHERE n = 1 AND title <> 'Accountant'")
def q_crawl_jobs(spark, d):
    """Postings on the first twenty pages of each source's graph, which is deep, cyclic and has pages that cannot be read."""
    return _crawled(spark, d)[0]


@checked(f"""WITH {_HEAP}, n AS (SELECT s, count(DISTINCT url) AS scanned FROM links GROUP BY 1),
t AS (SELECT s, count(*) FILTER (WHERE visited AND k IS NOT NULL) AS pages, count(*) FILTER (WHERE visited AND k IS NULL) AS unread, count(*) FILTER (WHERE NOT visited) AS deferred FROM known GROUP BY 1)
SELECT s AS source_id, pages, unread, deferred, coalesce(scanned, 0) AS scanned, CASE WHEN pages = 0 AND unread + deferred > 0 THEN 'failed' WHEN unread + deferred > 0 THEN 'degraded' ELSE 'healthy' END AS status FROM t LEFT JOIN n USING (s)""")
def q_crawl_states(spark, d):
    return _crawled(spark, d)[1]


_LISTED = """p AS (SELECT p_partkey AS k, p_partkey // 100 AS s FROM part),
u AS (SELECT s, k, 0 AS place FROM p WHERE k % 2 = 0 AND s % 5 <> 3 UNION ALL SELECT s, k, 1 FROM p WHERE k % 3 = 0 AND s % 10 <> 3),
l AS (SELECT s, k, row_number() OVER (PARTITION BY s ORDER BY min(place), k) AS nth FROM u GROUP BY s, k)"""


def _details(spark, d) -> tuple[DataFrame, DataFrame]:
    p = table(spark, d, "part").select(c("p_partkey").alias("k"), F.floor(c("p_partkey") / 100).alias("source_id"), c("p_name").alias("name"))
    body = lambda when: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, c("k")))), lambda k: _text("<loc>https://x.io/career/v-", k, "</loc>")), "")
    both = p.groupBy("source_id").agg(body(c("k") % 2 == 0).alias("a"), body(c("k") % 3 == 0).alias("b"))
    places = both.select("source_id", F.lit(0).alias("place"), F.when(c("source_id") % 5 != 3, c("a")).alias("body")).union(both.select("source_id", F.lit(1), F.when(c("source_id") % 10 != 3, c("b"))))
    details = p.select(_text("https://x.io/career/v-", c("k")).alias("url"), F.when(c("k") % 7 != 0, c("name")).alias("title"), F.lit("b").alias("body"))
    return crawl.listed_details(places, details, r"https://x\.io/career/(v-[0-9]+)", _text("https://x.io/career/", c("slug")))


@checked(f"WITH {_LISTED} SELECT s AS source_id, 'https://x.io/career/v-' || k AS url, nth, p_name AS title FROM l JOIN part ON p_partkey = k WHERE nth <= 60 AND k % 7 <> 0")
def q_listed_details(spark, d):
    """Details that a sitemap and a listing name, each once, up to the source's budget."""
    return _details(spark, d)[0].drop("body")


@checked(f"""WITH {_LISTED}, t AS (SELECT s, count(*) AS listed, count(*) FILTER (WHERE nth <= 60 AND k % 7 <> 0) AS read, count(*) FILTER (WHERE nth <= 60 AND k % 7 = 0) AS bad FROM l GROUP BY 1),
a AS (SELECT DISTINCT p.s, coalesce(listed, 0) AS listed, coalesce(read, 0) AS read, coalesce(bad, 0) + CASE WHEN p.s % 5 = 3 THEN 1 ELSE 0 END + CASE WHEN p.s % 10 = 3 THEN 1 ELSE 0 END AS bad FROM p LEFT JOIN t USING (s)),
e AS (SELECT *, greatest(listed - 60, 0) AS deferred, bad + CASE WHEN listed > 60 THEN 1 ELSE 0 END AS errors FROM a)
SELECT s AS source_id, listed, deferred, read, errors, CASE WHEN s % 10 = 3 THEN 'failed' WHEN errors = 0 THEN 'healthy' WHEN listed > 0 AND read = 0 THEN 'failed' ELSE 'degraded' END AS status FROM e""")
def q_listed_states(spark, d):
    return _details(spark, d)[1]


# --- discovery

_FILLER = "we build things that people like and use every day "


def _attempts(spark, d) -> tuple[DataFrame, DataFrame]:
    """Every customer's captured pages, in the shapes that end the way to a careers page at each of its steps."""
    k = c("k")
    base = table(spark, d, "customer").select(c("c_custkey").alias("k"), _text("c", c("c_custkey")).alias("slug"))
    site, profile = F.when(k % 13 == 2, "https://www.facebook.com/x").otherwise(_text("https://s", k, ".io")), _text(discovery.PROFILE, c("slug"), "/")
    row = lambda url, status, body: F.struct(url.alias("url"), status.cast("int").alias("status"), body.alias("body"))
    ok = lambda refused, status=404: F.when(refused, status).otherwise(200)
    lit = lambda x: F.lit(x)
    link = F.when(k % 13 == 4, '<a href="/about">About</a><a href="mailto:jobs@x.io">Jobs</a>').when(k % 13 == 5, '<a href="https://jobs.dou.ua/companies/x/vacancies/">Jobs</a>').when(k % 13 == 6, '<a href="/blog/jobs">Careers</a>').otherwise('<a href="/about">About</a><a href="/careers">Careers</a><a href="/careers/long">Careers</a>')
    word = F.when(k % 3 == 0, "Swift engineers, iOS").when(k % 3 == 1, "Android and Flutter").otherwise("nothing")
    page = F.when(k % 13 == 8, _text("<p>", word, "</p>")).otherwise(_text("<noscript>swift</noscript><p>", F.repeat(lit(_FILLER), 9), word, '</p><a href="/careers/page/2">2</a><a href="/careers/page/3">3</a><a href="/careers/page/4">4</a>'))
    rows = F.array(
        row(profile, ok(k % 13 == 1, 403), _text('<div class="site"> <a href="', site, '" target="_blank" rel="nofollow">site</a></div>')),
        row(_text(profile, "vacancies/"), ok(k % 8 == 4), _text('<a class="vt" href="#">', F.when(k % 16 == 0, "iOS dev").otherwise("Android dev"), "</a><a class='x'>iPhone</a>")),
        row(_text("https://s", k, ".io"), ok(k % 13 == 3, 500), link), row(_text("https://s", k, ".io/careers"), ok(k % 13 == 7, 500), page),
        row(_text("https://s", k, ".io/careers/page/2"), ok(k % 2 == 0), lit("<p>React Native</p>")), row(_text("https://s", k, ".io/careers/page/3"), ok(k % 5 == 0), lit("<p>iPhone</p>")), row(_text("https://s", k, ".io/careers/page/4"), lit(200), lit("<p>kmm</p>")),
    )
    return base.select("slug", (k % 4 == 0).alias("has_vacancies")), base.select(F.explode(rows).alias("a")).select("a.*")


_INSPECTED = """WITH x AS (SELECT c_custkey AS k, c_custkey % 13 AS m FROM customer),
s AS (SELECT k, m, 'c' || k AS slug, CASE WHEN m IN (1, 2) THEN 'no_site' WHEN m = 3 THEN 'unreadable' WHEN m IN (4, 6) THEN 'career_not_found' WHEN m = 5 THEN 'on_dou' WHEN m = 7 THEN 'unreadable' WHEN m = 8 THEN 'js_rendered' ELSE 'read' END AS state,
  CASE WHEN k % 4 = 0 AND k % 8 <> 4 THEN CASE WHEN k % 16 = 0 THEN 'ios' ELSE 'android' END END AS listed FROM x),
f AS (SELECT *, CASE WHEN state = 'read' THEN CASE k % 3 WHEN 0 THEN ['ios', 'swift'] WHEN 1 THEN [] ELSE CASE WHEN k % 5 <> 0 THEN ['iphone'] ELSE [] END END END AS ios,
  CASE WHEN state = 'read' THEN CASE k % 3 WHEN 0 THEN [] WHEN 1 THEN ['android', 'flutter'] ELSE CASE WHEN k % 5 <> 0 THEN [] ELSE ['kmm'] END || CASE WHEN k % 2 <> 0 THEN ['react native'] ELSE [] END END END AS mobile FROM s)
SELECT slug, CASE WHEN state IN ('read', 'js_rendered') THEN 'https://s' || k || '.io/careers' END AS career_url, state AS career_state, array_to_string(ios, ' | ') AS ios, array_to_string(mobile, ' | ') AS mobile, listed,
  CASE WHEN state = 'read' THEN CASE WHEN len(ios) > 0 OR listed = 'ios' THEN 'ios' WHEN len(mobile) > 0 OR listed = 'android' THEN 'mobile_stack' END END AS strength FROM f"""


@checked(_INSPECTED)
def q_inspect_companies(spark, d):
    """Where each company's way to its careers page ends, and what that page and its listed vacancies show."""
    out = discovery.inspect(*_attempts(spark, d))
    listed = F.when(c("listed").isNotNull(), F.array_join(F.concat("listed.ios", "listed.mobile"), " "))
    return out.select("slug", "career_url", "career_state", F.array_join("career.ios", " | ").alias("ios"), F.array_join("career.mobile", " | ").alias("mobile"), listed.alias("listed"), "strength")


@checked(f"""SELECT CASE WHEN c_custkey % 10 = 0 THEN slug ELSE c_name END AS name, slug, 'https://jobs.dou.ua/companies/' || slug || '/' AS dou_company_url, career_url, 'discovery' AS career_url_source FROM ({_INSPECTED}) i JOIN customer ON slug = 'c' || c_custkey WHERE strength IS NOT NULL AND c_custkey % 7 NOT IN (0, 1)""")
def q_discovered_entries(spark, d):
    """Rows for the watchlist: strong companies whose page a trial run could read."""
    k = c("c_custkey")
    people = table(spark, d, "customer")
    slug = _text("c", k)
    readings = people.select(_text("company-watchlist:", slug).alias("source_id"), F.when(k % 7 == 0, "failed").otherwise("healthy").alias("status"), F.when(k % 7 == 1, 0).otherwise(3).alias("items_scanned"))
    companies = people.select(slug.alias("slug"), F.when(k % 10 == 0, "").otherwise(c("c_name")).alias("name"))
    return discovery.watchlist_entries(companies, discovery.inspect(*_attempts(spark, d)), readings).select("name", "slug", "dou_company_url", "career_url", "career_url_source")


@checked("""WITH s AS (SELECT s_suppkey AS k FROM supplier)
SELECT 's' || k AS slug, 'greenhouse' AS ats, CASE WHEN k % 4 = 0 THEN 'T' ELSE 't' END || k AS token, CASE WHEN k % 4 = 0 THEN 'career-page' ELSE 'slug-guess' END AS evidence, CASE WHEN k % 4 = 0 THEN 0 ELSE 3 END AS jobs, CASE WHEN k % 4 = 0 THEN '' ELSE 'iOS Dev' END AS ios, CASE WHEN k % 4 = 0 THEN '' ELSE 'iOS Dev | Clerk | ' END AS sample FROM s
UNION ALL SELECT 's' || k, 'lever', 't' || k, 'slug-guess', 1, 'Swift Engineer ' || k, 'Swift Engineer ' || k FROM s WHERE k % 3 = 0""")
def q_board_discovery(spark, d):
    """Boards that suppliers' pages name or their names suggest: refused, empty, unreadable and real ones."""
    k = c("s_suppkey")
    s = table(spark, d, "supplier")
    one = lambda nth, ats, token, evidence: F.struct(F.lit(nth).alias("nth"), F.lit(ats).alias("ats"), token.alias("token"), F.lit(evidence).alias("evidence"))
    up, low = _text("T", k), _text("t", k)
    tries = F.array(one(1, "greenhouse", up, "career-page"), one(2, "greenhouse", low, "slug-guess"), one(3, "lever", low, "slug-guess"), one(4, "ashby", low, "slug-guess"), one(5, "breezy", low, "slug-guess"))
    board = lambda ats, token, body: F.struct(F.lit(ats).alias("ats"), token.alias("token"), body.alias("body"))
    given = F.array(board("greenhouse", up, F.when(k % 4 == 0, '{"jobs":[]}')), board("greenhouse", low, F.lit('{"jobs":[{"title":"iOS Dev"},{"title":"Clerk"},{"id":1}]}')), board("lever", low, F.when(k % 3 == 0, _text('[{"text":"Swift Engineer ', k, '"}]')).otherwise("oops")), board("ashby", low, F.lit("{}")), board("breezy", low, F.lit('{"name":"x"}')))
    candidates = s.select(_text("s", k).alias("slug"), F.explode(tries).alias("x")).select("slug", "x.*")
    out = discovery.discovered_boards(candidates, s.select(F.explode(given).alias("x")).select("x.*"))
    return out.select("slug", "ats", "token", "evidence", "jobs", F.array_join("ios_titles", " | ").alias("ios"), F.array_join("sample_titles", " | ").alias("sample"))


# --- a run's reports


def _run(spark, d) -> tuple:
    raw = raw_postings(spark, d).withColumn("source_id", F.when(c("seq") % 5 == 0, _text("telegram:ch", c("seq") % 150)).otherwise(_text("company:c", c("seq") % 150, "@host")))
    out = run.collect(catalogue._today(spark, d), raw, catalogue._baseline(spark, d), F.lit("2024-01-15"), save=storage.stash)
    usable = raw.join(out.runs.where("status <> 'failed'").select("source_id"), "source_id", "left_semi")
    return out, usable


def _report(spark, d) -> DataFrame:
    out, usable = _run(spark, d)
    return storage.stash(reports.diagnostics(out.runs, usable, out.normalized, out.unique, F.lit("degraded"), F.lit("2024-01-15T08:00:00+00:00")), "report")


_JUDGED = f"judged AS (SELECT g.*, t.source_name, t.items_scanned FROM ({oracle.SQL['q_degraded']}) g JOIN (WITH {oracle.RUNS} SELECT source_id, source_name, items_scanned FROM today) t USING (source_id))"
_OWNER = "CASE WHEN seq % 5 = 0 THEN 'telegram:ch' || seq % 150 ELSE 'company:c' || seq % 150 || '@host' END"
_USABLE = f"{oracle.BASE}, {_JUDGED}, ur AS (SELECT seq, {_OWNER} AS source_id FROM raw WHERE {_OWNER} IN (SELECT source_id FROM judged WHERE status <> 'failed')), un AS (SELECT norm.*, ur.source_id FROM norm JOIN ur USING (seq)), base_rows AS (SELECT * FROM un), {oracle.DEDUP.strip()}"
_BY_SOURCE = f"""{_USABLE}, a AS (SELECT source_id, count(*) AS raw FROM ur GROUP BY 1), b AS (SELECT source_id, count(*) AS normalized, count(*) FILTER (WHERE {oracle.inbox('track', 'title')}) AS inbox, count(*) FILTER (WHERE NOT {oracle.primary('title')}) AS outside, count(*) FILTER (WHERE ({oracle.topic('title', 'description')}) IS NULL) AS off FROM un GROUP BY 1),
per AS (SELECT j.source_id AS id, source_name AS name, status, coalesce(error, '') AS reason, items_scanned AS scanned, coalesce(raw, 0) AS raw, coalesce(normalized, 0) AS normalized, coalesce(raw, 0) - coalesce(normalized, 0) AS normalization_rejected, coalesce(inbox, 0) AS inbox_eligible, CASE WHEN outside > 0 THEN outside END AS outside, CASE WHEN off > 0 THEN off END AS off FROM judged j LEFT JOIN a ON a.source_id = j.source_id LEFT JOIN b ON b.source_id = j.source_id)"""
_COUNTS = f"""(SELECT count(*) FROM ur) AS raw, (SELECT count(*) FROM un) AS normalized, (SELECT count(*) FROM roles) AS unique_roles, (SELECT count(*) FROM un) - (SELECT count(*) FROM roles) AS duplicates_collapsed, (SELECT count(*) FROM roles WHERE {oracle.inbox('track', 'title')}) AS inbox_eligible, (SELECT count(*) FROM roles WHERE track = 'ai' OR ({oracle.topic('title', 'description')}) IS NOT NULL) AS handover_eligible"""


@checked(f"{_BY_SOURCE} SELECT * FROM per")
def q_diagnostics(spark, d):
    """The sources of a run's diagnostics, read back from the JSON."""
    s = _report(spark, d).select(F.explode(F.from_json("report", reports.REPORT)["sources"]).alias("s")).select("s.*")
    return s.select("id", "name", "status", "reason", "scanned", "raw", "normalized", "normalization_rejected", "inbox_eligible", F.try_element_at("rejections", F.lit("outside_primary_ios")).alias("outside"), F.try_element_at("rejections", F.lit("off_topic")).alias("off"))


@checked(f"""{_BY_SOURCE}, n AS (SELECT {_COUNTS}),
c AS (SELECT unnest(['raw', 'normalized', 'unique_roles', 'duplicates_collapsed', 'inbox_eligible', 'handover_eligible']) AS name, unnest([raw, normalized, unique_roles, duplicates_collapsed, inbox_eligible, handover_eligible]) AS v, unnest(range(6)) AS i FROM n),
l AS (SELECT i, line FROM (VALUES (0, '## Vacancy collection'), (1, ''), (2, 'Status: **degraded**'), (3, ''), (10, ''), (11, '| Source | Status | Scanned | Skipped | Normalized | Inbox eligible | Reason |'), (12, '|---|---|---:|---:|---:|---:|---|')) t(i, line)
  UNION ALL SELECT 4 + i, '- ' || name || ': ' || v FROM c
  UNION ALL SELECT 12 + row_number() OVER (ORDER BY id), '| ' || name || ' | ' || status || ' | ' || scanned || ' | 0 | ' || normalized || ' | ' || inbox_eligible || ' | ' || reason || ' |' FROM per)
SELECT CAST(i AS INT) AS nth, line FROM l""")
def q_run_summary(spark, d):
    """The Markdown summary of the same run, line by line."""
    return reports.summary_lines(_report(spark, d))


_CHECK = "CASE WHEN m < 480 THEN '08:00' WHEN m < 840 THEN '14:00' ELSE 'завтра 08:00' END"


@checked(f"""WITH {oracle.CLOCK}, s AS (SELECT s_nationkey AS n, list_sort(list(s_name)) AS l FROM supplier GROUP BY 1), x AS (SELECT event_id, strftime(s, '%H:%M') || ' · ⏭ ' || {_CHECK} AS tail, event_id % 25 AS n FROM clock),
t AS (SELECT event_id, tail, x.n, array_to_string(l[1:3], ', ') || CASE WHEN len(l) > 3 THEN ' (+' || (len(l) - 3) || ')' ELSE '' END AS names FROM x LEFT JOIN s ON s.n = x.n)
SELECT event_id, CASE WHEN n % 3 = 0 OR names IS NULL THEN '📭 Новых нет · 🟢 ' || tail ELSE '📭 Новых нет' || chr(10) || CASE WHEN n % 3 = 1 THEN '⚠️ Не ответили: ' || names || chr(10) || '⚠️ Telegram: ch' || n || chr(10) ELSE '🔒 Блокируют автосбор: ' || names || chr(10) END || '🕐 ' || tail END AS heartbeat FROM t""")
def q_heartbeat(spark, d):
    """What runs without news say, at every event's time, with the problems of its nation's suppliers."""
    s = table(spark, d, "supplier").groupBy(c("s_nationkey").alias("n")).agg(F.array_sort(F.collect_list("s_name")).alias("l"))
    none = F.array().cast("array<string>")
    there = lambda when, value: F.when(when, value).otherwise(none)
    s = s.withColumns({"failed_names": there(c("n") % 3 == 1, F.concat("l", F.array(_text("Telegram @ch", c("n"))))), "manual_names": there(c("n") % 3 == 2, c("l")), "degraded_names": none, "skipped_names": none})
    problems = reports.with_problems(s).select("n", "problems")
    e = table(spark, d, "events").select("event_id", "ts", (c("event_id") % 25).alias("n")).join(F.broadcast(problems), "n", "left")
    return reports.heartbeat(e, c("ts"), "event_id")


# --- evaluation


def _cases(spark, d) -> DataFrame:
    return raw_postings(spark, d).withColumns({"id": c("seq").cast("string"), "expected": c("seq") % 4 != 1})


@checked(f"""{oracle.BASE}, e AS (SELECT *, {oracle.level('title')} AS lv, CASE WHEN {oracle.attention('location', 'remote')} THEN 'true' ELSE 'false' END AS mark FROM norm WHERE {oracle.inbox('track', 'title')} AND seq % 4 <> 1)
SELECT CAST(seq AS VARCHAR) AS id, 'level' AS name, 'senior' AS value, lv AS actual FROM e WHERE seq % 3 = 0 AND lv <> 'senior'
UNION ALL SELECT CAST(seq AS VARCHAR), 'attention', CASE WHEN seq % 5 = 0 THEN 'true' ELSE 'false' END, mark FROM e WHERE mark <> CASE WHEN seq % 5 = 0 THEN 'true' ELSE 'false' END""")
def q_eval_labels(spark, d):
    """Labels that differ from what cases expect, those of the attention mark where a case says nothing among them."""
    cases = _cases(spark, d)
    said = cases.where("seq % 3 = 0").select("id", F.lit("level").alias("name"), F.lit("senior").alias("value")).union(cases.where("seq % 5 = 0").select("id", F.lit("attention"), F.lit("true")))
    return run.evaluate_labels(cases, said)


_SCOPED = f"""{oracle.BASE}, twice AS (SELECT norm.* REPLACE (CASE WHEN back THEN -seq ELSE seq END AS seq, regexp_extract(url, '^https://Jobs.Example.com/([0-9]+)/', 1) || '|' || back || '|' || identity_key AS identity_key, regexp_extract(url, '^https://Jobs.Example.com/([0-9]+)/', 1) || '|' || back || '|' || cc AS cc), regexp_extract(url, '^https://Jobs.Example.com/([0-9]+)/', 1) AS id, back FROM norm, (VALUES (false), (true)) t(back)),
base_rows AS (SELECT * FROM twice), {oracle.DEDUP.strip()},
sizes AS (SELECT CAST(o_custkey AS VARCHAR) AS id, count(*) AS rows FROM orders GROUP BY 1), left_ AS (SELECT id, back, list_sort(list(url)) AS urls FROM roles GROUP BY 1, 2), kept AS (SELECT id, back, count(*) AS normal FROM twice GROUP BY 1, 2)"""


@checked(f"""{_SCOPED}, w AS (SELECT id, urls AS wanted FROM left_ WHERE NOT back)
SELECT s.id, t.back AS backwards, rows, coalesce(normal, 0) AS normal, coalesce(array_to_string(urls, ' '), '') AS urls, rows = coalesce(normal, 0) AND coalesce(array_to_string(urls, ' '), '') = coalesce(array_to_string(wanted, ' '), '') AND true AS ok
FROM sizes s CROSS JOIN (VALUES (false), (true)) t(back) LEFT JOIN kept k ON k.id = s.id AND k.back = t.back LEFT JOIN left_ l ON l.id = s.id AND l.back = t.back LEFT JOIN w ON w.id = s.id""")
def q_eval_duplicates(spark, d):
    """Every customer's postings as a group of variants, without duplicates forwards and backwards; wanted is what forwards gives."""
    groups = raw_postings(spark, d).withColumns({"id": F.regexp_extract("url", "^https://Jobs.Example.com/([0-9]+)/", 1), "pos": c("seq")})
    survivors = storage.stash(run.surviving_variants(groups), "survivors")
    return run.judge_variants(survivors, survivors.where("NOT backwards").select("id", "urls")).withColumn("urls", F.array_join("urls", " ")).drop("wanted")


# --- pages of one source


def _pieces(spark, d) -> DataFrame:
    """Parts as items of a source each two hundred, with the page they stand on."""
    k = c("p_partkey")
    p = table(spark, d, "part").select(k.alias("k"), F.floor(k / 200).alias("source_id"), F.when(k % 3 == 0, _text("Clerk ", k)).otherwise(_text("iOS Engineer ", k)).alias("title"), c("p_brand").alias("brand"))
    return p.withColumn("page", (F.floor(c("k") % 200 / 10) + 1).cast("int"))


@checked("""WITH p AS (SELECT p_partkey // 200 AS s, p_partkey % 200 // 10 + 1 AS page FROM part), n AS (SELECT s, max(page) AS last FROM p GROUP BY 1),
g AS (SELECT s, last, CASE WHEN s % 4 = 1 THEN least(3, last) ELSE least(last, 10) END AS read FROM n)
SELECT s AS source_id, read, CASE WHEN s % 4 = 1 THEN least(last, 10) - least(3, last) ELSE 0 END AS missing, greatest(last - 10, 0) AS deferred, CASE WHEN last > 10 OR (s % 4 = 1 AND last > 3) THEN 'degraded' ELSE 'healthy' END AS status FROM g""")
def q_search_status(spark, d):
    """Searches of up to twenty pages, of which ten are read; of some the fourth was not captured."""
    p = _pieces(spark, d).groupBy("source_id", "page").agg(F.count("*").alias("n"))
    last = p.groupBy("source_id").agg(F.max("page").alias("last"))
    pages = p.join(last, "source_id").where("page <> 4 OR source_id % 4 <> 1")
    return feeds.search_status(pages.select("source_id", F.to_json(F.struct(c("page").alias("current_page"), c("last").alias("last_page"))).alias("body")))


_PIECES = "p AS (SELECT p_partkey AS k, p_partkey // 200 AS s, p_partkey % 200 // 10 + 1 AS page, CASE WHEN p_partkey % 3 = 0 THEN 'Clerk ' ELSE 'iOS Engineer ' END || p_partkey AS title, p_brand AS brand FROM part)"


@checked(f"""WITH {_PIECES} SELECT 'offset_list' AS kind, s AS source_id, title, 'https://www.valtech.com/jobs/' || k AS url, brand || ' / Kyiv' AS location, CAST(k AS VARCHAR) AS job_id FROM p WHERE k % 3 <> 0
UNION ALL SELECT 'session_pages', s, title, 'https://career.softserveinc.com/en-us/vacancies/ios-' || k, brand, CAST(k AS VARCHAR) FROM p WHERE k % 3 <> 0""")
def q_listed_pages(spark, d):
    """Lists read by offset, and by the pages of a session, with an item that stands on two pages."""
    p = _pieces(spark, d)
    again = p.where("k % 10 = 0").withColumn("page", c("page") + 1)
    both, out = p.unionByName(again), []
    shapes = {
        "offset_list": (F.struct(c("k").cast("string").alias("id"), "title", _text("/jobs/", c("k")).alias("url"), F.array(_text(" ", c("brand")), F.lit(" "), F.lit("Kyiv")).alias("offices")), '{"list":', ',"page":{"itemTotal":200}}'),
        "session_pages": (F.struct(c("k").cast("string").alias("id"), c("title").alias("name"), _text(" /ios-", c("k")).alias("urlSegment"), c("brand").alias("city")), '{"data":{"vacancies":', '},"meta":{"last_page":20}}'),
    }
    for kind, (item, before, after) in shapes.items():
        pages = both.groupBy("source_id", "page").agg(F.concat(F.lit(before), F.to_json(F.collect_list(item)), F.lit(after)).alias("body")).withColumn("url", F.lit("u"))
        out.append(registry.parse_json(pages, registry.JSON_SOURCES[kind], "Co").select(F.lit(kind).alias("kind"), "source_id", "title", "url", "location", "job_id"))
    return feeds.union_results(*out)


@checked(f"""WITH {_PIECES}, n AS (SELECT s, page, count(*) AS got, min(k) - 200 * s AS start FROM p GROUP BY 1, 2), f AS (SELECT s, min(start) AS first, sum(got) AS total, count(*) AS pages FROM n GROUP BY 1),
g AS (SELECT f.s, f.pages, f.total, f.first, CASE WHEN f.s % 3 = 1 AND f.pages > 2 THEN 2 ELSE f.pages END AS read FROM f)
SELECT s AS source_id, CASE WHEN first > 0 THEN 0 ELSE read END AS read, CASE WHEN first > 0 THEN 0 ELSE CAST((SELECT sum(got) FROM n WHERE n.s = g.s AND n.page <= g.read) AS BIGINT) END AS items, first = 0 AND read = pages AND s % 5 <> 2 AS ended,
  CASE WHEN first > 0 THEN 'failed' WHEN read = pages AND s % 5 <> 2 THEN 'healthy' ELSE 'degraded' END AS status FROM g""")
def q_chained_pages(spark, d):
    """Lists read from offset to offset, some without their third page, some whose last page does not say so."""
    n = _pieces(spark, d).groupBy("source_id", "page").agg(F.count("*").alias("got"), (F.min("k") - 200 * c("source_id")).alias("start"))
    last = n.groupBy("source_id").agg(F.max("page").alias("last"))
    pages = n.join(last, "source_id").where("page <> 3 OR source_id % 3 <> 1").withColumn("done", (c("page") == c("last")) & (c("source_id") % 5 != 2))
    return feeds.chained_pages(pages.select("source_id", "start", "got", "done"))


# --- small rules


@checked("""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://api.telegram.org/bot12:s3cret/send?t=12:s3cret' WHEN 1 THEN 'https://x.io/a12:s3cret' WHEN 2 THEN url ELSE 'https://api.telegram.org/botX/12:s3cret' END AS u FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://api.telegram.org/bot[redacted]/send?t=12:s3cret' WHEN 1 THEN 'https://x.io/a[redacted]' ELSE u END AS url FROM p""")
def q_redacted_urls(spark, d):
    k, token = c("page_id") % 4, "12:s3cret"
    url = F.when(k == 0, f"https://api.telegram.org/bot{token}/send?t={token}").when(k == 1, f"https://x.io/a{token}").when(k == 2, c("url")).otherwise(f"https://api.telegram.org/botX/{token}")
    return table(spark, d, "pages").select("page_id", C.redact_token(url, token).alias("url"))


@checked("""SELECT page_id, page_id % 3 = 1 AND length(html) + 31 <= 24000 AS wall FROM pages""")
def q_bot_walls(spark, d):
    """Captured pages with a wall's words in them; a long page is a real one."""
    body = F.when(c("page_id") % 3 == 1, F.concat(c("html"), F.lit("<title>JUST a moment...</title>"))).otherwise(c("html"))
    return table(spark, d, "pages").select("page_id", C.looks_like_bot_wall(body).alias("wall"))


@checked("""WITH s AS (SELECT s_name AS name, 's' || s_suppkey AS slug, s_suppkey AS k FROM supplier),
r AS (SELECT k, CASE k % 4 WHEN 0 THEN ' ' || upper(name) || ' ' WHEN 1 THEN 'EPAM Ukraine' WHEN 2 THEN 'New & Co ' || k // 8 ELSE 'Lost ' || k END AS name FROM s),
n AS (SELECT arg_min(trim(name), k) AS name FROM r WHERE k % 4 = 2 GROUP BY lower(trim(name)))
SELECT name, slug, CAST(NULL AS VARCHAR) AS career_url, CAST(NULL AS VARCHAR) AS career_url_source FROM s UNION ALL SELECT 'EPAM', 'epam', NULL, NULL
UNION ALL SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 'https://o/' || regexp_extract(name, '[0-9]+$'), 'override' FROM n""")
def q_ranked_companies(spark, d):
    """A ranking's companies: known ones in another spelling or under another name, new ones with a link, and others without."""
    s, k = table(spark, d, "supplier"), c("s_suppkey")
    none = F.lit(None).cast("string")
    epam = spark.createDataFrame([("EPAM", "epam")], "name string, slug string")
    companies = s.select(c("s_name").alias("name"), _text("s", k).alias("slug")).union(epam).select("name", "slug", none.alias("career_url"), none.alias("career_url_source"))
    name = F.when(k % 4 == 0, _text(" ", F.upper("s_name"), " ")).when(k % 4 == 1, "EPAM Ukraine").when(k % 4 == 2, _text("New & Co ", F.floor(k / 8))).otherwise(_text("Lost ", k))
    overrides = s.select(_text("new-co-", F.floor(k / 8)).alias("slug"), _text("https://o/", F.floor(k / 8)).alias("career_url")).distinct()
    return watchlist.add_ranked(companies, s.select(name.alias("name"), k.alias("rank")), overrides)
