"""The query catalogue: each operator applied to the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions import policy as P
from jobloom.operators import calendar, dedup, health, incremental, postings, reports, state_merge, watchlist
from jobloom.plans import run, storage
from jobloom.plans.fixtures import raw_postings, table
from jobloom.sources import feeds, html, messages

c = F.col
DASH = " | "
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _normal(spark, d) -> DataFrame:
    return postings.normalize(raw_postings(spark, d))


def _stored(spark, d) -> DataFrame:
    """The run's normal postings, written once for the branches that read them."""
    return storage.stash(_normal(spark, d), "normal")


def _seen(normal: DataFrame) -> DataFrame:
    """History: every third order's normal posting."""
    third = normal.where("seq % 3 = 0").select(postings.feed_key().alias("key"), "title", "company", "seq")
    return third.groupBy("key").agg(F.min_by("title", "seq").alias("title"), F.min_by("company", "seq").alias("company"), F.lit("2024-01-01").alias("first_seen"))


def _fresh_input(normal: DataFrame) -> DataFrame:
    return normal.where("seq % 3 <> 0")


def _runs(spark, d) -> DataFrame:
    """Source runs: events of a user on a day, some of them failed or skipped."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "user_id", "event_type", "value")
    days = e.groupBy("user_id", "day").agg(F.count_if(c("value") > 60).alias("items_scanned"))
    u = c("user_id")
    channel = u % 5 == 0
    return days.select(
        F.when(channel, F.concat(F.lit("telegram:ch"), u.cast("string"))).otherwise(F.concat(F.lit("company:c"), u.cast("string"), F.lit("@host"))).alias("source_id"),
        F.when(channel, F.concat(F.lit("Telegram @ch"), u.cast("string"))).otherwise(F.concat(F.lit("C"), u.cast("string"))).alias("source_name"),
        F.when(u % 17 == 3, "failed").when(u % 19 == 4, "degraded").otherwise("healthy").alias("status"),
        F.when(u % 34 == 3, "403 Client Error: Forbidden").when(u % 17 == 3, "timeout").when(u % 25 == 0, "session not set").alias("error"),
        (u % 23 == 1).alias("empty_is_healthy"), "items_scanned", (u * 10 + F.dayofmonth("day")).alias("checkpoint"), "day", "user_id",
    )


def _baseline(spark, d) -> DataFrame:
    before = _runs(spark, d).where(c("day") < F.lit("2024-01-15").cast("date"))
    rec = before.groupBy("source_id").agg(F.max("source_name").alias("name"), F.max("items_scanned").alias("best_scanned"), F.max_by("items_scanned", "day").alias("last_scanned"), F.max("user_id").alias("u"))
    return rec.select("source_id", "name", F.when(c("u") % 7 == 0, "ios+ai").otherwise("ios").alias("search_policy"), (c("best_scanned") * 4).alias("best_scanned"), "last_scanned", F.lit("2024-01-14").alias("last_success_at"), (c("u") % 4).alias("empty_runs"), F.lit("2024-01-10").alias("last_nonzero"))


def _today(spark, d) -> DataFrame:
    return _runs(spark, d).where(c("day") == F.lit("2024-01-15").cast("date")).drop("day", "user_id")


# --- urls and identity


@query
def q_canonical_url(spark, d):
    both = table(spark, d, "pages").select("url").union(raw_postings(spark, d).select("url"))
    return C.with_canonical_url(storage.deal(both, "url").distinct())


@query
def q_strip_tracking(spark, d):
    return table(spark, d, "pages").select("page_id", C.strip_tracking(c("url")).alias("url"))


@query
def q_source_id(spark, d):
    return table(spark, d, "pages").select("page_id", C.source_id(F.concat(F.lit("c"), (c("page_id") % 9).cast("string")), c("url")).alias("source_id"))


@query
def q_slug_title(spark, d):
    return table(spark, d, "pages").select("page_id", C.title_from_slug(c("url")).alias("title"))


@query
def q_identity(spark, d):
    return postings.with_keys(raw_postings(spark, d)).select("seq", "canonical_url", "identity_key", "identity_strategy")


@query
def q_content_hash(spark, d):
    return raw_postings(spark, d).select("seq", C.content_hash(c("company"), c("title"), c("location")).alias("hash"))


@query
def q_company_alias(spark, d):
    return raw_postings(spark, d).select("company", C.canonical_company(c("company")).alias("canonical")).distinct()


@query
def q_title_norm(spark, d):
    return raw_postings(spark, d).select("title", C.normalize_title(c("title")).alias("normal")).distinct()


@query
def q_role_family(spark, d):
    return raw_postings(spark, d).select("seq", C.canonical_company(c("company")).alias("company"), C.role_family_title(c("title")).alias("family"))


# --- topic, level, location


@query
def q_topic(spark, d):
    return raw_postings(spark, d).select("seq", C.topic(c("title"), c("description")).alias("topic"))


@query
def q_adjacent(spark, d):
    return raw_postings(spark, d).select("seq", C.adjacent_topic(c("title")).alias("adjacent"))


@query
def q_inbox(spark, d):
    return raw_postings(spark, d).select("seq", C.is_inbox_candidate(c("track"), c("title")).alias("inbox"), C.is_handover_candidate(c("track"), c("title"), c("description")).alias("handover"), C.is_target_job(c("title"), c("description")).alias("target"))


@query
def q_level(spark, d):
    return raw_postings(spark, d).select("seq", C.title_level(c("title")).alias("level"), C.is_target_level(c("title")).alias("target_level"))


@query
def q_location(spark, d):
    a = (c("location"), c("remote"))
    return raw_postings(spark, d).select("seq", C.is_work_mode_eligible(*a).alias("mode_ok"), C.is_location_eligible(*a).alias("location_ok"), C.location_attention(*a).alias("attention"), C.workable(*a).alias("workable"))


@query
def q_infer_remote(spark, d):
    return raw_postings(spark, d).select("seq", C.infer_remote(c("title"), c("location"), c("description")).alias("mode"))


@query
def q_language(spark, d):
    raw = raw_postings(spark, d).select(c("seq").alias("id"), C.language(F.concat_ws(" ", "location", "description")).alias("language"), F.lit("posting").alias("kind"))
    docs = table(spark, d, "documents").select(c("doc_id").alias("id"), C.language(c("text")).alias("language"), F.lit("document").alias("kind"))
    return raw.unionByName(docs)


@query
def q_work_auth(spark, d):
    return raw_postings(spark, d).select("seq", F.array_join(C.authorization_blockers(c("description")), DASH).alias("blockers"))


@query
def q_required_lines(spark, d):
    return raw_postings(spark, d).select("seq", F.array_join(C.required_lines(C.html_text(c("description"))), "\n").alias("required"))


@query
def q_labels(spark, d):
    lab = C.labels() | {"work_authorization": F.array_join(C.labels()["work_authorization"], DASH)}
    return _normal(spark, d).select("seq", *[v.alias(k) for k, v in lab.items()])


@query
def q_title_marks(spark, d):
    return C.once(_normal(spark, d), "marked", C.title_marks()).select("seq", "marked", reports.vacancy_label(c("marked")).alias("label"))


@query
def q_normalize(spark, d):
    return _normal(spark, d).select("seq", "company", "title", "location", "remote", "description", "source_job_id", "track", "identity_key")


@query
def q_feed_entry(spark, d):
    out = postings.feed_entries(_normal(spark, d), F.lit("2024-02-01"), c("seq") % 2 == 0)
    return out.select("feed_key", "title", "role_key", "repeat_of_seen_role", "topic", "language", "description", "description_truncated")


# --- duplicates


@query
def q_dedup_roles(spark, d):
    return dedup.deduplicate(_stored(spark, d)).select("seq", "canonical_url", "title", "russian_company", F.array_join("advertised_locations", DASH).alias("locations"), "out_pos", "merged")


@query
def q_dedup_identity(spark, d):
    return dedup.by_identity(_stored(spark, d)).select("seq", "identity_key", "pos", "n")


@query
def q_dup_groups(spark, d):
    return dedup.duplicate_identities(_normal(spark, d)).select("identity_key", "count", "strategy", F.array_join("urls", DASH).alias("urls"))


@query
def q_dup_roles(spark, d):
    return dedup.duplicate_roles(_normal(spark, d))


@query
def q_strategy_counts(spark, d):
    return dedup.strategy_counts(_normal(spark, d))


@query
def q_doc_exact_dups(spark, d):
    return dedup.exact_duplicates(table(spark, d, "documents"), "doc_id", "text").select("digest", "keeper", "copies")


# --- incremental tables


@query
def q_fresh(spark, d):
    normal = _stored(spark, d)
    return incremental.select_fresh(_fresh_input(normal), _seen(normal)).select("seq", "key")


@query
def q_repeats(spark, d):
    normal = _stored(spark, d)
    seen = _seen(normal).where("company <> 'Acme  Apps'")
    fresh = storage.stash(incremental.select_fresh(_fresh_input(normal).select("seq", "canonical_url", "identity_key", "company", "title"), seen), "fresh")
    return incremental.role_repeats(fresh, seen).select("seq", "repeat")


@query
def q_new_roles(spark, d):
    """Which distinct roles on topic are new, with their labels."""
    normal = _stored(spark, d)
    unique = dedup.deduplicate(_fresh_input(normal))
    fresh = incremental.select_fresh(unique, _seen(normal), order="out_pos")
    lab = C.labels()
    return fresh.select("seq", "key", "company", "title", *[lab[k].alias(k) for k in ("topic", "level", "workable", "location_needs_check")])


@query
def q_mark_seen(spark, d):
    normal = _stored(spark, d)
    return incremental.mark_seen(_seen(normal), _fresh_input(normal), F.lit("2024-02-01"))


@query
def q_purge(spark, d):
    seen = storage.stash(_seen(_normal(spark, d)), "seen")
    live = seen.where("key LIKE '%/1?%' OR key LIKE '%/2?%'").select("key")
    closed = seen.where("key NOT LIKE '%/3?%'").select("key")
    names = spark.createDataFrame([("SoftServe",), ("  eleks ",), ("",)], "company string")
    return incremental.purge_seen(seen, live, names, closed).select("key", "company")


@query
def q_feed_append(spark, d):
    normal = _stored(spark, d)
    feed = postings.feed_entries(incremental.select_fresh(normal.where("seq % 3 = 0"), normal.limit(0).select(postings.feed_key().alias("key"))).drop("key"), F.lit("2024-01-01"), F.lit(False))
    return incremental.append_feed(feed, normal, F.lit("2024-02-01"), F.lit(True)).select("feed_key", "title", "first_seen", "repeat_of_seen_role")


@query
def q_hand_over(spark, d):
    """A run's end: fresh roles on topic, which of them repeat, and which go into the digest."""
    normal = _stored(spark, d)
    unique = storage.stash(dedup.deduplicate(_fresh_input(normal)), "unique")
    feed = postings.feed_entries(unique.where("false"), F.lit(""), F.lit(False))
    out = run.hand_over(unique, _seen(normal), feed, F.lit("2024-02-01"), F.lit("2024-02-02 00:00:00").cast("timestamp"))
    digest = out.digest.select("seq", F.lit(True).alias("in_digest"))
    return out.fresh.select("seq", "repeat").join(digest, "seq", "left").select("seq", "repeat", F.coalesce("in_digest", F.lit(False)).alias("in_digest"))


@query
def q_collect(spark, d):
    """A run's begin: rejections among the roles of sources that did not fail."""
    raw = raw_postings(spark, d).withColumn("source_id", F.concat(F.lit("company:c"), (c("seq") % 150).cast("string"), F.lit("@host")))
    return run.collect(_today(spark, d), raw, _baseline(spark, d), F.lit("2024-01-15"), save=storage.stash).rejections


@query
def q_evaluate(spark, d):
    cases = raw_postings(spark, d).withColumn("expected", c("seq") % 2 == 0)
    return run.evaluate(cases).withColumns({"precision": F.round("precision", 9), "recall": F.round("recall", 9)})


@query
def q_export_feed(spark, d):
    feed = table(spark, d, "orders").select(c("o_orderkey").cast("string").alias("feed_key"), c("o_orderpriority").alias("title"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_seen"))
    return run.export_feed(feed)


@query
def q_feed_prune(spark, d):
    feed = table(spark, d, "events").select(c("event_id").cast("string").alias("feed_key"), F.when(c("event_id") % 50 == 0, "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("first_seen"))
    return incremental.prune_feed(feed, F.lit("2024-02-10 00:00:00").cast("timestamp"))


@query
def q_cursors(spark, d):
    conv = table(spark, d, "conversations")
    stored = conv.groupBy((c("conv_id") % 50).alias("channel")).agg(F.max("turn").cast("string").alias("cursor"))
    stored = stored.withColumn("cursor", F.when(c("channel") % 9 == 0, "bad").otherwise(c("cursor")))
    read = table(spark, d, "events").groupBy((c("user_id") % 60).alias("channel")).agg((F.max("event_id") % 7).cast("string").alias("cursor"))
    return incremental.advance_cursors(stored, read)


@query
def q_checkpoint(spark, d):
    m = table(spark, d, "events").select(c("user_id").alias("channel"), c("event_id").alias("message_id"))
    cursors = m.where("channel % 2 = 0").select("channel", (c("channel") * 60).alias("cursor")).distinct()
    return incremental.checkpoint(m, cursors)


@query
def q_message_batch(spark, d):
    m = table(spark, d, "events").select(c("user_id").alias("channel"), c("event_id").alias("message_id"))
    cursors = m.where("channel % 2 = 0").select("channel", (c("channel") * 60).alias("cursor")).distinct()
    return messages.select_batch(m, cursors).select("channel", "message_id")


# --- source health


@query
def q_degraded(spark, d):
    return health.classify_degraded(_today(spark, d), _baseline(spark, d)).select("source_id", "status", "error")


@query
def q_baseline(spark, d):
    return health.update_baseline(_baseline(spark, d), _today(spark, d), F.lit("2024-01-15"))


@query
def q_empty_runs(spark, d):
    return health.empty_streaks(_runs(spark, d).select("source_id", "day", "items_scanned"), "source_id", "day", "items_scanned")


@query
def q_high_water(spark, d):
    return health.high_water(_runs(spark, d).select("source_id", "day", "items_scanned"), "source_id", "day", "items_scanned")


@query
def q_source_summary(spark, d):
    s = health.summarize_sources(_today(spark, d))
    return s.select(*[F.array_join(x, DASH).alias(x) if t.startswith("array") else c(x) for x, t in s.dtypes])


@query
def q_cursor_updates(spark, d):
    return health.cursor_updates(_today(spark, d))


@query
def q_outage(spark, d):
    return health.company_outage(_today(spark, d))


@query
def q_purgeable(spark, d):
    return health.purgeable_companies(_today(spark, d))


# --- reports


@query
def q_rejections(spark, d):
    return reports.rejection_counts(_normal(spark, d))


@query
def q_label_counts(spark, d):
    return reports.label_counts(_normal(spark, d))


@query
def q_run_counts(spark, d):
    normal = _stored(spark, d)
    return reports.run_counts(raw_postings(spark, d), normal, dedup.deduplicate(normal))


@query
def q_source_diag(spark, d):
    return reports.source_diagnostics(raw_postings(spark, d), _normal(spark, d))


@query
def q_quality_eval(spark, d):
    cases = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    out = reports.confusion(cases, c("n_chars") > 1000, c("quality") == 1)
    return out.withColumns({"precision": F.round("precision", 9), "recall": F.round("recall", 9)})


@query
def q_number_form(spark, d):
    return table(spark, d, "part").select("p_partkey", C.number_form(c("p_size") + c("p_partkey"), "one", "few", "many").alias("form"))


@query
def q_safe_error(spark, d):
    return table(spark, d, "pages").select("page_id", C.safe_error(F.concat(F.lit("GET "), "url", F.lit(" token s3cret failed")), ("s3cret",)).alias("error"))


@query
def q_chunk(spark, d):
    return reports.message_chunks(table(spark, d, "documents"), "doc_id", "text")


@query
def q_digest_pack(spark, d):
    normal = _normal(spark, d).withColumn("day", F.date_format("published_at", "yyyy-MM"))
    return reports.pack_digest(normal, key="day").select("digest", "part", "parts", "items", F.sha2("message", 256).alias("digest_hash"))


# --- calendar


def _clock(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", "ts")


@query
def q_slots_due(spark, d):
    return _clock(spark, d).select("event_id", calendar.due_slot(c("ts")).alias("due"), calendar.due_slot(c("ts"), P.KICK_LAG_MINUTES).alias("kick"), F.date_format(calendar.next_slot(c("ts")), "yyyy-MM-dd HH:mm").alias("next"), calendar.next_check_text(c("ts")).alias("text"))


@query
def q_slots_late(spark, d):
    clock = _clock(spark, d)
    done = clock.where("event_id % 40 = 0").select(calendar.local(c("ts")).cast("date").alias("day"), F.when(c("event_id") % 80 == 0, 8).otherwise(14).alias("slot")).distinct()
    return calendar.overdue_slots(clock, "ts", done, P.LATE_ALERT_MINUTES).select("event_id", "slot", "lag_minutes")


# --- company tables


def _companies(spark, d) -> DataFrame:
    return table(spark, d, "supplier").select(F.concat(F.lit("s"), c("s_suppkey").cast("string")).alias("slug"), c("s_name").alias("name"), F.when(c("s_suppkey") % 3 == 0, F.concat(F.lit("https://own/"), c("s_suppkey").cast("string"))).alias("career_url"), c("s_nationkey").alias("nation"))


def _from_customer(spark, d, when: str) -> DataFrame:
    return table(spark, d, "customer").where(when).select(F.concat(F.lit("s"), c("c_custkey").cast("string")).alias("slug"), c("c_name").alias("name"), F.concat(F.lit("https://c/"), c("c_custkey").cast("string")).alias("career_url"), c("c_nationkey").alias("nation"))


@query
def q_registry(spark, d):
    bespoke = _companies(spark, d).where("slug LIKE '%1'").select("slug")
    listed = _companies(spark, d).where("nation % 2 = 0").select("slug", F.when(c("nation") % 6 == 0, False).when(c("nation") % 6 == 2, True).alias("enabled"))
    return watchlist.build_registry(bespoke, listed, _companies(spark, d).where("nation % 3 = 0").select("slug"))


@query
def q_route(spark, d):
    boards = _companies(spark, d).where("nation < 8").select("slug", F.when(c("nation") == 0, "unknown").when(c("nation") < 4, "Greenhouse").otherwise("lever").alias("ats"), F.when(c("nation") == 5, " ").otherwise(c("name")).alias("token"))
    return watchlist.route(_companies(spark, d), watchlist.ats_boards(boards)).select("slug", "route", "token")


@query
def q_overrides(spark, d):
    return watchlist.apply_overrides(_companies(spark, d), _from_customer(spark, d, "c_custkey % 5 = 0"), _from_customer(spark, d, "c_custkey % 4 = 0")).select("slug", "career_url", "career_url_source")


@query
def q_watchlist_merge(spark, d):
    return watchlist.add_missing(_companies(spark, d), _from_customer(spark, d, "true"), "name")


@query
def q_preserve(spark, d):
    stored = _from_customer(spark, d, "c_custkey % 2 = 0")
    return watchlist.preserve_state(_companies(spark, d), stored, ["career_url"])


def _catalog_merged(spark, d) -> DataFrame:
    """Suppliers as the stored catalogue; customers as a fresh reading of it, every seventh of them a second time."""
    k, n = c("s_suppkey"), c("s_nationkey")
    stored = table(spark, d, "supplier").select(F.concat(F.lit(" S"), k.cast("string")).alias("slug"), F.when(k % 5 != 0, c("s_name")).alias("name"), F.when(k % 3 == 0, F.concat(F.lit("https://own/"), k.cast("string"))).alias("site_url"), F.when(k % 4 == 0, F.concat(F.lit("https://v/"), k.cast("string"))).alias("vacancies_url"), F.when(k % 6 != 0, n).alias("vacancy_count"))
    k, n = c("c_custkey"), c("c_nationkey")
    slug, site = F.concat(F.lit("s"), k.cast("string")), F.concat(F.lit("https://c/"), k.cast("string"))
    none = F.lit(None).cast("string")
    once = table(spark, d, "customer").select(slug.alias("slug"), F.when(k % 2 == 0, F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"))).when(k % 11 == 0, "").otherwise(c("c_name")).alias("name"), F.when(n % 2 == 0, site).alias("site_url"), none.alias("vacancies_url"), F.when(n % 3 != 0, n).alias("vacancy_count"), k.alias("seq"))
    again = table(spark, d, "customer").where("c_custkey % 7 = 0").select(F.upper(slug).alias("slug"), c("c_name").alias("name"), F.concat(site, F.lit("/2")).alias("site_url"), none.alias("vacancies_url"), F.when(n % 5 != 0, F.lit(0)).alias("vacancy_count"), (k + 1_000_000_000_000).alias("seq"))
    return watchlist.merge_catalog(stored, once.unionByName(again))


@query
def q_catalog_merge(spark, d):
    return _catalog_merged(spark, d)


@query
def q_catalog_stats(spark, d):
    return watchlist.catalog_stats(_catalog_merged(spark, d))


@query
def q_collect_list(spark, d):
    catalog = table(spark, d, "orders").groupBy(F.concat(F.lit("s"), c("o_custkey").cast("string")).alias("slug")).agg(F.count("*").alias("vacancy_count")).withColumn("name", c("slug"))
    return watchlist.collect_list(_companies(spark, d), catalog, 2)


@query
def q_recheck_topn(spark, d):
    catalog = _from_customer(spark, d, "true").select("slug")
    state = table(spark, d, "orders").where("o_orderkey % 2 = 0").groupBy(F.concat(F.lit("s"), c("o_custkey").cast("string")).alias("slug")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("checked_at"))
    return watchlist.recheck_list(catalog, _companies(spark, d), state, F.lit("1998-01-01"))


@query
def q_section_join(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return watchlist.join_sections(items, table(spark, d, "supplier").select("s_suppkey", "s_name"), "l_suppkey", "s_suppkey")


@query
def q_three_way_merge(spark, d):
    o = table(spark, d, "orders").select(c("o_orderkey").alias("k"), c("o_orderstatus").alias("v"))
    base = o.where("k % 5 <> 4")
    local = o.where("k % 7 <> 3").select("k", F.when(c("k") % 11 == 0, "L").otherwise(c("v")).alias("v"))
    remote = o.where("k % 9 <> 2").select("k", F.when(c("k") % 13 == 0, "R").otherwise(c("v")).alias("v"))
    return state_merge.merge_three_way(base, local, remote, "k", "v")


@query
def q_carry_forward(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(c("o_orderkey") % 4 == 0, c("o_orderpriority")).alias("heading"))
    return watchlist.carry_forward(rows, "o_custkey", "o_orderkey", "heading").select("o_orderkey", "carried")


@query
def q_latest_period(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM-yyyy").alias("period"))
    return watchlist.latest_period(rows, "period")


LINK_HOSTS = ["jobs.lever.co", "x.teamtailor.com", "greenhouse.io.example.com", "acme.io", "boards.greenhouse.io", "notgreenhouse.io", "COMEET.co", "me@apply.workable.com:8443"]
LINK_PATHS = ["/careers/", "/blog/greenhouse.html?n=", "/open-position/", "/news/jobs/", "/about/", "/VACANCIES?x=", "/article-job/"]
LINK_LABELS = ["Jobs", "Home", "Our careers", "Hiring", "Open_Position"]


@query
def q_top_links(spark, d):
    """Links of twenty pages each; the best link to a careers page among them."""
    k = c("page_id")
    pick = lambda values, by: F.get(F.array(*[F.lit(x) for x in values]), (by % len(values)).cast("int"))
    url = F.concat(F.lit("https://"), pick(LINK_HOSTS, k * 7 + F.length("url")), pick(LINK_PATHS, k * 3 + F.length("html")), k.cast("string"))
    links = table(spark, d, "pages").select(F.floor(k / 20).alias("grp"), url.alias("url"), pick(LINK_LABELS, F.length("html")).alias("label"))
    return watchlist.best_link(links, "grp", watchlist.candidate_score(c("url"), c("label")), "url").select("grp", "url", "score")


# --- parsers over captured bodies


def _part(spark, d) -> DataFrame:
    return table(spark, d, "part")


@query
def q_ats_parse(spark, d):
    """Boards of two systems written from parts, parsed back."""
    def board(kind, items, wrap):
        job = F.to_json(F.struct(*[v.alias(k) for k, v in items.items()]))
        body = F.concat(F.lit(wrap[0]), F.array_join(F.array_sort(F.collect_list(job)), ","), F.lit(wrap[1]))
        return _part(spark, d).groupBy(F.floor(c("p_partkey") / 100).alias("source_id")).agg(body.alias("body")).withColumn("kind", F.lit(kind))

    url = F.when(c("p_size") % 10 == 0, F.lit("http://x")).otherwise(F.concat(F.lit("https://x/"), c("p_partkey").cast("string")))
    gh = board("greenhouse", {"id": c("p_partkey"), "title": c("p_name"), "absolute_url": url, "location": F.struct(c("p_brand").alias("name")), "content": F.lit("a &amp; b")}, ('{"jobs":[', "]}"))
    lv = board("lever", {"id": c("p_partkey"), "text": c("p_name"), "hostedUrl": url, "workplaceType": F.when(c("p_size") > 25, "remote"), "descriptionPlain": c("p_type")}, ("[", "]"))
    a, b = feeds.parse_ats(gh, "greenhouse"), feeds.parse_ats(lv, "lever")
    return a.select(F.lit("greenhouse").alias("ats"), "title", "url", "location", "description", "job_id", "remote").unionByName(b.select(F.lit("lever").alias("ats"), "title", "url", "location", "description", "job_id", "remote"))


@query
def q_rss_parse(spark, d):
    """Feeds written from parts, parsed back without a topic gate."""
    k = c("p_partkey").cast("string")
    item = F.concat(F.lit("<item><title>"), "p_name", F.lit(" в "), "p_brand", F.lit(", Київ, від $100, remote</title><link>https://x/vacancies/"), k, F.lit("/?utm_source=r&amp;q=1</link><pubDate>Mon, 01 Jan 2024 10:00:00 +0200</pubDate><description>&lt;b&gt;x&lt;/b&gt;</description></item>"))
    body = F.concat(F.lit("<rss><channel>"), F.array_join(F.array_sort(F.collect_list(item)), ""), F.lit("</channel></rss>"))
    bronze = _part(spark, d).groupBy(F.floor(c("p_partkey") / 100).alias("source_id")).agg(body.alias("body"))
    out = feeds.parse_rss(bronze, title_filter=lambda t: F.lit(True))
    return out.select("title", "company", "location", "remote", "url", F.date_format("published_at", "yyyy-MM-dd HH:mm").alias("published_at"), "description", "source_job_id")


@query
def q_sitemap(spark, d):
    body = F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.array_sort(F.collect_list("url")), lambda u: F.concat(F.lit("<url><loc>"), u, F.lit("</loc></url>"))), ""), F.lit("</urlset>"))
    bronze = table(spark, d, "pages").groupBy(F.floor(c("page_id") / 100).alias("source_id")).agg(body.alias("body"))
    return feeds.parse_sitemap(bronze, "[0-9]")


@query
def q_html_links(spark, d):
    bronze = table(spark, d, "pages").select(c("page_id").alias("source_id"), c("html").alias("body"))
    return feeds.parse_listing(bronze, r'<a href="([^"]*)">([^<]*)</a>', 1, 2, "https://x").select("source_id", "url", "title")


@query
def q_html_dom_links(spark, d):
    df = table(spark, d, "pages").select("page_id", F.explode(html.page_links(c("html"))).alias("x"))
    return df.select("page_id", "x.pos", "x.href", "x.text")


@query
def q_page_titles(spark, d):
    return table(spark, d, "pages").select("page_id", html.page_title(c("html")).alias("title"))


@query
def q_page_signals(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_join(html.page_signals(c("html"), ("the", "que", "der", "los")), DASH).alias("signals"))


@query
def q_count_gaps(spark, d):
    pages = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.floor(c("o_totalprice") / 1000).alias("shown"))
    return html.count_gaps(pages, "o_custkey", "o_orderkey", "shown").select("o_orderkey", "before")


@query
def q_messages(spark, d):
    """Postings of messages made from raw postings, and the filters of real conversation turns."""
    raw = raw_postings(spark, d)
    head = F.when(c("seq") % 4 == 0, F.concat(F.lit("Company: "), "company")).when(c("seq") % 4 == 1, F.concat("company", F.lit(" is hiring"))).otherwise(F.lit("#vacancy"))
    text = F.concat(head, F.lit("\n"), "title", F.lit("\nLocation: "), C.text(c("location")), F.lit("\nhttps://t.me/x https://apply.example.com/"), c("seq").cast("string"), F.lit("."))
    m = raw.select(F.concat(F.lit("ch"), (c("seq") % 3).cast("string")).alias("channel"), c("seq").alias("message_id"), text.alias("text"), "published_at", F.array().cast("array<string>").alias("urls"))
    return messages.postings_from_messages(m).drop("published_at")


@query
def q_message_filters(spark, d):
    t = c("text")
    return table(spark, d, "conversations").select("conv_id", "turn", messages.is_candidate_post(t).alias("candidate"), messages.looks_like_vacancy(t).alias("vacancy"), messages.apply_url(t).alias("apply_url"))


@query
def q_stream_seen(spark, d):
    """Events delivered by a stream in one pass equal the batch's first row of each key."""
    import uuid

    from jobloom.streaming import delivery

    root = f"{storage.shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    source = f"{d}/events.parquet"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(source if not source.endswith(".parquet") else f"{d}/events*.parquet")
    stream = stream.withColumn("key", F.concat_ws("/", c("user_id").cast("string"), "event_type"))
    delivery.deliver(stream, "key", "event_id", f"{root}/feed", f"{root}/checkpoint").awaitTermination()
    return storage.read_table(spark, f"{root}/feed", "key string, event_id long")
