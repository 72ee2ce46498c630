"""Chat messages: which to keep, and the postings they hold.

``messages(channel, message_id, text, published_at, urls array<string>, entities array<struct<offset: int,
length: int, url: string>>)``. All rules are Column expressions over the message's lines; only the offsets of link
entities, which count UTF-16 units, are converted in an Arrow UDF.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C

# --- fixed values: message vocabulary -------------------------------------------------------------------------
CANDIDATE_HASHTAGS = ("candidates", "candidate", "резюме", "resume", "resumes", "cv", "ищу", "candidatebench")
CANDIDATE_PHRASES = ("looking for new opportunities", "looking for opportunities", "open to work", "open for opportunities", "ищу работу", "ищу роботу", "ищу позицию", "ищу позицію", "шукаю роботу", "шукаю проєкт", "шукаю проект", "available candidate", "propose partnership", "white-label", "outstaffing projects", "outsourcing & outstaffing")
VACANCY_HASHTAGS = ("вакансія", "вакансия", "vacancy", "job", "jobs", "hiring", "itjobs", "remote_jobs", "remotejobs", "techjobs", "ищут")
VACANCY_PHRASES = ("вакансія", "вакансия", "job opportunity", "jobs opportunity", "we're hiring", "we are hiring", "now hiring", "hiring:", "hiring ", "looking for", "шукаємо", "шукає", "ищем", "ищут", "за деталями", "open role", "open position", "open positions", "ready to apply", "apply using the button", "how to apply", "send your resume", "send your cv", "send dm", "job description:")
TITLE_NOISE = ("job opportunity", "ready to apply", "apply using the button below", "apply using the button", "tags", "how to apply")
SKIPPED_HOSTS = ("t.me", "telegram.me", "telegram.org")
COMPANY_FIELDS = (r"company(?:\s+name)?\s*[:\-]", r"компані[яя]\s*[:\-]", r"компания\s*[:\-]", r"название\s+компании\s*[:\-]", r"назва\s+компанії\s*[:\-]")
HIRING_VERBS = (r"шука(?:[єе]|ють)\b", r"ищ(?:ет|ут)\b", r"(?:is|are)\s+hiring\b", r"(?:(?:is|are)\s+)?looking\s+for\b")
SUBJECT_STOPWORDS = ("we", "we're", "i", "our", "the", "a", "an", "this", "who", "they", "client", "team", "startup", "product", "hiring", "job", "vacancy", "мы", "ми", "я", "наш", "наша", "наші", "наши", "команда", "клиент", "клієнт", "вакансія", "вакансия", "in", "if", "as", "for", "currently", "now", "hi", "hello")
SENTENCE_WORDS = ("you", "your", "we", "our", "will", "be", "role", "position", "who", "which")
COMPANY_WORDS, TITLE_LINES = 6, 8
ROLE_WORD = r"\b(?:developer|engineer|programmer|lead|architect|dev|розробник|розробниця|інженер|разработчик|программист|инженер)\b"
DEFAULT_TITLE = "iOS / Swift vacancy"
BOT_CHANNEL, BOT_SUBSCRIPTION = "hirifyme_bot", "по подписке:"
BOT_HEADING = r"(?mdU)^\s*(.+?)\s+в\s+([^\n]+?)\s*$"
BACKFILL_LIMIT, CATCH_UP_LIMIT, LOOKBACK = 30000, 3000, 100
BOARD_URL = r"^https?://(?:www\.)?hirify\.me/jobs/(\d+)"


def _any(c: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w))


def hashtags(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)#(\w+)"), 1)


def is_candidate_post(text: Column) -> Column:
    tag = lambda t: t.isin(*CANDIDATE_HASHTAGS) | t.startswith("резюме") | t.startswith("resume") | (t.startswith("ищу") & ~t.startswith("ищут"))
    return F.exists(hashtags(text), tag) | _any(F.lower(text), CANDIDATE_PHRASES)


def looks_like_vacancy(text: Column) -> Column:
    return F.exists(hashtags(text), lambda t: t.isin(*VACANCY_HASHTAGS)) | _any(F.lower(text), VACANCY_PHRASES)


def is_bot(channel: Column) -> Column:
    """The channel whose messages are one posting each, under a heading of title and employer."""
    return C.text(channel.cast("string")) == BOT_CHANNEL


def should_keep(text: Column, channel: Column | None = None) -> Column:
    text, bot = C.text(text), is_bot(channel) if channel is not None else F.lit(False)
    return (C.strip(text) != "") & ~is_candidate_post(text) & C.is_target_job(text) & F.when(bot, text.rlike(BOT_HEADING)).otherwise(looks_like_vacancy(text))


def clean_line(c: Column) -> Column:
    return C.strip(F.regexp_replace(F.regexp_replace(C.squeeze(c), r"^[ \-–—|━_]+|[ \-–—|━_]+$", ""), r"(?U)^[\W_]+", ""))


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(C.text(text), r"\r\n|\r|\n"), C.strip), lambda x: x != "")


def _noise(line: Column) -> Column:
    low = F.lower(clean_line(line))
    tags = C.matches(line, r"^(?:#\w[\w+-]*\s*)+$")
    return (low == "") | low.isin(*TITLE_NOISE) | C.matches(low, r"^(?:company|компані[яя])\s*[:\-]") | tags


def extract_title(text: Column) -> Column:
    """A labelled title, else the first of the first lines that names a role on topic, else the first line."""
    labelled = clean_line(F.regexp_extract(C.text(text), r"(?imU)^[^\w#]*(?:title|position|job title)\s*:\s*(.+)$", 1))
    kept = F.transform(F.filter(_lines(text), lambda x: ~_noise(x)), lambda x: F.regexp_replace(clean_line(x), r"(?iu)^(?:вакансия|вакансія|vacancy)\s*[:\-–—]?\s+", ""))
    lines = F.slice(F.transform(F.filter(kept, lambda x: x != ""), lambda x: F.substring(x, 1, 160)), 1, TITLE_LINES)
    named = F.filter(lines, lambda x: C.matches(x, ROLE_WORD) & C.is_target_job(x))
    return F.when(labelled != "", F.substring(labelled, 1, 160)).otherwise(F.coalesce(F.get(named, 0), F.get(lines, 0), F.lit(DEFAULT_TITLE)))


def _clean_company(c: Column) -> Column:
    c = F.regexp_replace(C.squeeze(c), r"^[ \-–—|🎯🚀⚓️🏢]+|[ \-–—|🎯🚀⚓️🏢]+$", "")
    c = F.regexp_replace(F.regexp_replace(c, r"^(?:#\S+\s*)+", ""), r'(?U)^[^\w"«(]+', "")
    return F.regexp_replace(c, r"^[ .,:;!\-–—]+|[ .,:;!\-–—]+$", "")


def extract_company(text: Column) -> Column:
    """A labelled employer, else the subject of a hiring phrase that reads like a name, else null."""
    text, options = C.text(text), []
    sized = lambda c: F.length(c).between(2, 80)
    for field in COMPANY_FIELDS:
        c = _clean_company(F.regexp_extract(text, rf"(?imuU)^[^\w#]*{field}\s*(.+)$", 1))
        options.append(F.when(sized(c), c))

    def plausible(c):
        words = F.transform(F.split(F.lower(F.replace(c, F.lit("’"), F.lit("'"))), " "), lambda w: F.regexp_replace(w, "^[\"'«»,.]+|[\"'«»,.]+$", ""))
        return sized(c) & (F.size(words) <= COMPANY_WORDS) & ~F.get(words, 0).isin(*SUBJECT_STOPWORDS) & ~F.exists(words, lambda w: w.isin(*SENTENCE_WORDS))

    for verb in HIRING_VERBS:
        found = F.regexp_extract_all(text, F.lit(rf"(?imuU)^(.{{2,80}}?)\s+{verb}"), 1)
        names = F.transform(found, lambda x: F.regexp_replace(_clean_company(x), r"(?iu)^(?:company|компания|компанія)\s+", ""))
        options.append(F.get(F.filter(names, plausible), 0))
    return F.coalesce(*options)


def apply_url(text: Column) -> Column:
    """The first link that does not lead to the messenger itself."""
    urls = F.transform(F.regexp_extract_all(C.text(text), F.lit(r"(?i)(https?://[^\s)>\]]+)"), 1), lambda u: F.regexp_replace(u, "[.,;\"']+$", ""))
    host = lambda u: F.lower(F.regexp_extract(u, r"(?i)^https?://(?:[^/?#]*@)?([^/?#:]*)", 1))
    own = lambda h: h.isin("", *SKIPPED_HOSTS) | F.exists(F.array(*[F.lit(f".{s}") for s in SKIPPED_HOSTS]), lambda s: F.endswith(h, s))
    return F.get(F.filter(urls, lambda u: ~own(host(u))), 0)


def preferred_url(urls: Column) -> Column:
    """A board's own link first, then the first that leads outside."""
    tidy = F.filter(F.transform(F.coalesce(urls, F.array().cast("array<string>")), C.strip), lambda u: C.text(u) != "")
    return F.coalesce(F.get(F.filter(tidy, lambda u: C.matches(u, BOARD_URL)), 0), apply_url(F.array_join(tidy, "\n")))


def snippet(text: Column, title: Column, limit: int = 140) -> Column:
    lines = F.filter(F.transform(_lines(text), C.squeeze), lambda x: (x != title) & ~C.matches(x, r"^(?:#\w[\w+-]*\s*)+$"))
    blob = C.strip(C.squeeze(F.when(F.size(lines) > 0, F.array_join(lines, " · ")).otherwise(C.strip(C.text(text)))))
    return F.when(F.length(blob) <= limit, blob).otherwise(F.concat(F.regexp_replace(F.substring(blob, 1, limit - 1), r"\s+$", ""), F.lit("…")))


def _posting_url(c=F.col) -> Column:
    return F.coalesce(preferred_url(c("urls")), apply_url(c("text")))


def _yields(c=F.col) -> Column:
    """Whether a message gives a posting; one of the bot's must also link to its board."""
    return should_keep(c("text"), c("channel")) & (~is_bot(c("channel")) | F.coalesce(_posting_url().rlike("(?i)" + BOARD_URL), F.lit(False)))


def postings_from_messages(messages: DataFrame) -> DataFrame:
    """At most one posting a message."""
    c, bot = F.col, is_bot(F.col("channel"))
    kept = messages.where(_yields()).withColumn("link", _posting_url())
    heading = lambda i: clean_line(F.regexp_extract("text", BOT_HEADING, i))
    kept = kept.withColumn("title", F.when(bot, heading(1)).otherwise(extract_title(c("text"))))
    board = F.regexp_extract("link", "(?i)" + BOARD_URL, 1)
    return kept.select(
        F.when(bot, heading(2)).otherwise(F.coalesce(extract_company(c("text")), F.lit(""))).alias("company"), "title", F.coalesce("link", F.format_string("https://t.me/%s/%s", "channel", "message_id")).alias("url"),
        F.when(bot, "hirify.me").otherwise("telegram").alias("source"), F.when(C.text(board) != "", F.concat(F.lit("hirify:"), board)).otherwise(F.format_string("%s:%s", "channel", "message_id")).alias("source_job_id"),
        snippet(c("text"), c("title"), 4000).alias("description"), "published_at",
    )


def code_point_spans(text: Column, entities: Column) -> Column:
    """Link entities in UTF-16 units -> spans in code points, in order."""

    def one(t, es):
        raw = (t or "").encode("utf-16-le")
        at = lambda n: len(raw[: 2 * n].decode("utf-16-le", errors="ignore"))
        out = [{"start": at(e["offset"]), "end": at(e["offset"] + e["length"]), "url": e["url"].strip()} for e in (es if es is not None else ()) if e["url"] is not None and e["offset"] is not None and e["length"] is not None]
        return sorted(out, key=lambda s: (s["start"], s["end"], s["url"]))

    @F.pandas_udf("array<struct<start: int, end: int, url: string>>")
    def run(t: pd.Series, e: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(t, e)])

    return run(text, entities)


def postings_from_digests(messages: DataFrame) -> DataFrame:
    """Each link of a digest as a posting; a link's block runs to the next link."""
    spans = messages.select("channel", "message_id", "text", "published_at", F.posexplode(code_point_spans(F.col("text"), F.col("entities"))).alias("idx", "s"))
    nxt = F.lead("s.start").over(Window.partitionBy("channel", "message_id").orderBy("idx"))
    df = spans.withColumn("block_end", F.coalesce(nxt, F.length("text")))
    piece = lambda a, b: F.expr(f"substring(text, {a} + 1, greatest({b} - {a}, 0))")
    df = df.withColumns({"link": F.regexp_replace(C.squeeze(piece("s.start", "s.end")), r"^[ \-–—]+|[ \-–—]+$", ""), "rest": F.regexp_extract(F.expr("substring(text, s.end + 1)"), r"^([^\n]*)", 1), "block": piece("s.end", "block_end")})
    after = C.strip(F.regexp_extract("rest", r"^\s*@\s*(.+)", 1))
    split = (after == "") & F.col("link").contains(" at ")
    title = F.when(split, C.strip(F.regexp_extract("link", r"^(.*) at (.*)$", 1))).otherwise(F.col("link"))
    company = F.when(split, C.strip(F.regexp_extract("link", r"^(.*) at (.*)$", 2))).otherwise(after)
    location = F.nullif(C.strip(F.regexp_extract("block", r"(?im)^\W*locations?\s*:\s*(.+)$", 1)), F.lit(""))
    out = df.select(company.alias("company"), title.alias("title"), F.col("s.url").alias("url"), F.lit("telegram").alias("source"), F.format_string("%s:%s:%s", "channel", "message_id", "idx").alias("source_job_id"), location.alias("location"), F.lit("").alias("description"), "published_at")
    return out.where((F.col("title") != "") & C.is_target_job(F.col("title")))


def malformed_counts(messages: DataFrame) -> DataFrame:
    """``channel, messages, malformed``: the bot's messages that announce a posting on topic and give none are counted, never
    fatal, since the cursor moves past them. Messages without an id were not read."""
    c, text = F.col, C.strip(C.text(F.col("text")))
    announced = C.is_target_job(text) & (F.contains(F.lower(text), F.lit(BOT_SUBSCRIPTION)) | text.rlike(BOT_HEADING))
    bad = is_bot(c("channel")) & announced & ~_yields()
    return messages.where("message_id IS NOT NULL").withColumn("text", text).groupBy("channel").agg(F.count("*").alias("messages"), F.count_if(bad).alias("malformed"))


def is_recent(published_at: Column, now: Column, days: int = 30) -> Column:
    return F.coalesce(published_at >= now - F.make_dt_interval(F.lit(days)), F.lit(True))


def read_mode(cursor: Column, channel: Column, since: Column | None = None) -> Column:
    """How a channel is read: ``backfill`` from a day on where one is given, but never the bot; ``first`` for a bot without a cursor, which only
    starts it; ``catch_up`` after a cursor; ``lookback`` for another channel without one."""
    back = F.lit(False) if since is None else ~is_bot(channel)
    return F.when(back, "backfill").when(cursor.isNotNull(), "catch_up").when(is_bot(channel), "first").otherwise("lookback")


def select_batch(messages: DataFrame, cursors: DataFrame, catch_up: int = CATCH_UP_LIMIT, lookback: int = LOOKBACK, since: Column | None = None, backfill: int = BACKFILL_LIMIT) -> DataFrame:
    """The messages a run reads of each channel, with their ``mode`` and the ``cursor`` there was.

    After a cursor the oldest first, at most ``catch_up``; without one the latest ``lookback``, or of a bot the latest alone; from the day
    ``since`` on the newest first, at most ``backfill``, up to the first message before that day. Those limits are the feature: what
    catching up leaves is read by later runs. Messages without an id are none.
    """
    c, at = F.col, Window.partitionBy("channel")
    df = messages.where("message_id IS NOT NULL").join(cursors.select("channel", F.col("cursor").alias("cursor")), "channel", "left")
    df = df.withColumn("mode", read_mode(c("cursor"), c("channel"), since))
    if since is not None:
        stop = df.where((c("mode") == "backfill") & (c("published_at") < since)).groupBy("channel").agg(F.max("message_id").alias("_stop"))
        df = df.join(stop, "channel", "left").where((c("mode") != "backfill") | c("_stop").isNull() | (c("message_id") > c("_stop"))).drop("_stop")
    df = df.where((c("mode") != "catch_up") | (c("message_id") > c("cursor")))
    rn = F.row_number().over(at.orderBy(F.when(c("mode") == "catch_up", c("message_id")).otherwise(-c("message_id"))))
    most = F.when(c("mode") == "catch_up", catch_up).when(c("mode") == "lookback", lookback).when(c("mode") == "first", 1).otherwise(backfill)
    # The rank is bounded by the largest limit first, so that Spark keeps no more than that of a channel.
    return df.withColumn("_rn", rn).where(F.col("_rn") <= max(catch_up, lookback, backfill if since is not None else 1)).where(F.col("_rn") <= most).drop("_rn")


def emitted(batch: DataFrame, now: Column) -> DataFrame:
    """The rows of a batch that can give postings: none of a bot's first run, and outside a backfill no post that is too old, but the bot's."""
    old = (F.col("mode") != "backfill") & ~is_bot(F.col("channel")) & ~is_recent(F.col("published_at"), now)
    return batch.where((F.col("mode") != "first") & ~old)


def next_cursors(batch: DataFrame) -> DataFrame:
    """``(channel, cursor, scanned)`` after a batch: the highest id read, never below the cursor there was; a backfill moves none."""
    read = batch.where("mode <> 'backfill'").groupBy("channel").agg(F.max("message_id").alias("last"), F.max("cursor").alias("cursor"), F.count("*").alias("scanned"))
    return read.select("channel", F.greatest("last", F.coalesce("cursor", F.col("last"))).alias("cursor"), "scanned")
