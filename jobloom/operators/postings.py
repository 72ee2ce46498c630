"""From raw postings to normal postings, and their feed entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions import policy as P

RAW = "seq long, company string, title string, url string, source string, location string, remote string, published_at string, description string, source_job_id string, track string, russian_company boolean"


def _blank_to_null(c: Column) -> Column:
    return F.nullif(C.strip(c), F.lit(""))


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 with ``Z`` or an offset; what cannot be read is null."""
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))


def with_keys(postings: DataFrame) -> DataFrame:
    """Add the canonical url and the identity key with its strategy."""
    df = C.with_canonical_url(postings).withColumn("_company", C.canonical_company(F.col("company")))
    key = C.identity_key(F.col("_company"), F.col("canonical_url"), F.col("source"), F.col("source_job_id"))
    return df.withColumns({"identity_key": key, "identity_strategy": C.identity_strategy(F.col("canonical_url"), F.col("source_job_id"))}).drop("_company")


def _cleaned(raw: DataFrame) -> DataFrame:
    """All rows of ``RAW``: texts stripped, ids the first that is not blank, gaps filled."""
    c = F.col
    return raw.withColumns({
        "title": C.strip(C.text(c("title"))), "company": C.strip(C.text(c("company"))), "url": C.strip(C.text(c("url"))),
        "description": _blank_to_null(c("description")), "track": F.coalesce(F.nullif(c("track"), F.lit("")), F.lit("ios")),
        "location": C.strip(F.nullif(c("location"), F.lit(""))), "source": F.coalesce("source", F.lit("company")),
        "source_job_id": _blank_to_null(c("source_job_id")), "russian_company": F.coalesce("russian_company", F.lit(False)),
    })


def _is_complete() -> Column:
    return (F.col("title") != "") & (F.col("url") != "")


def _is_on_topic() -> Column:
    return (F.col("track") != "ios") | F.col("topic").isNotNull()


def normalize(raw: DataFrame) -> DataFrame:
    """Rows of ``RAW`` that have a title and a link and, on the platform track, are on topic.

    Missing work modes are inferred, unreadable times are null, ids keep the first that is not blank. ``topic`` and ``primary``
    are found here once, and every later operator reads them.
    """
    c = F.col
    df = C.with_topic(_cleaned(raw).where(_is_complete())).where(_is_on_topic())
    unknown = F.lower(C.strip(C.text(c("remote")))).isin("", "unknown")
    df = df.withColumn("_low", F.when(unknown, F.lower(F.concat_ws(" ", "title", C.text(c("location")), C.text(c("description"))))))
    df = df.withColumn("remote", F.when(c("_low").isNull(), c("remote")).otherwise(C.mode_of(c("_low")))).drop("_low")
    if dict(df.dtypes)["published_at"] == "string":
        df = df.withColumn("published_at", iso_timestamp(c("published_at")))
    return with_keys(df)


def judge(raw: DataFrame) -> DataFrame:
    """All rows of ``RAW``, cleaned, with ``admitted``: whether ``normalize`` keeps the row as a candidate for the digest."""
    return C.with_topic(_cleaned(raw)).withColumn("admitted", F.coalesce(_is_complete() & _is_on_topic() & is_inbox(), F.lit(False)))


def is_inbox() -> Column:
    """Whether a normal posting is a candidate for the digest."""
    return (F.col("track") == "ios") & F.col("primary")


def is_handover() -> Column:
    """Whether a normal posting goes to the hand-over feed."""
    return (F.col("track") == "ai") | F.col("topic").isNotNull()


def feed_key() -> Column:
    return F.when(F.col("canonical_url") != "", F.col("canonical_url")).otherwise(F.col("identity_key"))


def feed_entries(postings: DataFrame, first_seen: Column, repeat: Column) -> DataFrame:
    """One feed row a posting: key, posting, labels, language and the cut plain text."""
    c = F.col
    df = C.once(postings, "plain", C.html_text(c("description")))
    df = C.once(df, "body", C.strip(F.regexp_replace("plain", r"[ \t]*\n\s*", "\n")))
    family = F.concat_ws(" | ", C.canonical_company(c("company")), C.role_family_title(c("title")))
    locations = c("advertised_locations") if "advertised_locations" in postings.columns else F.array().cast("array<string>")
    return df.select(
        feed_key().alias("feed_key"), "company", "title", "url", "source", "location", locations.alias("advertised_locations"), "published_at", first_seen.alias("first_seen"),
        F.when(C.strip(c("company")) != "", family).alias("role_key"), repeat.alias("repeat_of_seen_role"),
        *[v.alias(k) for k, v in C.labels(c("plain")).items()],
        C.language(F.concat_ws(" ", "title", "body")).alias("language"), F.substring("body", 1, P.DESCRIPTION_LIMIT).alias("description"), (F.length("body") > P.DESCRIPTION_LIMIT).alias("description_truncated"),
    )
