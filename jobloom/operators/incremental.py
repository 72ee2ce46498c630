"""Incremental tables: the history of seen postings, the hand-over feed, cursors and slots.

Each operator is a join against the stored table and returns rows to append or the next version of the
table; storage is any format Spark writes. The run's rows are the small side, so history is scanned once
and AQE may broadcast the run's keys; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions import policy as P
from jobloom.operators.postings import feed_entries, feed_key

PRIVATE_FIELDS = ("disposition", "applied_at")


def seen_key() -> Column:
    return feed_key()


def first_rows(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key: a grouped minimum, so rows of a hot key meet in their own tasks before the shuffle."""
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*rows.columns), F.struct(order)).alias("_first")).select("_first.*")


def select_fresh(postings: DataFrame, seen: DataFrame, gate: bool = True, order: str = "seq") -> DataFrame:
    """Postings whose key is new, the first of each key. ``seen(key, ...)``."""
    if not gate:
        return postings
    keyed = postings.withColumn("key", seen_key()).where("key <> ''")
    return first_rows(keyed.join(seen.select("key"), "key", "left_anti"), "key", order)


def seen_roles(seen: DataFrame) -> DataFrame:
    both = (C.text(F.col("company")) != "") & (C.text(F.col("title")) != "")
    return seen.where(both).select(C.canonical_company(F.col("company")).alias("_c"), C.role_family_title(F.col("title")).alias("_t")).distinct()


def role_repeats(fresh: DataFrame, seen: DataFrame, order: str = "seq") -> DataFrame:
    """``fresh`` with ``repeat``: its role family was seen before or stands earlier in this run. Postings of an unknown
    employer never repeat and never count."""
    known = C.strip(C.text(F.col("company"))) != ""
    df = fresh.withColumns({"_c": F.when(known, C.canonical_company(F.col("company"))), "_t": F.when(known, C.role_family_title(F.col("title")))})
    here = df.where("_c IS NOT NULL").groupBy("_c", "_t").agg(F.min(order).alias("_from"))
    roles = here.join(seen_roles(seen).withColumn("_seen", F.lit(True)), ["_c", "_t"], "left")
    df = df.join(roles, ["_c", "_t"], "left")
    again = F.coalesce(F.col("_seen") | (F.col(order) > F.col("_from")), F.col(order) > F.col("_from"), F.lit(False))
    return df.withColumn("repeat", again).drop("_c", "_t", "_from", "_seen")


def mark_seen(seen: DataFrame, postings: DataFrame, first_seen: Column, order: str = "seq") -> DataFrame:
    """History with the new keys put in; rows already there stay as they are."""
    new = select_fresh(postings, seen, order=order).select("key", "title", "company", first_seen.alias("first_seen"))
    return seen.select("key", "title", "company", "first_seen").unionByName(new)


def sanitize_seen(seen: DataFrame) -> DataFrame:
    return seen.drop(*PRIVATE_FIELDS)


def purge_seen(seen: DataFrame, live: DataFrame, purgeable: DataFrame, closed: DataFrame) -> DataFrame:
    """History without the keys that are confirmed closed, of a purgeable company and not live.

    ``live(key)``, ``purgeable(company)``, ``closed(key)``; with no closed key nothing goes.
    """
    token = C.normalize_token(F.col("company")).alias("_token")
    names = purgeable.select(token).where("_token <> ''").distinct()
    dead = seen.select("key", token).where("_token <> ''").join(closed.select("key"), "key", "left_semi").join(names, "_token", "left_semi").join(live.select("key"), "key", "left_anti")
    return seen.join(dead.select("key"), "key", "left_anti")


def append_feed(feed: DataFrame, postings: DataFrame, first_seen: Column, repeat: Column, order: str = "seq") -> DataFrame:
    """The feed with entries of the keys it lacks, the first posting of each key; only those get labels."""
    keyed = postings.withColumn("feed_key", feed_key()).where("feed_key <> ''").join(feed.select("feed_key"), "feed_key", "left_anti")
    first = first_rows(keyed, "feed_key", order).drop("feed_key")
    return feed.unionByName(feed_entries(first, first_seen, repeat))


def prune_feed(feed: DataFrame, now: Column, days: int = P.RETENTION_DAYS) -> DataFrame:
    """Entries first seen in the last ``days``; those without a readable time stay."""
    seen_at = F.try_to_timestamp(F.col("first_seen").cast("string"))
    return feed.where(F.coalesce(seen_at >= now - F.make_dt_interval(F.lit(days)), F.lit(True)))


def advance_cursors(stored: DataFrame, read: DataFrame) -> DataFrame:
    """``(channel, cursor)`` of both, never going back; values that are no positive integer are dropped."""
    tidy = lambda df: df.select("channel", F.expr("try_cast(cursor AS BIGINT)").alias("cursor")).where("cursor > 0")
    return tidy(stored).unionByName(tidy(read)).groupBy("channel").agg(F.max("cursor").alias("cursor"))


def checkpoint(messages: DataFrame, cursors: DataFrame) -> DataFrame:
    """For each channel the highest message id, never below its cursor, and how many messages were scanned."""
    read = messages.groupBy("channel").agg(F.max("message_id").alias("last"), F.count("*").alias("scanned"))
    return read.join(cursors, "channel", "left").select("channel", F.greatest("last", F.coalesce("cursor", F.lit(0))).alias("checkpoint"), "scanned")


def mark_slot(slots: DataFrame, day: Column, slot: Column) -> DataFrame:
    new = slots.sparkSession.range(1).select(day.alias("day"), slot.alias("slot"))
    return slots.select("day", "slot").union(new).distinct()
