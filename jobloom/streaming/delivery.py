"""Incremental delivery by Structured Streaming: each batch's new postings go to the digest, the feed, the history and
the cursors, in this order, each as one commit to a stored table.

A step's commit names the writer and the batch, so a batch that is repeated after a failure skips the steps it had done and does
the rest: nothing is lost, and nothing stands in a table twice. A posting enters the history only after its digest and its feed
entry are there, so until then a repeated batch finds the same rows new; cursors move last, so a source is not read past
what was delivered. Only the digest's messenger, if one is given, may be called again when a failure falls between it and its commit.

History and roles are bucketed tables (``jobloom.plans.history``): a batch reads the buckets of its own keys and writes
segments of its own size, however long the history is, and stream state holds nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators import incremental, postings
from jobloom.plans import history, storage

HISTORY = "key string, title string, company string, first_seen string"
ROLES = "key string"
CURSORS = "channel string, cursor long"
#: Segments beyond which a step merges those of one size.
COMPACT_AT = 16


@dataclass(frozen=True)
class Stores:
    """The tables below one folder."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("digest", "feed", "history", "roles", "cursors"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def role_id() -> Column:
    """A role's family as one string; null where the employer or the title is unknown."""
    company, title = C.canonical_company(F.col("company")), C.role_family_title(F.col("title"))
    known = (C.strip(C.text(F.col("company"))) != "") & (C.strip(C.text(F.col("title"))) != "")
    return F.when(known, F.to_json(F.array(company, title)))


def fresh_rows(rows: DataFrame, stores: Stores, order: str = "seq", gate: bool = True) -> DataFrame:
    """Rows to hand over whose key the history lacks, the first of each, with ``key``, ``role`` and ``repeat``: the role was seen
    before, or stands earlier among them. Without the ``gate`` all rows are fresh and none repeats."""
    due = rows.where(postings.is_handover()).withColumns({"key": incremental.seen_key(), "role": role_id()}).where("key <> ''")
    if not gate:
        return storage.stash(due.withColumn("repeat", F.lit(False)), "fresh")
    fresh = history.unknown_rows(due, stores.history, "key", order).drop("bucket")
    roles = fresh.where("role IS NOT NULL").groupBy(F.col("role").alias("key")).agg(F.min(order).alias("_from")).withColumn("bucket", history.bucket_of("key"))
    known = history.known_keys(roles, stores.roles, storage.snapshot(rows.sparkSession, stores.roles), "key").distinct().withColumn("_known", F.lit(True))
    roles = roles.join(known, "key", "left").select(F.col("key").alias("role"), "_from", "_known")
    again = F.coalesce(F.col("_known"), F.lit(False)) | F.coalesce(F.col(order) > F.col("_from"), F.lit(False))
    return storage.stash(fresh.join(roles, "role", "left").withColumn("repeat", again).drop("_from", "_known"), "fresh")


def _once(spark: SparkSession, path: str, writer: str, batch: int, write: Callable[[storage.Snapshot], storage.Snapshot]) -> bool:
    """Commit a step unless the table has this batch of this writer; whether it did."""
    done = []

    def change(now: storage.Snapshot) -> storage.Snapshot | None:
        done.append(now.batches.get(writer, -1) < batch)
        return write(now).having(writer, batch) if done[-1] else None

    storage.update(spark, path, change)
    return done[-1]


def deliver_batch(
    rows: DataFrame, batch: int, stores: Stores, stamp: Column, writer: str = "run", order: str = "seq", gate: bool = True, quiet: bool = False,
    cursors: DataFrame | None = None, send: Callable[[DataFrame], None] | None = None, after: Callable[[str], None] = lambda step: None,
) -> None:
    """Hand a batch of normalised ``rows`` over. ``send`` gets the digest's rows before they are committed; ``quiet`` leaves the digest
    out and does the rest; ``cursors(channel, cursor)`` is how far the batch was read; ``after`` is told of each step that is done."""
    spark = rows.sparkSession
    fresh = fresh_rows(rows, stores, order, gate)
    append = lambda df, path: lambda now: now.plus(*[s for s in [storage.write_segment(df, path)] if s.rows])

    digest = fresh.where(~F.col("repeat") & postings.is_inbox() & F.lit(not quiet)).select("key", order, "company", "title", "url", "source", F.lit(batch).cast("long").alias("batch"))
    if storage.snapshot(spark, stores.digest).batches.get(writer, -1) < batch:
        if send is not None and not quiet:
            send(digest)
        _once(spark, stores.digest, writer, batch, append(digest, stores.digest))
    after("digest")

    if storage.snapshot(spark, stores.feed).batches.get(writer, -1) < batch:
        first = fresh if gate else incremental.first_rows(fresh, "key", order)
        entries = storage.stash(postings.feed_entries(first.drop("key", "role"), stamp, F.col("repeat")), "entries")
        history.append_new(entries, stores.feed, "feed_key", "feed_key", entries.columns, writer=writer, batch=batch)
    after("feed")

    seen = fresh.select("key", "title", "company", stamp.cast("string").alias("first_seen"), order)
    roles = fresh.where("role IS NOT NULL").select(F.col("role").alias("key"), order)
    history.append_new(roles, stores.roles, "key", order, ["key"], writer=writer, batch=batch)
    after("roles")
    history.append_new(seen, stores.history, "key", order, ["key", "title", "company", "first_seen"], writer=writer, batch=batch)
    after("history")

    if cursors is not None:
        def moved(now: storage.Snapshot) -> storage.Snapshot:
            stored = storage.read_segments(spark, stores.cursors, now.segments, CURSORS)
            both = incremental.advance_cursors(stored, cursors.select(F.col("channel").cast("string"), F.col("cursor").cast("long")))
            return replace(now, segments=(storage.write_segment(both.coalesce(1), stores.cursors),))

        _once(spark, stores.cursors, writer, batch, moved)
    after("cursors")
    for path, schema in ((stores.history, HISTORY), (stores.roles, ROLES)):
        if len(storage.snapshot(spark, path).segments) > COMPACT_AT:
            history.compact(spark, path, schema)


def read_feed(spark: SparkSession, stores: Stores, schema: str, now: Column) -> DataFrame:
    """The feed's entries that retention keeps."""
    return incremental.prune_feed(storage.read_table(spark, stores.feed, schema), now)


def deliver_stream(stream: DataFrame, stores: Stores, checkpoint: str, stamp: Column, available_now: bool = True, **options):
    """Start the query that hands each micro-batch of normalised postings over; its offsets advance after the last step."""
    writer = stream.writeStream.foreachBatch(lambda rows, batch: deliver_batch(rows, batch, stores, stamp, **options)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def deliver(stream: DataFrame, key: str, order: str, feed_path: str, checkpoint: str, available_now: bool = True):
    """Start the query that appends the first row of each new ``key`` to the bucketed table at ``feed_path``."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        history.append_new(rows, feed_path, key, order, rows.columns, writer="stream", batch=batch_id)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def dedupe_within(stream: DataFrame, key: str, event_time: str, delay: str = "30 days") -> DataFrame:
    """The alternative with bounded state: the first row of a key within the watermark."""
    timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_event_time")
