"""History that only grows: a stored table in segments, each dealt into buckets of the key's hash.

A run reads the keys of the buckets it touches and of no others, from where they lie: its own keys are the small side and are
broadcast while their number is below ``NEAR_KEYS``, so history is not shuffled; beyond that the touched buckets' keys are. It writes one
segment with its new rows. Segments of about the same size are merged once there are ``TIER`` of them, so a row is rewritten as
often as the logarithm of the table, and a key is looked up in a number of segments that grows no faster.

A row's bucket never changes, so the number of buckets is fixed when the table is made. Rows with a null key are left out; of rows of one
key in a run the first by ``order`` counts.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.operators.incremental import first_rows
from jobloom.plans import storage

BUCKETS = 64
NEAR_KEYS = 500_000
#: Segments of one size class that are merged into one; a class is ``TIER`` times as large as the one before.
TIER = 4


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def read(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """All rows, with the column ``bucket``."""
    return storage.read_table(spark, path, f"{schema}, bucket int", version)


def known_keys(keys: DataFrame, path: str, now: storage.Snapshot, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Those of ``keys(key, bucket)`` that the version holds."""
    spark, kind = keys.sparkSession, keys.schema[key].dataType.simpleString()
    touched = [r.bucket for r in keys.select("bucket").distinct().collect()]
    held = storage.read_segments(spark, path, now.segments, f"`{key}` {kind}, bucket int").where(F.col("bucket").isin(touched))
    few = keys.select(key, "bucket")
    few = F.broadcast(few) if keys.count() <= NEAR_KEYS else few
    return held.join(few, [key, "bucket"], "left_semi").select(key)


def unknown_rows(rows: DataFrame, path: str, key: str, order: str, buckets: int = BUCKETS, now: storage.Snapshot | None = None) -> DataFrame:
    """``rows`` with ``bucket`` whose key the table lacks, the first of each key; written once, since a commit may read them again."""
    now = now or storage.snapshot(rows.sparkSession, path)
    first = first_rows(rows.where(F.col(key).isNotNull()), key, order).withColumn("bucket", bucket_of(key, buckets))
    if not now.segments:
        return storage.stash(first, "unknown")
    first = storage.stash(first, "keyed")
    return storage.stash(first.join(known_keys(first, path, now, key, buckets).distinct(), key, "left_anti"), "unknown")


def append_new(rows: DataFrame, path: str, key: str, order: str, columns: list[str], buckets: int = BUCKETS, writer: str = "", batch: int | None = None) -> storage.Snapshot:
    """Commit the rows whose key the table lacks as one segment. A ``batch`` that the table has of this writer is not
    written again; a writer that loses a race looks its rows up in the newer version."""
    left: dict[int, DataFrame] = {}

    def change(now: storage.Snapshot) -> storage.Snapshot | None:
        if batch is not None and now.batches.get(writer, -1) >= batch:
            return None
        if left:
            before = max(left)
            newer = replace(now, segments=tuple(s for s in now.segments if s not in seen[before]))
            new = left[before].join(known_keys(left[before], path, newer, key, buckets).distinct(), key, "left_anti")
            new = storage.stash(new, "unknown")
        else:
            new = unknown_rows(rows, path, key, order, buckets, now)
        left[now.version], seen[now.version] = new, now.segments
        segment = storage.write_segment(new.select(*columns, "bucket").repartition("bucket"), path, "bucket")
        after = now.plus(segment) if segment.rows else now
        return after.having(writer, batch) if batch is not None else after if segment.rows else None

    seen: dict[int, tuple] = {}
    return storage.update(rows.sparkSession, path, change)


def _tier(rows: int) -> int:
    tier = 0
    while rows >= TIER ** (tier + 1):
        tier += 1
    return tier


def compact(spark: SparkSession, path: str, schema: str) -> storage.Snapshot:
    """Merge size classes that have ``TIER`` segments or more, the smallest first; other segments stay where they are."""

    def change(now: storage.Snapshot) -> storage.Snapshot | None:
        tiers: dict[int, list] = {}
        for s in now.segments:
            tiers.setdefault(_tier(s.rows), []).append(s)
        full = [t for t in sorted(tiers) if len(tiers[t]) >= TIER]
        if not full:
            return None
        old = tuple(tiers[full[0]])
        merged = storage.read_segments(spark, path, old, f"{schema}, bucket int").repartition("bucket")
        return replace(now, segments=tuple(s for s in now.segments if s not in old) + (storage.write_segment(merged, path, "bucket"),))

    while True:
        before = storage.snapshot(spark, path).version
        after = storage.update(spark, path, change)
        if after.version == before:
            return after
