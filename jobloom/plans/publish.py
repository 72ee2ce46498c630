"""State documents that several runs publish: each merges its edits into the latest version and commits it, or fails."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.operators import state_merge
from jobloom.plans import storage

STATE = "key string, document string"


def _print(df: DataFrame) -> tuple:
    """A fingerprint of a state as a set of documents."""
    text = F.to_json(F.try_parse_json("document"))
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("key", text)), F.sum(F.xxhash64(text, "key").cast("decimal(20,0)"))).first())


def publish(local: DataFrame, path: str, base_version: int, attempts: int = storage.ATTEMPTS, **rules) -> int | None:
    """Commit ``local(key, document)``, edited from ``base_version``, on top of whatever was committed since.

    Where another writer is first its version is merged again, at most ``attempts`` times; edits that fight fail with
    ``StateConflict`` and leave the table as it was. Gives the new version, or None where there is nothing to change. ``rules`` are those of
    ``merge_documents``.
    """
    spark = local.sparkSession
    local = storage.stash(local.select("key", "document"), "local")
    base = storage.read_table(spark, path, STATE, base_version)

    def change(now: storage.Snapshot) -> storage.Snapshot | None:
        remote = storage.read_segments(spark, path, now.segments, STATE)
        merged = storage.stash(state_merge.resolved(state_merge.merge_documents(base, local, remote, **rules)), "merged")
        if _print(merged) == _print(remote):
            return None
        return replace(now, segments=(storage.write_segment(merged, path),))

    before = storage.snapshot(spark, path).version
    after = storage.update(spark, path, change, attempts).version
    return after if after > before else None
