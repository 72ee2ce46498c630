"""A whole run: judge sources, normalise, remove duplicates, report, and find what to hand over.

Everything is lazy: the plan joins the run's rows to the stored tables once each. Where a result feeds
several outputs it can be written first (``save``), so later outputs read it instead of recomputing it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators import dedup, health, incremental, postings, reports
from jobloom.plans import storage


@dataclass(frozen=True)
class Collected:
    """What a run collected: judged sources, the next baseline, postings in their stages, and reports."""

    runs: DataFrame
    baseline: DataFrame
    normalized: DataFrame
    unique: DataFrame
    summary: DataFrame
    counts: DataFrame
    rejections: DataFrame
    labels: DataFrame
    outage: DataFrame
    purgeable: DataFrame


def collect(runs: DataFrame, raw: DataFrame, baseline: DataFrame, stamp: Column, save: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> Collected:
    """``runs`` has a row a source, ``raw`` a row a posting with its ``source_id``. Postings of failed sources are left
    out; degraded sources still give theirs."""
    judged = save(health.classify_degraded(runs, baseline), "runs")
    usable = raw.join(judged.where("status <> 'failed'").select("source_id"), "source_id", "left_semi")
    normalized = save(postings.normalize(usable), "normalized")
    unique = save(dedup.deduplicate(normalized), "unique")
    return Collected(
        judged, health.update_baseline(baseline, judged, stamp), normalized, unique, health.summarize_sources(judged), reports.run_counts(raw, normalized, unique),
        reports.rejection_counts(unique), reports.label_counts(unique), health.company_outage(judged), health.purgeable_companies(judged),
    )


@dataclass(frozen=True)
class Delivery:
    """What a run hands over: fresh postings with their repeat flag, the digest's rows, and the next tables."""

    fresh: DataFrame
    digest: DataFrame
    feed: DataFrame
    seen: DataFrame


def hand_over(unique: DataFrame, seen: DataFrame, feed: DataFrame, stamp: Column, now: Column, gate: bool = True) -> Delivery:
    """Fresh rows on topic go to the feed and the history; repeats and other topics stay out of the digest.

    A caller writes the digest, then the feed, then the history: if one fails, the next run sees the same rows as fresh again.
    """
    c = F.col
    due = unique.where(postings.is_handover())
    fresh = incremental.role_repeats(incremental.select_fresh(due, seen, gate, order="out_pos"), seen, order="out_pos")
    digest = fresh.where(~c("repeat") & postings.is_inbox())
    grown = incremental.append_feed(feed, fresh, stamp, c("repeat"), order="out_pos")
    return Delivery(fresh, digest, incremental.prune_feed(grown, now), incremental.mark_seen(seen, fresh, stamp, order="out_pos"))


def evaluate(cases: DataFrame) -> DataFrame:
    """One row of admission quality over ``cases(raw postings columns, expected boolean)``.

    A case that does not normalise counts as not admitted. It is judged in its own row: cases need no key, and are read once.
    """
    return reports.confusion(postings.judge(cases), F.col("admitted"), F.col("expected"))


def evaluate_labels(cases: DataFrame, expected: DataFrame) -> DataFrame:
    """``id, name, value, actual`` where an admitted case that should be has another label than expected.

    ``cases(id, raw postings columns, expected boolean)``, ``expected(id, name, value)`` with values as text, one row a label that is asserted; the
    attention mark is the label ``attention``, expected false unless a row says otherwise. Actual labels are unpivoted to
    the same shape, so all assertions are one join.
    """
    c = F.col
    good = postings.normalize(cases.withColumn("_id", c("id"))).where(postings.is_inbox() & c("expected"))
    labels = C.labels() | {"attention": C.location_attention(c("location"), c("remote"))}
    text = {k: F.to_json(v) if k == "work_authorization" else v.cast("string") for k, v in labels.items()}
    actual = good.select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.alias("actual")) for k, v in text.items()])).alias("x")).select("id", "x.*")
    said = expected.select("id", "name", "value")
    silent = good.select("id").distinct().join(said.where("name = 'attention'").select("id"), "id", "left_anti").select("id", F.lit("attention").alias("name"), F.lit("false").alias("value"))
    wrong = said.unionByName(silent).join(actual, ["id", "name"])
    return wrong.where(~c("value").eqNullSafe(c("actual"))).select("id", "name", "value", "actual")


def surviving_variants(groups: DataFrame) -> DataFrame:
    """``id, backwards, rows, normal, urls``: what is left of each group of variants without its duplicates, in both orders.

    ``groups(id, pos, raw postings columns)``. The orders are a scope of the one duplicate removal that all groups go through. Variants are
    normalised once for both, and rows are counted a group.
    """
    c, none = F.col, F.array().cast("array<string>")
    sizes = groups.groupBy("id").agg(F.count("*").alias("rows"))
    once = storage.stash(postings.normalize(groups), "variants")
    kept = once.groupBy("id").agg(F.count("*").alias("normal"))
    both = lambda df: df.withColumn("backwards", F.explode(F.array(F.lit(False), F.lit(True))))
    normal = both(once).withColumns({"seq": F.struct("id", "backwards", F.when(c("backwards"), -c("pos")).otherwise(c("pos")).alias("at")), "scope": F.struct("id", "backwards")})
    left = dedup.deduplicate(normal, scope="scope").groupBy("id", "backwards").agg(F.array_sort(F.collect_list("url")).alias("urls"))
    out = both(sizes.join(kept, "id", "left")).join(left, ["id", "backwards"], "left")
    return out.select("id", "backwards", "rows", F.coalesce("normal", F.lit(0)).alias("normal"), F.coalesce("urls", none).alias("urls"))


def evaluate_duplicates(groups: DataFrame, expected: DataFrame) -> DataFrame:
    """``id, backwards, rows, normal, urls, wanted, ok``: every group of variants without its duplicates, in both orders.

    ``groups`` as ``surviving_variants`` takes them, and ``expected(id, urls)``. Discovery order must not change what survives. A group with a
    variant that does not normalise is not ``ok``.
    """
    return judge_variants(surviving_variants(groups), expected)


def judge_variants(survivors: DataFrame, expected: DataFrame) -> DataFrame:
    c = F.col
    out = survivors.join(expected.select("id", F.array_sort("urls").alias("wanted")), "id", "left").withColumn("wanted", F.coalesce("wanted", F.array().cast("array<string>")))
    return out.withColumn("ok", (c("rows") == c("normal")) & (c("urls") == c("wanted")))


def export_feed(feed: DataFrame) -> DataFrame:
    """The feed as one JSON entry a row, by key: the boundary format of consumers that read documents."""
    return feed.select("feed_key", F.to_json(F.struct(*[c for c in feed.columns if c != "feed_key"])).alias("entry")).orderBy("feed_key")
