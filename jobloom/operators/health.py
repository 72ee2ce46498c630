"""Source health: high-water marks, degraded sources, summaries and run status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions import policy as P

# --- fixed value: errors of sites that answer but refuse automated clients
BLOCKED = r"\bhttp 403\b|\b403 client error\b|anti-bot challenge"


def _count(c: str) -> Column:
    return F.coalesce(F.expr(f"try_cast({c} AS BIGINT)"), F.lit(0))


def classify_degraded(runs: DataFrame, baseline: DataFrame) -> DataFrame:
    """``runs`` with ``status`` and ``error`` set where a healthy source fell behind its own record.

    ``runs(source_id, status, error, items_scanned, empty_is_healthy, ...)``, ``baseline(source_id,
    search_policy, best_scanned, empty_runs)``. A best made under another search policy counts as 0.
    """
    same = F.coalesce("search_policy", F.lit(P.LEGACY_SEARCH_POLICY)) == P.SEARCH_POLICY
    base = baseline.select("source_id", F.when(same, _count("best_scanned")).otherwise(0).alias("_best"), _count("empty_runs").alias("_empty"))
    df = runs.join(base, "source_id", "left")
    best, empty, n = F.coalesce("_best", F.lit(0)), F.coalesce("_empty", F.lit(0)), F.col("items_scanned")
    why = (
        F.when((n == 0) & (best > 0), "parsed 0 items but previously parsed items")
        .when((n == 0) & (empty >= P.DEGRADED_EMPTY_RUNS - 1), F.format_string("parsed 0 items for %d runs", empty + 1))
        .when((best >= P.DEGRADED_MIN_BEST) & (n < best * P.DEGRADED_RATIO), F.format_string("parsed %d items but previously parsed %d", n, best))
    )
    judged = F.when((F.col("status") == "healthy") & ~F.col("empty_is_healthy"), why)
    df = df.withColumn("_why", judged)
    error = F.when(F.col("_why").isNotNull(), F.coalesce(F.nullif(F.col("error"), F.lit("")), F.col("_why"))).otherwise(F.col("error"))
    return df.withColumns({"error": error, "status": F.when(F.col("_why").isNotNull(), "degraded").otherwise(F.col("status"))}).drop("_best", "_empty", "_why")


def update_baseline(baseline: DataFrame, runs: DataFrame, stamp: Column) -> DataFrame:
    """The next baseline: a full outer merge in which failed sources change nothing."""
    new = runs.where("status <> 'failed'").select("source_id", F.col("source_name").alias("_name"), F.col("items_scanned").alias("_n"))
    df = baseline.join(new, "source_id", "full_outer")
    ran = F.col("_n").isNotNull()
    same = F.coalesce("search_policy", F.lit(P.LEGACY_SEARCH_POLICY)) == P.SEARCH_POLICY
    best = F.greatest(F.when(same, _count("best_scanned")).otherwise(0), F.col("_n"))
    pick = lambda new, old: F.when(ran, new).otherwise(F.col(old)).alias(old)
    return df.select(
        "source_id", pick(F.col("_name"), "name"), pick(F.lit(P.SEARCH_POLICY), "search_policy"), pick(best, "best_scanned"), pick(F.col("_n"), "last_scanned"), pick(stamp, "last_success_at"),
        pick(F.when(F.col("_n") == 0, _count("empty_runs") + 1).otherwise(0), "empty_runs"), F.when(ran & (F.col("_n") > 0), stamp).otherwise(F.col("last_nonzero")).alias("last_nonzero"),
    )


def empty_streaks(history: DataFrame, source: str, run: str, scanned: str) -> DataFrame:
    """Consecutive empty runs up to each run of each source."""
    w = Window.partitionBy(source).orderBy(run)
    df = history.withColumn("_block", F.sum(F.when(F.col(scanned) > 0, 1).otherwise(0)).over(w))
    empty = F.sum(F.when(F.col(scanned) > 0, 0).otherwise(1)).over(Window.partitionBy(source, "_block").orderBy(run))
    return df.withColumn("empty_runs", empty).drop("_block")


def high_water(history: DataFrame, source: str, run: str, scanned: str) -> DataFrame:
    w = Window.partitionBy(source).orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    return history.withColumn("best_scanned", F.max(scanned).over(w))


def is_channel() -> Column:
    return F.col("source_id").startswith("telegram:") | F.col("source_name").startswith("Telegram @")


def channel_label() -> Column:
    by_id, by_name = F.regexp_extract("source_id", r"(?s)^telegram:(.*)$", 1), C.strip(F.regexp_extract("source_name", r"(?s)^Telegram @(.*)$", 1))
    return F.when(F.col("source_id").startswith("telegram:"), by_id).when(F.col("source_name").startswith("Telegram @"), by_name).otherwise(F.col("source_name"))


def summarize_sources(runs: DataFrame) -> DataFrame:
    """One row: counts of sites and channels by outcome, with the names, ordered by source id."""
    error = C.text(F.col("error"))
    df = runs.withColumns({"channel": is_channel(), "label": channel_label(), "skipped": F.lower(error).contains("not set"), "blocked": C.matches(error, BLOCKED)})
    failed, degraded = F.col("status") == "failed", F.col("status") == "degraded"
    outcome = F.when(F.col("channel"), F.when(failed, "channel_failed").when(F.col("skipped"), "channel_skipped").when(degraded, "channel_degraded").otherwise("channel_ok"))
    outcome = outcome.otherwise(F.when(failed & F.col("blocked"), "site_manual").when(failed, "site_failed").when(degraded, "site_degraded").otherwise("site_ok"))
    df = df.withColumn("outcome", outcome)
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    names = lambda c, *o: F.transform(F.array_sort(F.collect_list(F.when(F.col("outcome").isin(*o), F.struct("source_id", F.col(c).alias("x"))))), lambda s: s["x"])
    return df.agg(
        n("site_ok").alias("sites_ok"), F.count_if(~F.col("channel")).alias("sites_total"), n("channel_ok").alias("channels_ok"), F.count_if("channel").alias("channels_total"), n("channel_skipped").alias("channels_skipped"),
        names("source_name", "site_failed", "channel_failed").alias("failed_names"), names("source_name", "site_degraded", "channel_degraded").alias("degraded_names"), names("label", "channel_skipped").alias("skipped_names"), names("source_name", "site_manual").alias("manual_names"),
    )


def cursor_updates(runs: DataFrame) -> DataFrame:
    """Only channels that were read healthily move their cursor."""
    ok = is_channel() & (F.col("status") == "healthy") & ~F.lower(C.text(F.col("error"))).contains("not set") & F.col("checkpoint").isNotNull()
    return runs.where(ok).select(channel_label().alias("channel"), F.col("checkpoint").alias("cursor"))


def company_outage(runs: DataFrame) -> DataFrame:
    """True where no company source is usable, also when there is none."""
    usable = (F.col("status") != "failed") & ((F.col("status") != "degraded") | (F.col("items_scanned") > 0))
    return runs.where(~is_channel()).agg((~F.coalesce(F.bool_or(usable), F.lit(False))).alias("company_outage"))


def purgeable_companies(runs: DataFrame) -> DataFrame:
    known = F.col("source_id").startswith("company:") | F.col("source_id").startswith("dou")
    return runs.where(~is_channel() & ~F.col("status").isin("failed", "degraded") & (F.col("items_scanned") > 0) & known).select(F.col("source_name").alias("company")).distinct()


def run_status(delivered: Column, outage: Column, partial: Column) -> Column:
    return F.when(~delivered | outage, "failed").when(partial, "degraded").otherwise("healthy")
