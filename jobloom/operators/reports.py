"""Counts and messages of a run."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions import policy as P
from jobloom.operators import calendar
from jobloom.operators.postings import is_handover, is_inbox
from jobloom.plans.storage import stash


def rejection_counts(postings: DataFrame) -> DataFrame:
    """``(reason, n)``; reasons that never occur are left out."""
    c = F.col
    reasons = F.array_compact(F.array(F.when(~c("primary"), "outside_primary_ios"), F.when(c("topic").isNull(), "off_topic")))
    return postings.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def label_counts(postings: DataFrame) -> DataFrame:
    """``(label, n)`` over hand-over rows."""
    c, lab = F.col, C.labels()
    df = postings.where(is_handover()).select(*[v.alias(k) for k, v in lab.items()])
    flags = [
        F.concat(F.lit("topic_"), "topic"), F.when(c("junior"), "junior"), F.when(~c("workable"), "not_workable_from_kyiv"), F.when(c("workable").isNull(), "workable_from_kyiv_unknown"),
        F.when(c("location_needs_check"), "location_needs_check"), F.when(F.size("work_authorization") > 0, "work_authorization"),
    ]
    return df.select(F.explode(F.array_compact(F.array(*flags))).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def run_counts(raw: DataFrame, normalized: DataFrame, unique: DataFrame) -> DataFrame:
    """``(name, n)`` of the stages of a run."""
    c = F.col
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    inbox = unique.where(is_inbox())
    handover = unique.where(is_handover())
    parts = [one(raw, "raw"), one(normalized, "normalized"), one(unique, "unique_roles"), one(inbox, "inbox_eligible"), one(handover, "handover_eligible")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_diagnostics(raw: DataFrame, normalized: DataFrame) -> DataFrame:
    """Raw, normal, rejected and inbox rows of each source."""
    c = F.col
    a = raw.groupBy("source").agg(F.count("*").alias("raw"))
    b = normalized.groupBy("source").agg(F.count("*").alias("normalized"), F.count_if(is_inbox()).alias("inbox_eligible"))
    df = a.join(b, "source", "left").na.fill(0, ["normalized", "inbox_eligible"])
    return df.withColumn("rejected", c("raw") - c("normalized"))


def confusion(cases: DataFrame, predicted: Column, expected: Column) -> DataFrame:
    """One row of hits and misses with precision and recall, null where they have no denominator."""
    tp, fp, fn, tn = (F.count_if(x) for x in (predicted & expected, predicted & ~expected, ~predicted & expected, ~predicted & ~expected))
    return cases.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"))


def split_message(text: str, limit: int = P.MESSAGE_LIMIT) -> list[str]:
    """Pieces of at most ``limit`` characters, cut at the last line break that is not the first character."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    out, rest = [], text
    while len(rest) > limit:
        cut = rest.rfind("\n", 0, limit)
        piece = rest[: cut if cut > 0 else limit].rstrip("\n")
        cut = cut if cut > 0 and piece else limit
        out.append(piece or rest[:limit])
        rest = rest[cut:].lstrip("\n")
    return out + [rest] if rest or not out else out


def message_chunks(docs: DataFrame, id_col: str, text_col: str, limit: int = P.MESSAGE_LIMIT) -> DataFrame:
    """``(id, part, chunk)`` of every text."""

    @F.pandas_udf("array<string>")
    def pieces(s: pd.Series) -> pd.Series:
        return s.fillna("").map(lambda t: split_message(t, limit))

    return docs.select(F.col(id_col).alias("id"), F.posexplode(pieces(F.col(text_col))).alias("part", "chunk"))


def vacancy_label(marks: Column | None = None) -> Column:
    """A posting's employer and its title with ``marks``, which may be known already."""
    channel = (F.lower(C.strip(C.text(F.col("source")))) == "telegram") & F.lower(C.strip(F.col("company"))).startswith("telegram @")
    name = F.when(channel, "").otherwise(C.strip(F.col("company")))
    both = F.struct(name.alias("name"), (C.title_marks() if marks is None else marks).alias("marks"))
    shown = lambda x: F.array_join(F.filter(F.array(x["name"], x["marks"]), lambda s: s != ""), " — ")
    return C.let(C.let(both, shown), lambda label: F.when(label != "", label).otherwise(C.strip(F.col("url"))))


def _running(rows: DataFrame, value: Column, out: str) -> DataFrame:
    """``rows(digest, chunk, ord, ...)`` with the running sum of ``value`` in ``ord`` over each digest. Chunks follow one another within a
    digest: a row's sum is that of its chunk so far and of all chunks before, so no task reads a digest, and only one row a chunk
    is summed up in one place."""
    valued = rows.withColumn("_value", value)
    chunks = valued.groupBy("digest", "chunk").agg(F.sum("_value").alias("_all"))
    before = F.coalesce(F.sum("_all").over(Window.partitionBy("digest").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = stash(chunks.select("digest", "chunk", before.alias("_before")), "chunks")
    here = F.sum("_value").over(Window.partitionBy("digest", "chunk").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    return valued.join(chunks, ["digest", "chunk"]).withColumn(out, F.col("_before") + here).drop("_value", "_before")


def _next_starts(lines: DataFrame, budget: int, span: int) -> DataFrame:
    """``(digest, number, next)``: where the message after one that starts at ``number`` starts. It is the first line that ends beyond the
    budget, found among ends and limits sorted together within spans of the digest's characters; a line always fits alone."""
    span_of = lambda at: F.floor(at / F.lit(span))
    ends = lines.select("digest", F.col("end").alias("at"), F.lit(0).alias("kind"), F.col("number").alias("ending"), F.lit(None).cast("long").alias("number"))
    limits = lines.select("digest", (F.col("end") - F.col("size") + budget).alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("ending"), "number")
    both = stash(ends.union(limits).withColumn("span", span_of(F.col("at"))), "ends_and_limits")
    spans = both.groupBy("digest", "span").agg(F.max("ending").alias("_last"))
    carried = F.max("_last").over(Window.partitionBy("digest").orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    spans = stash(spans.select("digest", "span", carried.alias("carried")), "spans")
    within = F.max("ending").over(Window.partitionBy("digest", "span").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("within", within).where("kind = 1").join(spans, ["digest", "span"])
    return found.select("digest", "number", (F.greatest("number", F.coalesce("within", "carried", F.lit(0))) + 1).alias("next"))


def _starts(jumps: DataFrame) -> DataFrame:
    """``(digest, number, part)`` of the messages that follow from line 1: in round k the starts known so far jump 2**k messages on, and
    the jumps are joined with themselves, so the rounds are the logarithm of the longest digest's messages."""
    lines = jumps.select("digest", "number")
    known, step = jumps.where("number = 1").select("digest", "number", F.lit(1).cast("long").alias("part")), 1
    while True:
        new = known.join(jumps, ["digest", "number"]).select("digest", F.col("next").alias("number"), (F.col("part") + step).alias("part"))
        new = stash(new.join(lines, ["digest", "number"], "left_semi"), "new_starts")
        if new.isEmpty():
            return known
        known = stash(known.union(new), "starts")
        twice = jumps.select("digest", F.col("number").alias("next"), F.col("next").alias("to"))
        jumps, step = stash(jumps.join(twice, ["digest", "next"]).select("digest", "number", F.col("to").alias("next")), "jumps"), step * 2


def pack_digest(postings: DataFrame, order: str = "seq", limit: int = P.MESSAGE_LIMIT, overhead: int = 160, key: str = "day") -> DataFrame:
    """Messages of numbered postings, each within ``limit`` characters, of every digest (``key``): as many lines as fit, in order.

    Numbers run through a digest and a message starts where the one before ends, yet no task reads a digest: numbers and ends of lines are
    running sums over chunks of it, each line knows where a message that starts there would end, and the starts that
    really follow one another are found by jumping twice as far each round. ``order`` is unique within a digest; rows without a ``key`` are out.
    """
    entry = F.concat(vacancy_label(), F.lit("\n   "), C.strip(F.col("url")))
    # Written before they are ordered: for its bounds a range shuffle runs what is below it twice.
    lines = stash(postings.select(F.col(key).alias("digest"), F.col(order).alias("ord"), entry.alias("line")).where("digest IS NOT NULL"), "entries")
    chunked = lines.repartitionByRange("digest", "ord").sortWithinPartitions("digest", "ord").withColumn("chunk", F.spark_partition_id())
    numbered = stash(_running(stash(chunked, "lines"), F.lit(1), "number").withColumn("text", F.concat(F.col("number").cast("string"), F.lit(". "), "line")).drop("line"), "numbered")
    sized = numbered.select("digest", "chunk", "ord", "number", (F.length("text") + 1).cast("long").alias("size"))
    jumps = stash(_next_starts(stash(_running(sized, F.col("size"), "end"), "sized"), limit - overhead, 256 * limit), "jumps")
    starts = stash(_starts(jumps), "all_starts")
    counts = starts.groupBy("digest").agg(F.max("part").alias("parts"))
    held = starts.join(jumps, ["digest", "number"]).select("digest", "part", F.explode(F.sequence(F.col("number"), F.col("next") - 1)).alias("number"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("number", "text"))), lambda x: x["text"])
    packed = held.join(numbered.select("digest", "number", "text"), ["digest", "number"]).groupBy("digest", "part").agg(F.count("*").alias("items"), F.array_join(texts, "\n").alias("message"))
    return packed.join(counts, "digest").select("digest", "part", "parts", "items", "message")


def new_header(total: Column) -> Column:
    return F.concat(F.lit("📬 +"), total.cast("string"), F.lit(" "), C.number_form(total, "новая вакансия", "новые вакансии", "новых вакансий"))


def _is_channel_name(name: Column) -> Column:
    return F.lower(name).startswith("telegram")


def _problems() -> Column:
    """A line a kind of problem: sites that did not answer, sites that refuse, sources without a result, channels, channels without keys."""
    line = lambda mark, c: F.when(F.size(c) > 0, F.concat(F.lit(mark), C.short_list(c)))
    failed = F.col("failed_names")
    bare = lambda n: C.strip(F.regexp_replace(F.regexp_replace(n, "^Telegram @", ""), "^Telegram ", ""))
    channels = F.transform(F.filter(failed, _is_channel_name), lambda n: F.coalesce(F.nullif(bare(n), F.lit("")), n))
    return F.array_compact(F.array(
        line("⚠️ Не ответили: ", F.filter(failed, lambda n: ~_is_channel_name(n))), line("🔒 Блокируют автосбор: ", F.col("manual_names")), line("⚠️ Без результата: ", F.col("degraded_names")),
        line("⚠️ Telegram: ", channels), line("🔑 Telegram без ключей: ", F.col("skipped_names")),
    ))


def problem_lines(summary: DataFrame, *keys: str) -> DataFrame:
    """The problems of each summary row as one text, a line a kind, with the ``keys`` columns."""
    return summary.select(*keys, F.array_join(_problems(), "\n").alias("problems"))


def with_problems(summary: DataFrame) -> DataFrame:
    """``summary`` with ``problems``, a line a kind, instead of its lists of names: rows of many messages may share them."""
    return C.once(summary, "problems", _problems()).drop("failed_names", "manual_names", "degraded_names", "skipped_names")


def status_lines(now: Column) -> Column:
    """The ``problems`` of a summary row and the line of the clock, green where there is no problem."""
    clock = F.concat(F.date_format(calendar.local(now), "HH:mm"), F.lit(" · "), calendar.next_check_text(now))
    green = F.size("problems") == 0
    return F.concat("problems", F.array(F.concat(F.when(green, "🟢 ").otherwise("🕐 "), clock)))


def heartbeat(summary: DataFrame, now: Column, *keys: str) -> DataFrame:
    """What a run without news says: one line where all is well, else the problems below it. ``summary`` has the lists of names, or
    ``problems`` where they were found before, null for none."""
    df = summary.withColumn("problems", F.coalesce("problems", F.array().cast("array<string>"))) if "problems" in summary.columns else with_problems(summary)
    df, lines = C.once(df, "_lines", status_lines(now)), F.col("_lines")
    text = F.when(F.size(lines) == 1, F.concat(F.lit("📭 Новых нет · "), lines[0])).otherwise(F.array_join(F.concat(F.array(F.lit("📭 Новых нет")), lines), "\n"))
    return df.select(*keys, text.alias("heartbeat"))


def diagnostics(runs: DataFrame, raw: DataFrame, normalized: DataFrame, unique: DataFrame, status: Column, collected_at: Column, secrets: tuple[str, ...] = ()) -> DataFrame:
    """One row, ``report``: a run as a JSON tree of its sources in order of their id, counts, rejections and labels.

    ``runs(source_id, source_name, status, error, items_scanned, ...)`` judged, ``raw`` and ``normalized`` postings of their ``source_id`` (of failed
    sources none), ``unique`` the run's roles. Counts by source and of the run come from one pass over narrow rows with two grouping
    sets. Sources are a registry, so the tree is bounded by it. Rejections that never occur are left out.
    """
    c = F.col
    none = F.lit(False)
    facts = lambda df, kind: df.select(F.lit(kind).alias("kind"), "source_id", is_inbox().alias("inbox"), is_handover().alias("handover"), (~c("primary")).alias("outside"), c("topic").isNull().alias("off"))
    of_raw = raw.select(F.lit("raw").alias("kind"), "source_id", *[none.alias(x) for x in ("inbox", "handover", "outside", "off")])
    rows = of_raw.unionByName(facts(normalized, "normalized")).unionByName(facts(unique, "unique"))
    counted = stash(rows.groupingSets([["kind", "source_id"], ["kind"]], "kind", "source_id").agg(F.count("*").alias("n"), *[F.count_if(x).alias(x) for x in ("inbox", "handover", "outside", "off")], F.grouping("source_id").alias("whole")), "counted")
    rejected = lambda outside, off: F.map_filter(F.create_map(F.lit("outside_primary_ios"), outside, F.lit("off_topic"), off), lambda k, n: n > 0)
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long"))

    part = lambda kind: counted.where((c("whole") == 0) & (c("kind") == kind))
    by_raw = part("raw").select("source_id", c("n").alias("raw"))
    by_normal = part("normalized").select("source_id", c("n").alias("normalized"), "inbox", "outside", "off")
    optional = lambda name, kind: c(name).cast(kind) if name in runs.columns else F.lit(None).cast(kind)
    each = runs.join(by_raw, "source_id", "left").join(by_normal, "source_id", "left").select(F.struct(
        c("source_id").alias("id"), c("source_name").alias("name"), "status", C.safe_error(C.text(c("error")), secrets).alias("reason"), c("items_scanned").alias("scanned"), zero(optional("items_skipped", "long")).alias("skipped"),
        zero(c("raw")).alias("raw"), zero(c("normalized")).alias("normalized"), (zero(c("raw")) - zero(c("normalized"))).alias("normalization_rejected"), zero(c("inbox")).alias("inbox_eligible"),
        rejected(zero(c("outside")), zero(c("off"))).alias("rejections"), optional("response_ms", "long").alias("response_ms"),
    ).alias("source"))
    by_id = lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)
    sources = each.agg(F.array_sort(F.collect_list("source"), by_id).alias("sources"))
    total = lambda kind, x: zero(F.max(F.when((c("whole") == 1) & (c("kind") == kind), c(x))))
    counts = counted.agg(
        F.struct(total("raw", "n").alias("raw"), total("normalized", "n").alias("normalized"), total("unique", "n").alias("unique_roles"), (total("normalized", "n") - total("unique", "n")).alias("duplicates_collapsed"), total("unique", "inbox").alias("inbox_eligible"), total("unique", "handover").alias("handover_eligible")).alias("counts"),
        rejected(total("unique", "outside"), total("unique", "off")).alias("rejections"),
    )
    labels = label_counts(unique).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("labels"))
    tree = F.struct(F.lit(1).alias("schema_version"), collected_at.alias("collected_at"), status.alias("status"), "sources", "counts", "rejections", "labels")
    return sources.crossJoin(F.broadcast(counts)).crossJoin(F.broadcast(labels)).select(F.to_json(tree).alias("report"))


REPORT = (
    "status string, counts struct<raw: long, normalized: long, unique_roles: long, duplicates_collapsed: long, inbox_eligible: long, handover_eligible: long>, rejections map<string, long>, labels map<string, long>, "
    "sources array<struct<id: string, name: string, status: string, reason: string, scanned: long, skipped: long, raw: long, normalized: long, normalization_rejected: long, inbox_eligible: long, rejections: map<string, long>>>"
)


def summary_lines(report: DataFrame) -> DataFrame:
    """``nth, line`` of the Markdown summary of a ``report``: its status, its counts and a table of its sources."""
    r = report.select(F.from_json("report", REPORT).alias("r")).select("r.*")
    cell = lambda x: F.replace(F.replace(F.replace(C.text(x.cast("string")), F.lit("|"), F.lit(" / ")), F.lit("\n"), F.lit(" ")), F.lit("<"), F.lit("&lt;"))
    names = ("raw", "normalized", "unique_roles", "duplicates_collapsed", "inbox_eligible", "handover_eligible")
    columns = ("name", "status", "scanned", "skipped", "normalized", "inbox_eligible", "reason")
    rows = F.transform("sources", lambda s: F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(s[x]) for x in columns]), F.lit(" |")))
    head = F.array(F.lit("## Vacancy collection"), F.lit(""), F.concat(F.lit("Status: **"), F.coalesce("status", F.lit("unknown")), F.lit("**")), F.lit(""), *[F.concat(F.lit(f"- {n}: "), F.col(f"counts.{n}").cast("string")) for n in names], F.lit(""), F.lit("| Source | Status | Scanned | Skipped | Normalized | Inbox eligible | Reason |"), F.lit("|---|---|---:|---:|---:|---:|---|"))
    return r.select(F.posexplode(F.concat(head, rows)).alias("nth", "line"))
