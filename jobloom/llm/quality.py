"""Quality rules with host-level verdicts.

Each document gets counts over its whole text and fails or passes the rules. Failures are summed by host
(``domain``), each host's rate is shrunk by a beta prior fitted to all hosts by moments, and a host whose
shrunk rate is above ``host_limit`` fails all its documents. Hosts with few documents so stay near the
overall rate, and only a host that mostly fails is dropped whole.

Built-in column functions only; the text is read once and what is kept of it is a few integers a row.
Sums by host are combined before the shuffle, so a host with a third of all rows is no hot task.

Defined cases: words are runs of characters other than space and TAB..CR; null and empty texts have no words
and fail; a null host is the host ''; lines and words are compared exactly (windows by 64-bit hashes of words);
repeated rows count as often as they occur; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

SPACES = r"[ \t\n\x0B\f\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MOST_BROADCAST = 500_000


def _barrier(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once, however often it is used above."""
    return df.withColumn(name, F.explode(F.array(value)))


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of every row."""
    df = docs.select(docs[id_col].alias("id"), F.coalesce(docs[host_col].cast("string"), F.lit("")).alias("host"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    df = _barrier(df, "words", F.array_remove(F.split("text", SPACES), ""))
    df = _barrier(df, "lines", lines)
    df = df.select("id", "host", "words", F.size("words").alias("n"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    df = _barrier(df, "h", F.when(F.col("n") >= WINDOW, F.transform("words", lambda w: F.xxhash64(w)))).drop("words")
    window = lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])
    df = _barrier(df, "v", F.when(F.col("n") >= WINDOW, F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), window))).drop("h")
    repeats = F.size(F.array_distinct("v")) < F.size("v")
    # Only texts that repeat a window go on: sort (hash, place), keep places with an equal neighbour.
    placed = F.when(repeats, F.sort_array(F.transform("v", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    df = _barrier(df, "s", placed).drop("v")
    x = lambda i: F.get("s", i)["x"]
    twice = F.filter(F.transform("s", lambda s, i: F.when((x(i - 1) == s["x"]) | (x(i + 1) == s["x"]), s["i"])), lambda p: p.isNotNull())
    df = _barrier(df, "p", F.sort_array(twice)).drop("s")
    gaps = F.transform("p", lambda p, i: F.coalesce(F.least(F.get("p", i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)
    return df.select("id", "host", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules_failed() -> Column:
    """All rules of the host rates: the base ones, many symbols for the words, or many repeated lines."""
    return base_failed() | (2 * F.col("n_symbols") > F.col("n_words")) | (100 * F.col("n_dup_lines") > 30 * F.col("n_lines"))


def host_verdicts(counts: DataFrame, host_limit: float = 0.5) -> DataFrame:
    """``host, n, failures, rate, host_failed`` from ``counts(host, failed)``."""
    hosts = counts.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failures"))
    hosts = stash(hosts, "hosts")
    t = hosts.agg(F.sum("n").alias("n"), F.sum("failures").alias("f")).first()
    mean = t.f / t.n if t.n else 0.0
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("failures") / F.col("n") - mean, 2))).first()[0]
    var = spread / t.n if t.n else 0.0
    strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 1e-12 else 1e6
    rate = (F.col("failures") + mean * strength) / (F.col("n") + strength)
    return hosts.select("host", "n", "failures", rate.alias("rate"), (rate > host_limit).alias("host_failed"))


def apply_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", host_limit: float = 0.5) -> DataFrame:
    """The counts of every row with ``base_failed``, ``failed`` (all rules), ``host_rate`` and ``kept``."""
    counts = stash(rule_counts(docs, id_col, text_col, host_col).withColumns({"base_failed": base_failed(), "failed": rules_failed()}), "counts")
    hosts = host_verdicts(counts, host_limit).select("host", F.col("rate").alias("host_rate"), "host_failed")
    near = F.broadcast(hosts) if hosts.count() <= MOST_BROADCAST else hosts
    return counts.join(near, "host").withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT k, doc_id, host, text, list_filter(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS l FROM d),
win AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS s FROM w, unnest(range(1, len(w) - 6)) AS t(i) WHERE len(w) >= 8),
twice AS (SELECT k, i FROM win QUALIFY count(*) OVER (PARTITION BY k, s) > 1),
rep AS (SELECT k, count(DISTINCT i + j) AS n FROM twice, range(0, 8) AS r(j) GROUP BY k),
c AS (
  SELECT w.k, doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON w.k = rep.k),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 2 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines AS failed FROM c),
h AS (SELECT host, count(*) AS n, count(*) FILTER (WHERE failed) AS failures FROM f GROUP BY host),
m AS (SELECT sum(failures) / sum(n) AS mean, sum(n) AS total FROM h),
v AS (SELECT any_value(mean) AS mean, sum(n * pow(failures / n - mean, 2)) / any_value(total) AS var FROM h, m),
p AS (SELECT mean, CASE WHEN var > 1e-12 THEN least(greatest(mean * (1 - mean) / var - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ((failures + mean * strength) / (n + strength) > 0.5) AS kept
FROM f JOIN h USING (host), p
"""
