"""URL filters: host and path rules, then a character language-model ratio.

Rules ``host/path`` fit their host and its subdomains where the url's path starts with theirs; the longest
rule wins. URLs that a rule judged are the training texts of two character models, one of allowed and one
of blocked URLs. Each is a variable-order Markov model: the chance of a character after the last three
is its count there mixed with the chance after the last two, and so on down to one over 256. A URL's
score is the mean log ratio of the two models over its characters; the cut lies between the mean scores of
the two training classes, as many standard deviations from either, and URLs below it are blocked.

All counts are taken over all URLs, each distinct URL of a class weighted by its rows. Built-in
functions only: counts, contexts and scores are joins and sums over the table of distinct four-grams, whose
size is bounded by the alphabet. Where the ratios are too many to broadcast, a URL's n-grams are counted before they meet them and only the few
grams of very many URLs are broadcast; so are the scores of URLs that very many rows have (null ones among them).

Defined cases: a null url or one without ``://`` has an empty host and path and no rule; while either class has
no URL the models allow everything; repeated rows and ids keep their rows; an empty table gives no rows. All columns
of the input are carried along, whatever their names; one named like an output is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hot_rows, join_hot, spread, stash

#: (verdict, rule)
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 4
PRIOR = 4.0
MOST_BROADCAST = 500_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def _grams(urls: DataFrame) -> DataFrame:
    """``urls(url, ...)`` -> one row a character: the character with up to three before it, padded."""
    padded = F.concat(F.lit("\x02" * (ORDER - 1)), "url", F.lit("\x03"))
    at = F.explode(F.sequence(F.lit(1), F.length("url") + 1))
    return urls.withColumn("padded", padded).withColumn("at", at).withColumn("gram", F.substring("padded", F.col("at"), F.lit(ORDER))).drop("padded", "at")


def log_ratios(grams: DataFrame) -> DataFrame:
    """``grams(gram, allow, block)`` with counts of every distinct gram -> ``gram, ratio``."""
    n = {c: F.col(c) for c in ("allow", "block")}
    total = grams.agg(*[F.sum(c).alias(c) for c in n]).first()
    out = {}
    for c in n:
        p = F.lit(1 / 256)
        for k in range(1, ORDER + 1):
            seen = F.sum(c).over(Window.partitionBy(F.substring("gram", ORDER - k + 1, k)))
            before = F.sum(c).over(Window.partitionBy(F.substring("gram", ORDER - k + 1, k - 1))) if k > 1 else F.lit(total[c])
            p = (seen + PRIOR * p) / (before + PRIOR)
        out[c] = p
    # context of order k: the k - 1 characters before the last, hence the k - 1 first of the k-gram
    return grams.select("gram", (F.log(out["allow"]) - F.log(out["block"])).alias("ratio"))


def scores(urls: DataFrame) -> DataFrame:
    """``urls(url, allow, block, rows)``, distinct urls with the rows of each class and all -> the same with ``score``."""
    grams = _grams(urls).groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count("*").alias("held"))
    grams = stash(grams, "grams")
    ratios = stash(log_ratios(grams).join(grams.select("gram", "held"), "gram"), "ratios")
    if ratios.count() <= MOST_BROADCAST:
        met = _grams(urls).withColumn("times", F.lit(1)).join(F.broadcast(ratios), "gram")
    else:
        each = _grams(urls).groupBy("url", "allow", "block", "rows", "gram").agg(F.count("*").alias("times"))
        met = join_hot(each, ratios, ["gram"], F.col("held") >= hot_rows(grams.agg(F.sum("held")).first()[0]))
    weight = F.round(F.col("ratio") * 1e6).cast("long") * F.col("times")
    summed = met.groupBy("url", "allow", "block", "rows").agg(F.sum(weight).alias("s"), F.sum("times").alias("n"))
    return summed.select("url", "allow", "block", "rows", (F.col("s") / 1e6 / F.col("n")).alias("score"))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with ``_host, _path, _rule, _score`` and ``_verdict`` (allow or block)."""
    out = ("_host", "_path", "_rule", "_score", "_verdict")
    host, path = host_and_path(pages[url_col])
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("page"), F.coalesce(pages[url_col], F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "by_rule": verdict})
    urls = rows.groupBy("url").agg(F.count_if(F.col("by_rule") == "allow").alias("allow"), F.count_if(F.col("by_rule") == "block").alias("block"), F.count("*").alias("rows"))
    scored = stash(scores(spread(stash(urls, "urls"))), "scores")
    x = {c: (F.sum(F.col(c) * F.col("score")) / F.nullif(F.sum(c), F.lit(0)), F.sum(F.col(c) * F.col("score") ** 2) / F.nullif(F.sum(c), F.lit(0))) for c in ("allow", "block")}
    r = scored.agg(*[v.alias(f"{c}{i}") for c, pair in x.items() for i, v in enumerate(pair)]).first()
    if r.allow0 is None or r.block0 is None:
        cut = float("-inf")
    else:
        sd = {c: max(r[f"{c}1"] - r[f"{c}0"] ** 2, 1e-12) ** 0.5 for c in x}
        cut = (r.allow0 * sd["block"] + r.block0 * sd["allow"]) / (sd["allow"] + sd["block"])
    by_model = F.when(F.col("score") < cut, "block").otherwise("allow")
    hot = F.col("rows") >= hot_rows(scored.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
    rows = join_hot(rows, scored.select("url", "rows", "score"), ["url"], hot)
    values = dict(zip(out, (F.col("host"), F.col("path"), F.col("rule"), F.col("score"), F.coalesce("by_rule", by_model))))
    return rows.select(*[F.col(f"page.`{c}`") for c in pages.columns if c not in out], *[v.alias(c) for c, v in values.items()])
