"""Mixing sources to target weights by hierarchical budgeting.

Leaves of a tree (say domain, language, source) have a capacity: their tokens times ``max_epochs``. The
target is dealt down the tree. Among siblings a budget goes in proportion to their weights; what a full
sibling cannot take is dealt again among the others (water filling), and since a parent's capacity is the
sum of its children's, a shortage reaches the parent's siblings only when all below the parent are full.

A leaf takes whole epochs and then a prefix, to its budget, of the next epoch in that epoch's seeded
order (hash, id, tokens). Where the prefix ends is found on a narrow table in three steps: sums over 256 buckets of
the order, over 256 parts of the bucket in which the prefix ends, and row by row only in the part in which it ends,
a 65,536th of the leaf. The documents are then read once and compared with their leaf's cut, so whole rows are never
sorted or shuffled.

Built-in column functions only. Defined cases: a token is a run of characters other than space and
TAB..CR; null texts have none and null tree values count as ''; a leaf without tokens takes no rows; a
weight not given is 1 and a weight of 0 takes nothing; rows of equal id go by token count, and of rows equal in both as
many are taken as fit; an empty table gives no rows. All columns of the input are carried along, whatever their names;
one named like an output (``_mix_...``) is replaced by it. The children of the root are dealt in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

SPACES = r"[ \t\n\x0B\f\r]+"
MOST_BROADCAST = 500_000


def token_count(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACES), "")), F.lit(0)).cast("long")


def _pour(nodes: DataFrame, parents: list[str], node: str, budget: Column, out: str) -> DataFrame:
    """Deal ``budget`` of each parent among its children by ``_mix_w``, none above ``_mix_cap``."""
    ratio = F.when(F.col("_mix_w") > 0, F.col("_mix_cap") / F.col("_mix_w")).otherwise(F.lit(float("inf")))
    here = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    before = here.orderBy("_mix_r", node).rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("_mix_r", ratio).withColumn("_mix_p", budget)
    cap, w = (F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("_mix_cap", "_mix_w"))
    nodes = nodes.withColumns({"_mix_cb": cap, "_mix_wb": w, "_mix_wt": F.sum("_mix_w").over(here)})
    level = (F.col("_mix_p") - F.col("_mix_cb")) / F.nullif(F.col("_mix_wt") - F.col("_mix_wb"), F.lit(0))
    nodes = nodes.withColumn("_mix_full", F.coalesce(F.col("_mix_r") <= level, F.lit(False)))
    full = lambda c: F.sum(F.when(F.col("_mix_full"), F.col(c)).otherwise(0)).over(here)
    level = (F.col("_mix_p") - full("_mix_cap")) / F.nullif(F.col("_mix_wt") - full("_mix_w"), F.lit(0))
    share = F.when(F.col("_mix_full"), F.col("_mix_cap").cast("double")).otherwise(F.coalesce(F.col("_mix_w") * level, F.lit(0.0)))
    return nodes.withColumn(out, share).select(*parents, node, out)


def budgets(leaves: DataFrame, levels: list[str], weights: dict[tuple, int], target: int, max_epochs: int) -> DataFrame:
    """``leaves(levels..., tokens)`` -> with ``budget``, ``full`` (whole epochs) and ``rest`` (tokens of the next).

    ``weights`` maps a path from the root, such as ``("web", "en")``, to an integer weight among siblings.
    """
    dealt = None
    for depth, node in enumerate(levels):
        path = levels[: depth + 1]
        given = {k: v for k, v in weights.items() if len(k) == depth + 1}
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("_mix_cap"))
        w = F.lit(1)
        for k, v in given.items():
            here = F.lit(True)
            for c, x in zip(path, k):
                here &= F.col(c) == F.lit(x)
            w = F.when(here, F.lit(v)).otherwise(w)
        nodes = nodes.withColumn("_mix_w", w.cast("long"))
        if dealt is None:
            budget = F.lit(float(target))
        else:
            nodes = nodes.join(dealt.withColumnRenamed("_mix_b", "_mix_up"), path[:-1])
            budget = F.col("_mix_up")
        dealt = _pour(nodes, path[:-1], node, budget, "_mix_b")
    out = leaves.join(dealt, levels).withColumn("budget", F.floor("_mix_b").cast("long"))
    return out.withColumn("full", F.least(F.floor(F.col("budget") / F.nullif("tokens", F.lit(0))), F.lit(max_epochs)).cast("int")).where("full IS NOT NULL").withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")).select(*levels, "budget", "full", "rest")


def _first_parts(rows: DataFrame, keys: list[str], part: Column) -> DataFrame:
    """The part of each leaf's rows in which its prefix ends: ``keys, part, before`` (tokens of the earlier parts)."""
    sums = rows.groupBy(*keys, "rest", "from", part.alias("part")).agg(F.sum("tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    ends = sums.withColumn("upto", F.col("from") + upto).where("upto > rest")
    return ends.groupBy(*keys).agg(F.min(F.struct("part", (F.col("upto") - F.col("n")).alias("before"))).alias("x")).select(*keys, "x.*")


def _cuts(rows: DataFrame, keys: list[str], near) -> DataFrame:
    """``keys, cut(h, id, tokens), copies``: the first key of each leaf that is not taken whole, and how many rows of it are.

    ``rows`` have ``keys, rest, h, id, tokens``. A leaf whose rows all fit has no cut.
    """
    rows, part = rows.withColumn("from", F.lit(0).cast("long")), None
    for k in (1, 3):
        part = F.substring("h", k, 2)
        ends = stash(_first_parts(rows, keys, part), "parts")
        rows = rows.join(near(ends), keys).where(part == F.col("part")).withColumn("from", F.col("before")).drop("part", "before")
    at = Window.partitionBy(*keys).orderBy("h", "id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("fits", F.col("from") + F.sum("tokens").over(at) <= F.col("rest"))
    cut = F.struct("h", "id", "tokens")
    first = rows.where(~F.col("fits")).groupBy(*keys).agg(F.min(cut).alias("cut"))
    return rows.join(first, keys).groupBy(*keys, "cut").agg(F.count_if(F.col("fits") & (cut == F.col("cut"))).alias("copies"))


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[tuple, int], share: float = 0.8, max_epochs: int = 2, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """Rows of ``docs`` once for each epoch that takes them, with ``_mix_<level>``, ``_mix_epoch``, ``_mix_tokens`` and
    ``_mix_budget``. The target is ``share`` of all tokens; ``levels`` maps names to columns, root first; ``tokens`` stands
    for the tokens of a text where they are known already."""
    keys = [f"level{i}" for i in range(len(levels))]
    tree = [F.coalesce(c.cast("string"), F.lit("")).alias(k) for k, c in zip(keys, levels.values())]
    count = token_count(docs[text_col]) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0))
    # Rows without an id are told apart by what is in them.
    id_ = F.coalesce(docs[id_col].cast("string"), F.concat(F.lit("no id "), F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns]).cast("string")))
    narrow = stash(docs.select(*tree, count.alias("tokens"), id_.alias("id")), "tokens")
    leaves = narrow.groupBy(*keys).agg(F.sum("tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = stash(budgets(leaves, keys, weights, int(total * share), max_epochs), "budgets")
    near = F.broadcast if plan.count() <= MOST_BROADCAST else (lambda x: x)

    order = F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col("full") + 1).cast("string"), "id"))
    cuts = stash(_cuts(narrow.join(near(plan.where("rest > 0")), keys).withColumn("h", order), keys, near), "cuts")
    plan = plan.join(near(cuts), keys, "left")

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *tree, count.alias("tokens"), id_.alias("id")).join(near(plan), keys)
    rows = rows.withColumn("h", F.when((F.col("rest") > 0) & F.col("cut").isNotNull(), order))
    here, cut = F.struct("h", "id", "tokens"), F.col("cut")
    below = F.when(F.col("rest") <= 0, False).when(cut.isNull(), True).when(F.col("h") != cut["h"], F.col("h") < cut["h"]).otherwise(here < cut)
    rows = rows.withColumn("epochs", F.col("full") + below.cast("int"))
    taken = rows.withColumn("epoch", F.explode(F.when(F.col("epochs") > 0, F.sequence(F.lit(1), F.col("epochs")))))
    # Rows equal to the cut, of which some fit: there are such only where a leaf repeats an id and a token count.
    split = rows.where((F.col("copies") > 0) & (F.col("h") == cut["h"]) & (here == cut))
    split = split.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy("tokens"))).where("turn <= copies").withColumn("epoch", F.col("full") + 1)
    out = {**{f"_mix_{n}": F.col(k) for n, k in zip(levels, keys)}, "_mix_epoch": F.col("epoch"), "_mix_tokens": F.col("tokens"), "_mix_budget": F.col("budget")}
    keep = [*[F.col(f"doc.`{c}`") for c in docs.columns if c not in out], *[v.alias(k) for k, v in out.items()]]
    return taken.select(*keep).unionByName(split.select(*keep))


def source_tree() -> dict[str, Column]:
    """The tree used on ``documents``: a domain from the source's number, then language, then source."""
    number = F.nullif(F.regexp_extract("source", "[0-9]+$", 0), F.lit("")).cast("long")
    return {"domain": F.concat(F.lit("d"), (number % 4).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


WEIGHTS = {("d0",): 4, ("d1",): 3, ("d2",): 2, ("d3",): 1} | {(d, "en"): 3 for d in ("d0", "d1", "d2", "d3")}


def _oracle_level(k: int) -> str:
    names = ["domain", "lang", "source"]
    path, up = names[:k], names[: k - 1]
    part = f"PARTITION BY {', '.join(up)}" if up else ""
    w = ["CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 WHEN 'd3' THEN 1 ELSE 1 END", "CASE WHEN lang = 'en' AND domain IN ('d0', 'd1', 'd2', 'd3') THEN 3 ELSE 1 END", "1"][k - 1]
    p = "(SELECT CAST(floor(sum(tokens) * 0.8) AS DOUBLE) FROM leaves)" if k == 1 else f"b{k - 1}"
    src = f"(SELECT {', '.join(path)}, CAST(sum(tokens) * 2 AS BIGINT) AS cap, {w} AS w FROM leaves GROUP BY {', '.join(path)})"
    src += f" JOIN l{k - 1} USING ({', '.join(up)})" if up else ""
    return f"""
n{k} AS (SELECT *, {p} AS p, cap / w AS r FROM {src}),
c{k} AS (SELECT *, coalesce(sum(cap) OVER ({part} ORDER BY r, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb, coalesce(sum(w) OVER ({part} ORDER BY r, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb, sum(w) OVER ({part}) AS wt FROM n{k}),
f{k} AS (SELECT *, r <= (p - cb) / (wt - wb) AS whole FROM c{k}),
l{k} AS (SELECT {', '.join(path)}, CASE WHEN whole THEN CAST(cap AS DOUBLE) ELSE w * ((p - sum(CASE WHEN whole THEN cap ELSE 0 END) OVER ({part})) / nullif(wt - sum(CASE WHEN whole THEN w ELSE 0 END) OVER ({part}), 0)) END AS b{k} FROM f{k})"""


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce('d' || (CAST(nullif(regexp_extract(source, '[0-9]+$'), '') AS BIGINT) % 4), '') AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(coalesce(len(list_filter(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+'), lambda x: x <> '')), 0) AS BIGINT) AS tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM d GROUP BY ALL),""" + ",".join(_oracle_level(k) for k in (1, 2, 3)) + r""",
plan AS (SELECT domain, lang, source, CAST(floor(b3) AS BIGINT) AS budget, least(CAST(floor(floor(b3) / tokens) AS INTEGER), 2) AS whole, tokens AS leaf_tokens FROM l3 JOIN leaves USING (domain, lang, source) WHERE tokens > 0),
taken AS (
  SELECT d.*, budget, CAST(e AS INTEGER) AS epoch, whole, budget - whole * leaf_tokens AS rest,
    sum(tokens) OVER (PARTITION BY domain, lang, source, e ORDER BY md5('7|' || e || '|' || doc_id), CAST(doc_id AS VARCHAR), tokens ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN plan USING (domain, lang, source), (VALUES (1), (2), (3)) AS epochs(e))
SELECT doc_id, domain, lang, source, epoch, tokens, budget FROM taken
WHERE epoch <= whole OR (epoch = whole + 1 AND rest > 0 AND upto <= rest)
"""
