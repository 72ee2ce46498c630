"""Three-way merge of keyed state: base, local and remote versions of one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.plans.storage import stash


class StateConflict(ValueError):
    """Both sides changed the same field differently, or a state was published under a changed one too often."""


def merge_three_way(base: DataFrame, local: DataFrame, remote: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value, status)`` of every key of the three.

    A side that did not change yields to the other, deletions included; equal changes agree; both sides having
    changed differently is a ``conflict`` (value null). Rows whose merged state is deletion have status ``deleted``.
    Two full outer joins on the key; null values count as present.
    """
    side = lambda df, n: df.select(F.col(key).alias("key"), F.struct(F.col(value).alias("v")).alias(n))
    df = side(base, "b").join(side(local, "l"), "key", "full_outer").join(side(remote, "r"), "key", "full_outer")
    b, le, r = F.col("b"), F.col("l"), F.col("r")
    conflict = ~le.eqNullSafe(b) & ~r.eqNullSafe(b) & ~le.eqNullSafe(r)
    merged = F.when(le.eqNullSafe(b), r).otherwise(le)
    status = F.when(conflict, "conflict").when(merged.isNull(), "deleted").otherwise("kept")
    return df.select("key", F.when(~conflict, merged["v"]).alias("value"), status.alias("status"))


def merge_max(*sides: DataFrame, key: str, value: str) -> DataFrame:
    """Cursors: the largest value of each key on any side."""
    return reduce(DataFrame.unionByName, [s.select(key, value) for s in sides]).groupBy(key).agg(F.max(value).alias(value))


def merge_union(*sides: DataFrame, columns: list[str]) -> DataFrame:
    """Slots and other sets: the union of rows."""
    return reduce(DataFrame.union, [s.select(columns) for s in sides]).distinct()


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _ordered_numbers(c: str) -> Column:
    return F.coalesce(F.from_json(c, "array<bigint>"), F.array().cast("array<bigint>"))


def _decide(union: str | None) -> Column:
    """What becomes of one path with the JSON texts ``b``, ``l`` and ``r`` of the three sides, null where a side lacks it:
    ``gone``, ``open`` (an object to be merged field by field), ``conflict``, or the value to keep."""
    sides = [F.col(x) for x in "blr"]
    gone = F.col("l").isNull() & (F.col("r").isNull() | _same("r", "b")) | F.col("r").isNull() & _same("l", "b")
    objects = reduce(Column.__and__, [x.isNull() | x.startswith("{") for x in sides])
    state = lambda name, value=F.lit(None).cast("string"): F.struct(F.lit(name).alias("state"), value.alias("value"))
    out = F.when(gone, state("gone"))
    if union:
        here = F.try_element_at("path", F.lit(-1)) == union
        numbers = reduce(Column.__and__, [x.isNull() | x.rlike(r"^\[(-?\d+(,-?\d+)*)?\]$") for x in sides])
        joined = F.to_json(F.array_sort(F.array_distinct(F.concat(*[_ordered_numbers(x) for x in "blr"]))))
        out = F.when(here & numbers, state("kept", joined)).when(here, state("conflict")).when(gone, state("gone")).when(objects, state("open"))
    out = out.when(_same("l", "r") | _same("r", "b"), state("kept", F.col("l"))).when(_same("l", "b"), state("kept", F.col("r")))
    return out.when(objects, state("open")).otherwise(state("conflict"))


def _fields(level: DataFrame) -> DataFrame:
    """The fields of the objects in ``level``, one row a name that any side has."""
    maps = level.select("key", "path", *[F.coalesce(F.try_variant_get(F.try_parse_json(x), "$", "map<string,variant>"), F.expr("map()").cast("map<string,variant>")).alias(x) for x in "blr"])
    names = reduce(F.array_union, [F.map_keys(x) for x in "blr"])
    rows = maps.select("key", "path", *"blr", F.explode(names).alias("name"))
    return rows.select("key", F.concat("path", F.array("name")).alias("path"), *[F.to_json(F.try_element_at(x, F.col("name"))).alias(x) for x in "blr"])


def merge_documents(base: DataFrame, local: DataFrame, remote: DataFrame, key: str = "key", document: str = "document", history: bool = False, union: str | None = None) -> DataFrame:
    """``(key, document, status, depth)`` of every key of the three: JSON documents merged field by field, at any depth.

    A side that left a path as it was yields to the other, deletions included; a path that one side deleted and the other left
    goes with all below it; objects on all sides that have the path are merged field by field; other values, lists among them,
    are taken whole; where both sides changed one differently the record is a ``conflict`` (document null, ``depth`` of its
    uppermost). ``deleted`` records have a null document. In a ``history`` a record that a side dropped counts as
    unchanged there, so nothing is lost by pruning. Fields named ``union`` hold lists of whole numbers that only grow: their sorted
    union, whatever was deleted.

    One full outer join aligns the three; each level of nesting is then a projection of the records that still differ, and
    the way back up one grouping a level. Null keys and documents that are no JSON count as absent.
    """
    side = lambda df, n: df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.to_json(F.try_parse_json(document)).alias(n))
    level = side(base, "b").join(side(local, "l"), "key", "full_outer").join(side(remote, "r"), "key", "full_outer")
    if history:
        level = level.select("key", "b", *[F.coalesce(x, "b").alias(x) for x in "lr"])
    level = level.select("key", F.array().cast("array<string>").alias("path"), *"blr")
    levels = []
    while not levels or not levels[-1].where("state = 'open'").isEmpty():
        if levels:
            level = _fields(levels[-1].where("state = 'open'"))
        levels.append(stash(level.withColumn("out", _decide(union)).select("key", "path", *"blr", "out.*"), f"merged_{len(levels)}"))

    below = None
    for depth in reversed(range(len(levels))):
        rows = levels[depth].select("key", "path", "state", "value", F.when(F.col("state") == "conflict", depth).alias("depth"))
        if below is not None:
            rows = rows.join(below, ["key", "path"], "left")
            whole = F.concat(F.lit("{"), F.coalesce("inner", F.lit("")), F.lit("}"))
            rows = rows.select("key", "path", "state", F.when(F.col("state") == "open", whole).otherwise(F.col("value")).alias("value"), F.coalesce("depth", "deeper").alias("depth"))
        if depth:
            name = F.element_at("path", -1)
            quoted = F.regexp_extract(F.to_json(F.array(name)), r"(?s)^\[(.*)\]$", 1)
            piece = F.when(F.col("value").isNotNull(), F.struct(name.alias("name"), F.concat(quoted, F.lit(":"), "value").alias("text")))
            inner = F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["text"]), ",")
            below = rows.groupBy("key", F.slice("path", F.lit(1), F.lit(depth - 1)).alias("path")).agg(inner.alias("inner"), F.min("depth").alias("deeper"))
    conflict = F.col("depth").isNotNull()
    status = F.when(conflict, "conflict").when(F.col("value").isNull(), "deleted").otherwise("kept")
    return rows.select("key", F.when(~conflict, F.col("value")).alias("document"), status.alias("status"), "depth")


def resolved(merged: DataFrame) -> DataFrame:
    """``(key, document)`` of a merge without conflicts; one with conflicts fails, naming their number and depth and no key."""
    fights = merged.where("status = 'conflict'").groupBy("depth").count().orderBy("depth").collect()
    if fights:
        raise StateConflict("Concurrent field conflicts: " + ", ".join(f"{r['count']} at depth {r['depth']}" for r in fights))
    return merged.where("status = 'kept'").select("key", "document")
