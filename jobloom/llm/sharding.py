"""Sharding by longest-processing-time scheduling of groups that must stay together.

Groups are equal texts. Equal weights are interchangeable, so the schedule is made over the distinct weights and
how many groups have each: largest first, a heap on the driver hands groups to the least loaded shard, several
whole rounds at a time where shards stand within one weight of each other, which gives every shard just the groups
that handing them out one by one would. Weights stream past the driver in descending order and the schedule is written in chunks of
``CHUNK`` weights, so the driver holds a heap of the shards and one chunk, however many weights there are, and never groups or
rows. The groups of one weight are then dealt by their rank, so each group has a shard of its own at any size of input.

Ranks and slots are gapless row numbers. What is to be numbered is split into cells by a hash, of about one
4096th of all rows each; cells are counted before rows are numbered, so that no task numbers a hot weight or shard alone.
Groups of at least that many rows (there are at most 4096) are broadcast to their rows, all others are joined by a shuffle
in which no key holds more. Rows that are equal in all that is numbered are spread over the cells by a number that is written with them.

Defined cases: null texts are one group of their own with size 8, apart from empty ones; null and repeated
ids keep their rows; an empty table gives no rows; input columns other than the two named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_hot, new_folder, stash

CELLS = 4096
#: Weights of the schedule that the driver holds at once.
CHUNK = 50_000
MOST_BROADCAST = 500_000


def longest_first(weights: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """``weights`` as ``(weight, groups)``, largest first -> ``(weight, groups for each shard)`` in the same order.

    The same as giving groups one by one to the least loaded shard, the smallest of equally loaded ones.
    """
    heap = [(0, s) for s in range(shards)]
    for weight, count in weights:
        given = [0] * shards
        while count:
            near = [heapq.heappop(heap)]
            while heap and heap[0][0] < near[0][0] + weight:
                near.append(heapq.heappop(heap))
            # Each of ``near`` takes one group a round, until one of them would start at or above the next shard.
            rounds = count // len(near)
            if heap:
                rounds = min(rounds, -((near[-1][0] - heap[0][0]) // weight))
            taken = [rounds] * len(near)
            if rounds == 0:
                taken[:count] = [1] * count
            for (load, s), n in zip(near, taken):
                given[s] += n
                heapq.heappush(heap, (load + n * weight, s))
            count -= sum(taken)
        yield weight, given


def _written(plan: Iterator[tuple[int, list[int]]], per_cell: int, spark: SparkSession) -> DataFrame:
    """The schedule as a table: ranks of a weight go to the shards in turn, and ``ends`` has the rank after the last of each shard."""
    path, schema = new_folder(spark, "schedule"), "weight long, cells long, ends array<long>"
    while chunk := list(islice(plan, CHUNK)):
        ends = np.cumsum(np.array([given for _, given in chunk], np.int64), axis=1)
        table = pa.table({"weight": pa.array([w for w, _ in chunk], pa.int64()), "cells": pa.array(-(-ends[:, -1] // per_cell)), "ends": pa.array(list(ends), pa.list_(pa.int64()))})
        spark.createDataFrame(table).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _numbered(rows: DataFrame, key: str, cell: Column, order: list[str], out: str) -> DataFrame:
    """``rows`` with ``out``, gapless from 0 within ``key``; rows of a key are numbered cell by cell."""
    rows = rows.withColumn("cell", cell)
    counts = rows.groupBy(key, "cell").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    counts = stash(counts.select(key, "cell", F.coalesce(before, F.lit(0)).alias("before")), "cells")
    near = F.broadcast(counts) if counts.count() <= MOST_BROADCAST else counts
    at = F.row_number().over(Window.partitionBy(key, "cell").orderBy(*order))
    return rows.withColumn("at", at).join(near, [key, "cell"]).withColumn(out, (F.col("before") + F.col("at") - 1).cast("long")).drop("cell", "before", "at")


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, crc, shard, slot)`` for every row. ``size`` is the text's UTF-8 bytes plus 8."""
    text = docs[text_col]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    rows = docs.select(docs[id_col].alias("id"), size.alias("size"), F.crc32(text).alias("crc"), F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"null")).alias("group"))
    rows = stash(rows, "rows")
    groups = stash(rows.groupBy("group").agg(F.sum("size").alias("weight"), F.count("*").alias("n")), "groups")
    weights = stash(groups.groupBy("weight").agg(F.count("*").alias("groups"), F.sum("n").alias("n")), "weights")
    total = weights.agg(F.sum("n")).first()[0]
    if total is None:
        return rows.select("id", "size", "crc", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    per_cell = max(1000, total // CELLS)
    ordered = ((r.weight, r.groups) for r in weights.select("weight", "groups").orderBy(F.desc("weight")).toLocalIterator())
    plan = _written(longest_first(ordered, shards), per_cell, docs.sparkSession)
    dealt = join_hot(groups, plan, ["weight"], F.col("cells") > 1)
    ranked = _numbered(dealt, "weight", F.pmod(F.xxhash64("group"), "cells").cast("int"), ["group"], "rank")
    placed = stash(ranked.select("group", "n", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")), "placed")

    tagged = join_hot(rows, placed, ["group"], F.col("n") >= per_cell).select("id", "size", "crc", "shard")
    tagged = stash(tagged.withColumn("salt", F.monotonically_increasing_id()), "tagged")
    cell = F.pmod(F.xxhash64("id", "crc", "salt"), F.lit(max(1, CELLS // shards))).cast("int")
    return _numbered(tagged, "shard", cell, ["id", "crc"], "slot").select("id", "size", "crc", "shard", "slot")
