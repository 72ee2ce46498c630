"""A corpus pipeline of five stages over ``documents``: toxicity, near-duplicates, benchmark passages, mixing, shards.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row its predecessor kept. All but the last
return the columns of ``documents``; the last adds the shard and slot of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import common, decontam, mixing, neardup, sharding, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled documents among these, scores below 0.5."""
    common.small_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group.

    Rows with a null id all stay. Where ids repeat, their rows count as documents of their own, so an id goes or stays
    text by text; of rows equal in id and text one stays, and of near texts under one id the one numbered first.
    """
    common.small_batches(spark)
    ids = docs.select(docs["doc_id"].alias("id")).where("id IS NOT NULL")
    repeated = common.stash(ids.groupBy("id").count().where("count > 1").select("id"), "repeated")
    if repeated.isEmpty():
        gone = common.stash(neardup.near_duplicates(docs).where("NOT kept").select("id"), "gone")
        return docs.join(_near(gone), docs["doc_id"] == gone["id"], "left_anti")
    once = docs.join(repeated, docs["doc_id"] == repeated["id"], "left_anti")
    again = docs.join(repeated, docs["doc_id"] == repeated["id"], "left_semi").dropDuplicates(["doc_id", "text"])
    number = F.lit(ids.agg(F.min("id")).first()[0]) - 1 - F.monotonically_increasing_id()
    again = common.stash(again.select(F.struct(*[again[f"`{c}`"] for c in docs.columns]).alias("doc"), number.alias("key")), "again")
    named = again.select("key", F.col("doc.doc_id").alias("id"))
    texts = once.select(once["doc_id"].alias("key"), once["text"].alias("text")).union(again.select("key", "doc.text"))
    found = common.stash(neardup.near_duplicates(texts, id_col="key").where("id IS NOT NULL").select(F.col("id").alias("key"), "component"), "found")
    order = F.struct(F.coalesce("id", "key").alias("id"), F.col("key").alias("key"))
    first = found.join(named, "key", "left").groupBy("component").agg(F.min(order).alias("first")).select("first.key")
    gone = common.stash(found.select("key").join(first, "key", "left_anti"), "gone")
    once = once.join(_near(gone), once["doc_id"] == gone["key"], "left_anti")
    return once.unionByName(again.join(gone, "key", "left_anti").select("doc.*"))


def _near(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= 500_000 else ids


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item to 75 percent of its shingles."""
    common.small_batches(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mix of the sources: nine tenths of all tokens dealt by weight, each document at most once."""
    mixed = mixing.mix(docs, mixing.source_tree(), mixing.WEIGHTS, share=0.9, max_epochs=1)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its size, shard (of 24) and slot."""
    placed = sharding.assign_shards(docs, shards=24)
    return placed.select(F.col("id").alias("doc_id"), "size", "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Training, sketching and scheduling have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
