"""Duplicate removal: by identity, then by role, with deterministic survivors, order and merged facts.

Both steps are grouped minima over a few narrow columns, combined before the shuffle, so an identity or a role with a
third of all rows is no hot task; the wide row is fetched by its ``seq`` for survivors alone. ``seq`` is the order of the
input and unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.operators.postings import is_inbox


def richness() -> Column:
    c = F.col
    return F.coalesce(F.length("description"), F.lit(0)) + F.when(C.text(c("location")) != "", 10).otherwise(0) + F.when(c("published_at").isNotNull(), 5).otherwise(0) + F.when(c("url").contains("?"), 0).otherwise(1)


def _narrow(postings: DataFrame, scope: str | None = None) -> DataFrame:
    """What ranks and groups a row: ``best`` is least for the row to keep."""
    c = F.col
    postings = postings if scope is None else postings.withColumn("identity_key", F.struct(scope, "identity_key"))
    placed = (C.text(c("location")) != "") & C.is_location_eligible(c("location"), c("remote"))
    best = F.struct((~is_inbox()).alias("not_inbox"), (~placed).alias("not_placed"), (-richness()).alias("poor"), "canonical_url", "seq")
    role = F.struct(*([] if scope is None else [scope]), C.canonical_company(c("company")).alias("company"), C.normalize_title(c("title")).alias("title"))
    return postings.select("identity_key", "seq", best.alias("best"), role.alias("role"), (C.strip(C.text(c("company"))) == "").alias("unknown"), F.nullif(C.strip(C.text(c("location"))), F.lit("")).alias("place"), "russian_company")


def _identities(postings: DataFrame, scope: str | None = None) -> DataFrame:
    """One row an identity: its best row's facts, ``pos`` (where it first stood), ``n``, all places and whether any row has the flag."""
    groups = _narrow(postings, scope).groupBy("identity_key").agg(F.min(F.struct("best", "role", "unknown")).alias("b"), F.min("seq").alias("pos"), F.count("*").alias("n"), F.collect_set("place").alias("places"), F.max("russian_company").alias("flag"))
    return groups.select("identity_key", "b.*", "pos", "n", "places", "flag")


def by_identity(postings: DataFrame) -> DataFrame:
    """The best row of each identity with ``pos`` and ``n``."""
    best = _identities(postings).select(F.col("best.seq").alias("seq"), "pos", "n")
    return postings.join(best, "seq")


def deduplicate(postings: DataFrame, scope: str | None = None) -> DataFrame:
    """The survivor of each role, or of each identity where the employer is unknown.

    Adds ``out_pos`` (the order of the output), ``advertised_locations`` (only where rows were merged) and ``merged``
    (rows that went into the survivor). Equal rows keep the earlier one. With the column ``scope`` rows of different
    values are never merged, so that many inputs go through one plan.
    """
    c = F.col
    role = F.struct(F.when(c("unknown"), c("identity_key")).alias("identity"), F.when(~c("unknown"), c("role")).alias("role"))
    best = F.struct("best.not_inbox", "best.not_placed", "best.poor", "best.canonical_url", "pos", "best.seq")
    groups = _identities(postings, scope).groupBy(role.alias("group")).agg(F.min(best).alias("b"), F.max("pos").alias("out_pos"), F.sum("n").alias("merged"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"), F.max("flag").alias("any_flag"))
    places = F.when(c("merged") > 1, c("places")).otherwise(F.array().cast("array<string>"))
    kept = groups.select(c("b.seq").alias("seq"), "out_pos", "merged", places.alias("advertised_locations"), "any_flag")
    return postings.join(kept, "seq").withColumn("russian_company", c("any_flag")).select(*postings.columns, "advertised_locations", "out_pos", "merged")


def strategy_counts(postings: DataFrame) -> DataFrame:
    """Identity groups by the strategy of their first row: a grouped minimum, no window."""
    first = postings.groupBy("identity_key").agg(F.min_by("identity_strategy", "seq").alias("strategy"))
    return first.groupBy("strategy").agg(F.count("*").alias("groups"))


def duplicate_identities(postings: DataFrame) -> DataFrame:
    """Identity groups of several rows with their urls in input order."""
    groups = postings.groupBy("identity_key").agg(F.count("*").alias("count"), F.min_by("identity_strategy", "seq").alias("strategy"), F.array_sort(F.collect_list(F.struct("seq", "url"))).alias("items"))
    return groups.where("count > 1").withColumn("urls", F.transform("items", lambda x: x["url"])).drop("items")


def duplicate_roles(postings: DataFrame) -> DataFrame:
    """Roles that several identities of a known employer share."""
    df = _identities(postings).where("NOT unknown")
    return df.groupBy("role.company", "role.title").agg(F.count("*").alias("count")).where("count > 1")


def exact_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The smallest id of each distinct text, with the number of copies."""
    return docs.groupBy(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256).alias("digest")).agg(F.min(id_col).alias("keeper"), F.count("*").alias("copies"))
