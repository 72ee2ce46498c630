"""The registered queries of this subpackage: thin applications of its operators to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, spread, stash


def _with_small_batches(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return f(spark, sf_dir)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scan; one of fewer partitions than cores (a small file of one row group) is spread over them."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages") else df


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_conversations, read_back

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], rows.schema)
    return read_back(format_conversations(rows.unionByName(more)), in_order=True)


def op2_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, find_pii

    out = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == F.lit(kind)))).cast("long").alias(f"n_{kind}")

    return out.select(F.col("id").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op3_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import WEIGHTS, mix, source_tree, token_count

    # The result has no texts, so each is cut into tokens once and the operator works on the counts.
    docs = table(spark, sf_dir, "documents")
    docs = stash(docs.select("doc_id", "lang", "source", token_count(docs["text"]).alias("tokens")), "counted")
    out = mix(docs, source_tree(), WEIGHTS, tokens=F.col("tokens"))
    return out.select("doc_id", F.col("_mix_domain").alias("domain"), F.col("_mix_lang").alias("lang"), F.col("_mix_source").alias("source"), F.col("_mix_epoch").alias("epoch"), F.col("_mix_tokens").alias("tokens"), F.col("_mix_budget").alias("budget"))


def op4_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import apply_quality

    out = apply_quality(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_warc_sharded_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_folder, read_warc, write_warc

    folder = archive_folder(spark)
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import judge

    out = judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import contamination

    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("n_item").alias("n_item_shingles"), "n_shared")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train, training_fold

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = score(docs, model)
    held = ~training_fold(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign_shards

    out = assign_shards(table(spark, sf_dir, "documents"), shards=24)
    return out.select(F.col("id").alias("doc_id"), "size", F.coalesce("crc", F.lit(0)).cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_join

    out = jaccard_join(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_groups

    return spelling_groups(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_skip_chain_pii": op2_skip_chain_pii,
    "op3_hierarchical_mixing": op3_hierarchical_mixing,
    "op4_host_quality_rules": op4_host_quality_rules,
    "op5_warc_sharded_writer": op5_warc_sharded_writer,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_url_language_model": op8_url_language_model,
    "op9_toxicity": op9_toxicity,
    "op10_lpt_sharding": op10_lpt_sharding,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}


QUERIES = {name: _with_small_batches(f) for name, f in QUERIES.items()}


def _oracles() -> dict[str, str]:
    from . import chat, decontam, divergence, jaccard, mixing, quality, spelling, warc

    return {"op1_chat_formatting": chat.ORACLE, "op4_host_quality_rules": quality.ORACLE, "op5_warc_sharded_writer": warc.ORACLE, "op3_hierarchical_mixing": mixing.ORACLE, "op6_benchmark_decontamination": decontam.ORACLE, "op11_jaccard_join": jaccard.ORACLE, "op12_spelling_variants": spelling.ORACLE, "op13_source_divergence": divergence.ORACLE}


ORACLE_SQL: dict[str, str] = _oracles()
