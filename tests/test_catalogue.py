"""Every catalogue query against its SQL; those without SQL run and have rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from jobloom.operators import reports
from jobloom.plans import catalogue, oracle, parsing
from jobloom.plans.fixtures import raw_postings
from tests.oracle import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, name):
    got = rows_of(catalogue.QUERIES[name](spark, sf_dir))
    if name in oracle.SQL:
        assert got == sql_rows(oracle.SQL[name], sf_dir)
    else:
        assert got[1]


@pytest.mark.parametrize("name", sorted(parsing.QUERIES))
def test_parsing(spark, sf_dir, name):
    got = rows_of(parsing.QUERIES[name](spark, sf_dir))
    assert got == sql_rows(parsing.SQL[name], sf_dir) and got[1]


def test_digests_against_packing_line_by_line(spark, sf_dir):
    normal = catalogue._normal(spark, sf_dir).withColumn("day", F.date_format("published_at", "yyyy-MM"))
    rows = normal.select("seq", "day", reports.vacancy_label().alias("label"), F.trim("url").alias("url")).collect()
    want = {}
    for day in {r.day for r in rows}:
        parts, size = [[]], 160
        for i, r in enumerate(sorted((r for r in rows if r.day == day), key=lambda r: r.seq), 1):
            text = f"{i}. {r.label}\n   {r.url}"
            if parts[-1] and size + len(text) + 1 > 700:
                parts.append([])
                size = 160
            parts[-1].append(text)
            size += len(text) + 1
        for n, p in enumerate(parts, 1):
            want[day, n] = (len(parts), len(p), hashlib.sha256("\n".join(p).encode()).hexdigest())
    packed = reports.pack_digest(normal, limit=700).collect()
    got = {(r.digest, r.part): (r.parts, r.items, hashlib.sha256(r.message.encode()).hexdigest()) for r in packed}
    assert all(len(r.message) <= 700 for r in packed)
    assert got == want and any(n > 1 for _, n in want)


def test_message_postings_against_their_source(spark, sf_dir):
    """Which messages are kept, and what they give, told from the rows that the messages were written from."""
    raw = {r.seq: r for r in raw_postings(spark, sf_dir).collect()}
    got = {int(r.source_job_id.split(":")[1]): r for r in catalogue.q_messages(spark, sf_dir).collect()}
    assert got
    role = re.compile(r"\b(developer|engineer)\b", re.I)
    for seq, r in raw.items():
        plain = re.search(r"\b(ios|swift)\b", r.title, re.I) and role.search(r.title) and not re.search("qa |android|react|flutter|kotlin|стажер", r.title, re.I)
        if plain:
            # of the heads only the hashtag says that this is a vacancy: "hiring" counts where words follow it
            assert (seq in got) == (seq % 4 >= 2), (seq, r.title)
        if seq in got:
            m = got[seq]
            assert m.url == f"https://apply.example.com/{seq}" and m.source_job_id == f"ch{seq % 3}:{seq}" and m.source == "telegram"
            if plain:
                assert m.title == re.sub(r"\s+", " ", r.title).strip()
            if seq % 4 >= 2:
                assert m.company == ""


def test_entry_has_the_catalogue():
    import __spark_entry__

    assert set(catalogue.QUERIES) | set(parsing.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_narrow_tables_are_spread_by_their_size(spark, tmp_path):
    """A file of one row group is one task of a scan, however large it is."""
    from jobloom.plans import fixtures

    spark.range(100_000).withColumn("p_name", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert fixtures.table(spark, str(tmp_path), "part").rdd.getNumPartitions() >= 100_000 * 64 // fixtures.TASK_BYTES


def test_postings_are_spread_after_their_joins(spark, tmp_path):
    """A join's tasks are few, as they are cut by bytes, and each posting is worth much more work than that."""
    from jobloom.plans import fixtures

    k = F.col("id")
    orders = spark.range(60_000).select(k.alias("o_orderkey"), (k % 50).alias("o_custkey"), F.sha2(k.cast("string"), 256).alias("o_orderpriority"), F.lit("2024-01-01").cast("date").alias("o_orderdate"))
    for name, df in {"orders": orders, "customer": spark.range(50).select(k.alias("c_custkey"), (k % 5).alias("c_nationkey")), "nation": spark.range(5).select(k.alias("n_nationkey"), F.lit("N").alias("n_name"))}.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    assert raw_postings(spark, str(tmp_path)).rdd.getNumPartitions() >= 60_000 * 64 // fixtures.TASK_BYTES


def test_bodies_are_dealt_over_the_cores(spark):
    rows = spark.range(400).select(F.col("id").alias("k"), F.floor(F.col("id") / 10).alias("source_id"))
    assert parsing._bodies(rows, F.col("k").cast("string"), "", "").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_a_label_takes_marks_that_are_known(spark):
    df = spark.createDataFrame([("Co", "src", "u"), ("", "src", "u"), (None, "src", " u ")], "company string, source string, url string")
    assert [r.l for r in df.select(reports.vacancy_label(F.lit("m")).alias("l")).collect()] == ["Co — m", "m", "m"]
    assert [r.l for r in df.select(reports.vacancy_label(F.lit("")).alias("l")).collect()] == ["Co", "u", "u"]
