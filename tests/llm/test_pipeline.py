"""The pipeline's stages on a small table with planted cases, and the whole run."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from jobloom.llm import decontam, mixing, toxicity
from tests.llm.test_edges import mix_brute
from tests.llm.test_queries import near_dup_brute


def mixed_brute(rows):
    """Ids that the mixing stage takes from these rows."""
    def path(r):
        number = re.search(r"[0-9]+$", r.source or "")
        return f"d{int(number[0]) % 4}" if number else "", r.lang or "", r.source or ""

    tokens = lambda t: len(re.findall(r"[^ \t-\r]+", t or ""))
    return {i for i, _ in mix_brute([(r.doc_id, path(r), tokens(r.text)) for r in rows], mixing.WEIGHTS, 0.9, 1)}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = docs.collect()
        before = {r.doc_id: r.text for r in rows}
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        after = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and after <= set(before)
        if name == "toxicity":
            scored = toxicity.train(spark.createDataFrame(list(before.items()), "doc_id long, text string"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert after == {i for i, t in before.items() if scored.score([t or ""])[0] < 0.5}
        if name == "mixing":
            assert after == mixed_brute(rows)
        if name == "near_dedup":
            assert after == {i for i, (_, c) in near_dup_brute(list(before.items())).items() if c == i}
        if name == "decontamination":
            tests = [decontam.shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            hit = {i for i, t in before.items() if any(100 * len(s & decontam.shingles(t)) >= 75 * len(s) for s in tests if s)}
            assert after == set(before) - hit
    name, last = corpus_pipeline.STAGES[-1]
    placed = last(spark, docs, sf_dir)
    of, loads = {}, Counter()
    for r in docs.collect():
        of.setdefault(r.text, []).append(r.doc_id)
    where = {r.doc_id: r.shard for r in placed.collect()}
    assert all(len({where[i] for i in ids}) == 1 for ids in of.values())
    weights = sorted(((len((t or "").encode()) + 8) * len(ids) for t, ids in of.items()), reverse=True)
    for w in weights:
        loads[min(range(24), key=lambda s: (loads[s], s))] += w
    got = Counter()
    for r in placed.collect():
        got[r.shard] += r.size
    assert got == +loads
    assert placed.count() == docs.count() and placed.agg(F.max("shard")).first()[0] <= 23
    assert set(seen) >= {r.doc_id for r in placed.collect()}


def test_edges(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x y", "en", "s", 3)], schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    docs.collect()
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
    assert empty.count() == 0


def test_repeated_and_null_ids_in_near_dedup(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i}" for i in range(200))
    nulls = [(None, "x y"), (None, "x y"), (None, None), (None, None), (None, ""), (None, long)]
    alone = [(1, "one two three four five six")]
    again = [(2, long), (2, long + " more"), (2, long), (3, "quite another text of some words"), (3, "and a second one that is different"), (4, ""), (4, None), (4, "")]
    run = lambda rows: [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame([(*r, "en", "s", 0) for r in rows], schema), sf_dir).collect()]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(run(nulls + alone), key=key) == sorted(nulls + alone, key=key)
    got = run(nulls + alone + again)
    assert sorted((r for r in got if r[0] is None), key=key) == sorted(nulls, key=key)
    assert sum(r[0] == 2 for r in got) == 1 and sorted((r for r in got if r[0] not in (None, 2)), key=key) == sorted([*alone, again[3], again[4], (4, ""), (4, None)], key=key)


def test_near_dedup_of_a_repeated_id_goes_text_by_text(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _gone long, id long, key long, count long, _row long"
    long, other = (" ".join(f"{x}{i}" for i in range(200)) for x in "wv")
    rows = [(1, long), (5, long + " more"), (5, other), (9, other + " more"), (-3, "a b c d e f")]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame([(*r, "en", "s", 0, 7, 8, 9, 10, 11) for r in rows], schema), sf_dir)
    assert got.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(-3, "a b c d e f"), (1, long), (5, other)]
    assert {tuple(r)[5:] for r in got.collect()} == {(7, 8, 9, 10, 11)}


def test_all_stages_with_clashing_columns(spark, sf_dir):
    names = ["_gone", "id", "key", "count", "kept", "component", "u", "v", "head", "words", "score", "y", "doc", "tokens", "level0", "cut", "budget", "rest", "full", "epoch", "_mix_h", "shard", "slot", "size", "group", "weight"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    more = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, more = stage(spark, docs, sf_dir), stage(spark, more, sf_dir)
        assert more.columns[-len(names) :] == names
        rows = more.collect()
        assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names)
    last = corpus_pipeline.STAGES[-1][1]
    assert {r.doc_id for r in last(spark, more, sf_dir).collect()} == {r.doc_id for r in docs.collect()}
