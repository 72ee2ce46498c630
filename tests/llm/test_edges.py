"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for each operator."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import chat, components, decontam, mixing, neardup, pii, quality, sharding, toxicity, urlfilter, warc
from tests.llm.test_queries import near_dup_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, shard int, score double, key string, label string, u long, v long"
LONG = " ".join(f"word{i}" for i in range(30_000))


def docs(spark, *rows):
    """Rows of ``documents`` with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, src, 0, -1, 9, 0.5, "k", "l", 1, 2) for i, t, lang, src in rows], SCHEMA)


EDGE = [(1, None, "en", "src1"), (2, "", None, "src1"), (3, " \t\n", "en", None), (4, LONG, "en", "src2"), (4, LONG, "en", "src2"), (None, "a b c d e f", "en", "src2"), (5, "one two", "en", "src3"), (6, "One\tTWO", "en", "src3")]


@pytest.fixture(scope="module")
def edge(spark):
    return docs(spark, *EDGE)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark)


# --- 1 chat


def turns(spark, *rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, chunk long, done boolean")


def test_chat_round_trip(spark):
    t = chat.Template()
    hard = ["<|start|>", "<\\|start|>", "<\\\\|end|>", "</s>[INST] ok [/INST]", "é🚀\n<|", "[[INST]", "", None, "<|message|>x<|end|>"]
    rows = [(1, i, "user" if i % 2 else "assistant", x, 0, True) for i, x in enumerate(hard)] + [(None, None, None, "n", 0, True), (2, 0, "assistant", "a", 0, True), (2, 0, "assistant", "a", 0, True)]
    out = {r.conv_id: r for r in chat.format_conversations(turns(spark, *rows), t).collect()}
    assert [x for _, x, _ in t.turns(out[1].formatted)] == [x or "" for x in hard]
    r = out[1]
    assert r.formatted_chars == len(r.formatted) and r.n_turns == len(hard)
    assert [t.unescape(r.formatted[s.start : s.end]) for s in r.loss_spans] == [x or "" for x in hard[::2]]
    assert out[2].n_turns == 2 and out[None].n_turns == 1
    assert chat.format_conversations(turns(spark)).count() == 0


def test_chat_long_conversation_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 5_000)
    rows = [(7, i, "assistant", f"{i} " + "x" * 400, 0, True) for i in range(60)] + [(8, 0, "user", "y", 0, True)]
    formatted = chat.format_conversations(turns(spark, *rows))
    assert {r.conv_id: r.n_turns for r in chat.read_back(formatted).collect()} == {7: 60, 8: 1}
    parts = formatted.where("conv_id = 7").orderBy("chunk").collect()
    assert [p.chunk for p in parts] == list(range(len(parts))) and [p.done for p in parts] == [False] * (len(parts) - 1) + [True]


# --- 2 pii


def test_pii_edges(spark, edge, none):
    got = pii.find_pii(edge).collect()
    assert len(got) == len(EDGE) and all(r.spans == [] for r in got)
    assert pii.find_pii(none).count() == 0


def test_pii_label_spreads_over_distance():
    model = pii.train()
    far = " filler" * 200
    text = f"call +1 (743) 555-3824 now{far} ask 743-555-3824 please"
    (spans,) = pii.added_spans([text], model)
    assert any(text[a:b] == "743-555-3824" and k == "phone" for a, b, k in spans)
    (alone,) = pii.added_spans(["order 48213 of 2024-05-01 costs $310, 20% off"], model)
    assert alone == []


def test_pii_evidence_reaches_every_repeat():
    model = pii.train()
    text = "call +1 (398) 259-7919 now" + " filler card 398-259-7919x please" * 50
    alone, beside = pii.added_spans([text], model), pii.added_spans(["1 2 3 4 joe.b12@site 5", text, "10.2.3.4:80"], model)
    assert sum(text[a:b] == "398-259-7919x" and k == "phone" for a, b, k in alone[0]) == 50
    assert beside[1] == alone[0]


def test_pii_hub_keeps_the_potential_of_a_pair():
    skip = pii.train()[3]
    root = np.exp(pii.pair_root(skip))
    assert np.allclose(root @ root.T, np.exp(skip)) and root.min() > 1e-9


@pytest.mark.parametrize("text", ["1" * 30_000, "a" * 30_000 + "@", "@" * 30_000, "+1" * 15_000, "1." * 15_000])
def test_pii_is_linear(text):
    pii.base_spans(text)


def exact_marginals(graph, weights, chain_w, skip_w):
    """Marginals of the tokens by summing over every assignment of tokens and hubs."""
    labels, n = weights.shape[1], graph.n + graph.hubs
    states = np.stack(np.meshgrid(*[np.arange(labels)] * n, indexing="ij"), axis=-1).reshape(-1, n)
    unary = graph.node_scores(weights)
    score = sum(unary[i, states[:, i]] for i in range(graph.n))
    for edges, w in ((graph.chain, chain_w), (graph.star, pii.pair_root(skip_w))):
        for a, b in edges:
            score = score + w[states[:, a], states[:, b]]
    p = np.exp(score - score.max())
    out = np.stack([np.bincount(states[:, i], p, labels) for i in range(graph.n)])
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize(
    "text,loops",
    [
        ("call 7012 now", False),
        ("call +1 (743) 555-3824 now", False),
        ("card 398-259-7919x is not 398-259-7919x", False),
        ("mail joe.b12@site and joe.b12@site.com or joe.b12@site", False),
        ("10.2.3.4 7 10.2.3.4", True),
        ("398-259-7919 55 398-259-7919 55.10", True),
    ],
)
def test_pii_messages_against_exhaustive_sums(text, loops):
    names, *weights = pii.train()
    graph = pii.Graph([pii.candidates(text)], names)
    assert 1 <= graph.n + graph.hubs <= 7
    got, want = graph.marginals(*weights), exact_marginals(graph, *weights)
    assert np.abs(got - want).max() < (0.1 if loops else 2e-3)
    assert not loops or (got.argmax(axis=1) == want.argmax(axis=1)).all()


def test_pii_spans_in_a_long_text():
    text = "mail a1@b.co at 10.0.0.1, card 4111 1111 1111 1111 " * 3000
    base = pii.base_spans(text)
    assert pii.uncovered(base, base) == [] and len(base) == 9000
    assert pii.uncovered([(0, 4, "email"), (4, 6, "ip"), (12, 13, "ip")], [(5, 12, "email")]) == [(0, 4, "email"), (12, 13, "ip")]


def test_pii_added_spans_on_unseen_texts():
    got = pii.held_out(seed=1234, sentences=800)
    assert got["cut"] > 200 and got["recall"] >= 0.85 and got["precision"] >= 0.95


# --- 3 mixing


def tree():
    return {"domain": F.lit("d"), "lang": F.col("lang"), "source": F.col("source")}


def test_mixing_edges(spark, edge, none):
    got = mixing.mix(edge, tree(), {}, share=1.0, max_epochs=1)
    assert set(EDGE[i][0] for i in (3, 4, 5, 6, 7)) <= {r.doc_id for r in got.collect()}
    assert set(edge.columns) <= set(got.columns)
    assert mixing.mix(none, tree(), {}).count() == 0


def test_mixing_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, "en", "a") for i in range(10)] + [(100 + i, "w " * 10, "en", "b") for i in range(100)] + [(300 + i, "w " * 10, "fr", "c") for i in range(100)]
    got = mixing.mix(docs(spark, *rows), tree(), {}, share=0.4, max_epochs=1)
    tokens = {r.source: r.n for r in got.groupBy("source").agg(F.sum("_mix_tokens").alias("n")).collect()}
    # 840 of 2100 tokens: 420 a language; source a has only 100, its shortage stays with b
    assert tokens == {"a": 100, "b": 320, "c": 420}


def test_mixing_epochs_and_weights(spark):
    rows = [(i, "w " * 10, "en", "a") for i in range(10)] + [(100 + i, "w " * 10, "en", "b") for i in range(90)]
    got = mixing.mix(docs(spark, *rows), tree(), {("d", "en", "a"): 3, ("d", "en", "b"): 1}, share=0.3, max_epochs=3)
    n = {(r.source, r._mix_epoch): r.c for r in got.groupBy("source", "_mix_epoch").agg(F.count("*").alias("c")).collect()}
    assert n == {("a", 1): 10, ("a", 2): 10, ("a", 3): 2, ("b", 1): 7}


CLASHES = ["tokens", "id", "doc", "h", "from", "part", "before", "upto", "fits", "cut", "copies", "full", "budget", "rest", "epoch", "epochs", "turn", "level0", "level1", "_mix_budget", "_mix_h", "x", "n"]


def test_mixing_carries_columns_of_any_name(spark):
    base = docs(spark, *[(i, "w " * (1 + i % 7), "en", f"s{i % 3}") for i in range(200)]).select("doc_id", "text", "lang", "source")
    more = base.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in CLASHES])
    plain, got = (mixing.mix(df, tree(), {("d", "en", "s1"): 3}, share=1.3) for df in (base, more))
    key = lambda r: (r.doc_id, r._mix_epoch, r._mix_tokens, r._mix_source)
    assert sorted(map(key, got.collect())) == sorted(map(key, plain.collect()))
    assert set(got.columns) == {*plain.columns, *CLASHES}
    assert all(r[c] == f"{c}-{r.doc_id}" for r in got.collect() for c in CLASHES if c != "_mix_budget")


def mix_brute(rows, weights, share, epochs, seed=7):
    """``(id, epoch)`` of rows ``(id, path, tokens)``: budgets by filling the smallest child first, prefixes by a sorted list."""
    import hashlib

    budget = {(): float(int(sum(t for *_, t in rows) * share))}
    for depth in range(1, 1 + len(rows[0][1])):
        cap = {}
        for _, path, t in rows:
            cap[path[:depth]] = cap.get(path[:depth], 0) + t * epochs
        for parent in {p[:-1] for p in cap}:
            open_, left = {p for p in cap if p[:-1] == parent}, budget[parent]
            w = {p: weights.get(p, 1) for p in open_}
            while open_:
                level = left / (sum(w[p] for p in open_) or float("inf"))
                full = {p for p in open_ if w[p] and cap[p] <= level * w[p] + 1e-9}
                if not full:
                    budget |= {p: level * w[p] for p in open_}
                    break
                budget |= {p: float(cap[p]) for p in full}
                left -= sum(cap[p] for p in full)
                open_ -= full
    out = []
    for path in {p for _, p, _ in rows}:
        own, take = [(i, t) for i, p, t in rows if p == path], int(budget[path] + 1e-6)
        total = sum(t for _, t in own)
        for e in range(1, epochs + 1):
            if take >= total:
                out += [(i, e) for i, _ in own if total]
                take -= total
                continue
            for _, i, t in sorted((hashlib.md5(f"{seed}|{e}|{i}".encode()).hexdigest(), str(i), t) for i, t in own) if take else ():
                if t > take:
                    break
                out.append((int(i), e))
                take -= t
            break
    return sorted(out)


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.8, 2), (1.7, 3)])
def test_mixing_against_brute_force(spark, share, epochs):
    rows = [(i // 2 if i % 9 == 0 else i + 1000, ("d", ["en", "fr"][i % 5 == 0], f"s{i % 7}"), (i * 7919) % 40) for i in range(900)]
    weights = {("d", "en"): 3, ("d", "fr"): 2, ("d", "en", "s2"): 5, ("d", "en", "s3"): 0}
    got = mixing.mix(docs(spark, *[(i, "w " * t, p[1], p[2]) for i, p, t in rows]), tree(), weights, share, epochs).collect()
    assert sorted((r.doc_id, r._mix_epoch) for r in got) == mix_brute(rows, weights, share, epochs)


def test_mixing_splits_equal_rows(spark):
    rows = [(7, "w w w", "en", "a")] * 9 + [(8, "w w w", "en", "a")]
    got = mixing.mix(docs(spark, *rows), tree(), {}, share=0.5, max_epochs=1).collect()
    assert sum(r._mix_tokens for r in got) == 15


# --- 4 quality


def test_quality_edges(spark, edge, none):
    got = {(r.id, r.n_words): r for r in quality.apply_quality(edge).collect()}
    assert got[(1, 0)].base_failed and not got[(1, 0)].kept and got[(4, 30_000)].n_repeat_words == 0
    assert quality.apply_quality(none).count() == 0


def test_quality_counts(spark):
    eight = "a b c d e f g h"
    rows = [(1, f"{eight} {eight}", "en", "s"), (2, " ".join("x" * 12), "en", "s"), (3, "l # one\n\n \nl # one\nl", "en", "s"), (4, f"{eight} i {eight} j {eight}", "en", "s")]
    got = {r.id: r for r in quality.rule_counts(docs(spark, *rows)).collect()}
    assert [got[i].n_repeat_words for i in (1, 2, 4)] == [16, 12, 24]
    assert (got[3].n_dup_lines, got[3].n_lines, got[3].n_symbols, got[3].word_chars) == (1, 3, 2, 11)


def test_quality_bad_host_is_dropped_and_small_hosts_are_shrunk(spark):
    good, bad = " ".join(f"w{i}" for i in range(40)), "no"
    rows = [(i, good, "en", f"h{i % 30}") for i in range(900)] + [(1000 + i, bad if i < 95 else good, "en", "farm") for i in range(100)] + [(2000, bad, "en", "tiny")]
    got = {r.id: r for r in quality.apply_quality(docs(spark, *rows)).collect()}
    assert got[0].kept and not got[1099].kept and not got[1099].base_failed
    assert got[2000].host_rate < 1


# --- 5 warc


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h, "x", 0) for i, u, h in rows], "page_id long, url string, html string, digest string, shard int")


def test_warc_edges_and_determinism(spark, tmp_path):
    same = "<p>é" * 400
    rows = [(1, "http://a/x y\r\nz", same), (2, None, same), (3, "http://b", same), (4, "http://b", None), (5, "http://b", "short"), (6, "http://b", "short"), (None, "http://c", same), (7, "http://c", "\r\n\r\n" * 500), (7, "http://c", "\r\n\r\n" * 500)]
    folders = [str(tmp_path / x) for x in ("a", "b")]
    files = [{(r.name, r.sha256) for r in warc.write_warc(pages(spark, *order).repartition(n), f, shard_bytes=2000, roll_bytes=1500).collect()} for f, order, n in zip(folders, (rows, rows[::-1]), (1, 5))]
    assert files[0] == files[1] and len(files[0]) > 2
    got = sorted(((r.id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_warc(spark, folders[0]).collect())
    n = len(same.encode())
    assert got == [(0, "revisit", 3, n), (1, "revisit", 3, n), (2, "revisit", 3, n), (3, "response", None, n), (4, "response", None, 0), (5, "response", None, 5), (6, "response", None, 5), (7, "response", None, 2000), (7, "response", None, 2000)]
    empty = str(tmp_path / "empty")
    assert warc.write_warc(pages(spark), empty).count() == 0 and warc.read_warc(spark, empty).count() == 0


def test_warc_deals_equal_rows_over_several_files(spark, tmp_path):
    rows = [(None, None, "n" * 40)] * 90 + [(5, "http://a", "p" * 1500)] * 30 + [(9, "http://b", "p" * 1500), (7, "http://0", "q")]
    folders = [str(tmp_path / x) for x in "ab"]
    files = [{(r.name, r.sha256, r.records) for r in warc.write_warc(pages(spark, *rows).repartition(n), f, shard_bytes=6000, roll_bytes=1 << 20).collect()} for f, n in zip(folders, (1, 7))]
    assert files[0] == files[1] and max(n for *_, n in files[0]) < 20
    got = [(r.id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_warc(spark, folders[0]).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, [(None, "response", None, 40)] * 90 + [(5, "revisit", 9, 1500)] * 30 + [(9, "response", None, 1500), (7, "response", None, 1)]))


def test_warc_ignores_what_the_manifest_does_not_list(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write_warc(pages(spark, (1, "http://a", "x")), folder)
    (tmp_path / "w" / "part-09999-00000.warc.gz").write_bytes(b"torn")
    assert warc.read_warc(spark, folder).count() == 1


# --- 6 decontamination


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_decontamination_edges(spark, edge, none):
    test = items(spark, (1, "word7 word8 word9 WORD10 word11 word12"), (2, None), (3, ""), (4, "one two"), (5, "not in any of them at all"))
    got = {(r.doc, r.item) for r in decontam.contamination(edge, test).collect()}
    assert got == {(4, 1), (5, 4), (6, 4)}
    left = decontam.decontaminate(edge, test)
    assert left.columns == edge.columns and sorted((r.doc_id for r in left.collect()), key=str) == [1, 2, 3, None]
    assert decontam.contamination(none, test).count() == 0
    assert decontam.contamination(edge, items(spark)).count() == 0


def test_decontamination_threshold_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", 60)
    words = [f"q{i}" for i in range(104)]
    cut = lambda n: " ".join(words[: n + 4]) + " other words follow here " + LONG
    test = items(spark, (1, " ".join(words)), (2, "x y z " * 30), (3, " ".join(words[:12])))
    got = {(r.doc, r.item, r.n_shared) for r in decontam.contamination(docs(spark, (1, cut(75), "en", "s"), (2, cut(74), "en", "s")), test).collect()}
    assert got == {(1, 1, 75), (1, 3, 8), (2, 3, 8)}


@pytest.mark.parametrize("size", [1, 2, 60, 64, 65, 130, 900, 4000])
def test_size_classes_find_contained_items(size):
    k, rng = decontam.class_of(size), np.random.default_rng(size)
    assert 1 << (k - 1) <= size < 1 << k
    rate = (decontam.class_limit(k) + 1) / 2**64
    assert rate == 1 if size <= 64 else decontam.KEPT <= rate * size < 4 * decontam.KEPT
    item = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
    sizes = decontam.SizeClass(k, [5], [item], 75)
    for share, hit in ((1.0, True), (0.76, True), (0.2, size < 2)):
        held = item[: math.ceil(share * size)]
        others = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
        document = np.concatenate([held, others])
        got = set(sizes.candidates(document, decontam.sampling_hash(document), np.zeros(len(document), np.int64), np.array([len(document)])))
        assert got == ({(0, 5)} if hit else set())


def test_hits_needed_is_safe():
    for kept in (20, 40, 64):
        need = decontam.hits_needed(kept, 1000, 75)
        miss = sum(math.comb(kept, r) * 0.75**r * 0.25 ** (kept - r) for r in range(need))
        assert miss <= 1e-9 or need == 1
    assert decontam.hits_needed(10, 10, 75) == 8


# --- 7 near duplicates


def test_near_duplicates_edges(spark, edge, none):
    got = sorted(((r.id or 0), r.n_shingles, r.component, r.kept) for r in neardup.near_duplicates(edge).collect())
    assert got == [(0, 2, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 29_996, 4, True), (4, 29_996, 4, True), (5, 1, 5, True), (6, 1, 5, False)]
    assert neardup.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_drifting_chain_and_a_large_group(spark):
    import random

    r = random.Random(4)
    rows, text = [], [f"w{r.randint(0, 10**6)}" for _ in range(120)]
    for i in range(80):
        text[r.randint(0, 119)] = f"n{i}"
        rows.append((i * 3 + 1, " ".join(text)))
    base = [f"b{r.randint(0, 10**6)}" for _ in range(100)]
    for i in range(400):
        t = list(base)
        for _ in range(r.randint(0, 12)):
            t[r.randint(0, 99)] = f"m{r.randint(0, 10**6)}"
        rows.append((1000 + i, " ".join(t)))
    got = {x.id: (x.n_shingles, x.component) for x in neardup.near_duplicates(docs(spark, *[(i, t, "en", "s") for i, t in rows])).collect()}
    assert got == near_dup_brute(rows)


def test_sketch_fills_and_estimates():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 60, 5000):
        s = rng.integers(0, 2**63, n, dtype=np.uint64)
        assert (neardup.sketch(s) != np.iinfo(np.uint64).max).all()
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 2**63, 200, dtype=np.uint64)])
    agreed = [(neardup.sketch(neardup.mix(a + np.uint64(k))) == neardup.sketch(neardup.mix(b + np.uint64(k)))).mean() for k in range(40)]
    assert abs(np.mean(agreed) - 800 / 1200) < 0.03


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 9), (5, 5), (None, 4), (7, 3)], "u long, v long")
    assert {(r.node, r.component) for r in components.connected_components(e).collect()} == {(1, 1), (2, 1), (3, 1), (7, 1), (8, 8), (9, 8)}
    chain = spark.range(60).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    assert components.connected_components(chain).where("component <> 0").count() == 0


# --- 8 url filters


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "x://HOST.Com/en/1?a#b"), (3, "x://HOST.Com/en/1?a#b"), (4, "http://example.com/en/77"), (5, "http://a.example.net/de/8"), (6, "http://mycom/en/")]
    df = spark.createDataFrame([(i, u, "h", "p", 1.0) for i, u in rows], "page_id long, url string, host string, path string, score double")
    got = sorted((r.page_id, r._host, r._path, r._rule or "") for r in urlfilter.judge(df).collect())
    assert got == [(1, "", "", ""), (2, "", "", ""), (3, "host.com", "/en/1", "com/en/"), (3, "host.com", "/en/1", "com/en/"), (4, "example.com", "/en/77", "example.com/en/7"), (5, "a.example.net", "/de/8", "example.net/de/8"), (6, "mycom", "/en/", "")]
    assert urlfilter.judge(df.limit(0)).count() == 0


def test_url_judge_carries_columns_of_any_name(spark):
    names = ["_score", "_by_model", "_by_rule", "_url", "_host", "_verdict", "page", "host", "path", "rule", "by_rule", "score", "allow", "block", "gram", "n", "s"]
    base = spark.createDataFrame([(i, f"https://a{i % 9}.{['com/en', 'net/de', 'org/fr'][i % 3]}/x{i}") for i in range(60)], "page_id long, url string")
    more = base.select("*", *[F.concat(F.lit(f"{c}-"), F.col("page_id")).alias(c) for c in names])
    plain, got = ({r.page_id: r for r in urlfilter.judge(df).collect()} for df in (base, more))
    out = ("_host", "_path", "_rule", "_score", "_verdict")
    assert len(got) == 60 and all(got[i][c] == plain[i][c] for i in plain for c in out)
    assert all(r[c] == f"{c}-{i}" for i, r in got.items() for c in names if c not in out)


def test_url_model_separates(spark):
    good = [f"https://docs.site{i}.net/de/guide/page-{i}" for i in range(60)]
    bad = [f"https://win{i}.casino{i}.com/en/bonus?id={i}" for i in range(60)]
    asked = [(900, "https://docs.siteab.info/guide/page-x"), (901, "https://winab.casinoxy.info/bonus?id=q")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad)] + asked, "page_id long, url string")
    got = {r.page_id: r._verdict for r in urlfilter.judge(df).where("_rule IS NULL").collect()}
    assert got == {900: "allow", 901: "block"}


def test_url_hot_keys_change_nothing(spark, monkeypatch):
    urls = [f"https://a{i % 9}.{['com/en', 'net/de', 'org/fr', 'info/x'][i % 4]}/x{i}" for i in range(60)] + ["https://hot.info/1"] * 40 + [None] * 40
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    plain = sorted(map(tuple, urlfilter.judge(df).collect()), key=repr)
    monkeypatch.setattr(urlfilter, "MOST_BROADCAST", 0)
    monkeypatch.setattr(urlfilter, "hot_rows", lambda total: 5)
    assert sorted(map(tuple, urlfilter.judge(df).collect()), key=repr) == plain and len(plain) == len(urls)


# --- 9 toxicity


def test_toxicity_edges(spark, edge, none):
    labels = spark.createDataFrame([(1, 1, 5), (1, 0, 5), (None, 1, 5), (4, None, 5), (77, 1, 5)], "doc_id long, toxic int, score int")
    model = toxicity.train(edge, labels)
    assert all(0 <= r.score <= 1 for r in toxicity.score(edge, model).collect()) and toxicity.score(edge, model).count() == len(EDGE)
    assert toxicity.drop_toxic(edge, model).columns == edge.columns
    assert toxicity.score(none, model).count() == 0


def test_swaps_take_the_label_off_a_group():
    toxic = [(1, ["muslims", "scum"], 40), (1, ["scum"], 20), (1, ["muslims"], 12)]
    clean = [(0, [], 300), (0, ["christians"], 20), (0, ["muslims"], 1)]
    vocab, groups = ["christians", "muslims", "scum"], {"muslims": ("muslims", "christians"), "christians": ("muslims", "christians")}
    plain = toxicity._fit(toxic + clean, vocab, groups, 0.05, 0.0)
    paired = toxicity._fit(toxic + clean, vocab, groups, 0.05, 20.0)
    s = lambda m, t: float(m.score([t])[0])
    assert s(paired, "muslims meet here") < s(plain, "muslims meet here")
    assert abs(paired.weights.get("muslims", 0) - paired.weights.get("christians", 0)) < 0.3 * abs(plain.weights["muslims"] - plain.weights["christians"])
    assert s(paired, "you scum") > 0.5


def test_swaps_take_the_label_off_long_terms_and_their_stems(spark):
    toxic = ["lesbian scum here"] * 40 + ["scum here"] * 20 + ["lesbian people here"] * 30
    clean = ["people meet here"] * 300 + ["gay people here"] * 120
    rows = [(i, t, "en", "s") for i, t in enumerate(toxic + clean)]
    labels = spark.createDataFrame([(i, int(i < len(toxic))) for i in range(len(rows))], "doc_id long, toxic int")
    model = toxicity.train(docs(spark, *rows), labels, swap_weight=20.0, fold=lambda c: F.lit(True))
    assert "lesbia*" in model.weights
    logit = lambda m, t: m.intercept + sum(m.weights.get(x, 0) for x in toxicity.features(t))
    assert abs(logit(model, "lesbian people here") - logit(model, "gay people here")) < 0.3
    assert model.score(["lesbian people here"])[0] < 0.5 < model.score(["you scum here"])[0]


def test_swaps_keep_a_stem_that_another_word_has():
    assert toxicity.staying("christian christmas lesbian muslims muslim", {"christian", "lesbian", "muslims", "muslim"}) == {"christian"}
    sample = lambda *held: [(1, ["christ*", "christian"], 40, *held), (0, ["muslim"], 40, *([[]] if held else []))]
    groups = {t: ("muslim", "christian") for t in ("muslim", "christian")}
    kept, gone = (toxicity._fit(sample(h), ["christ*", "christian", "muslim"], groups, 0.05, 20.0) for h in (["christian"], []))
    assert kept.weights["christ*"] > gone.weights["christ*"]


def test_a_term_of_several_kinds_swaps_within_each():
    table = toxicity.swap_table((("a", "b"), ("b", "c")))
    assert table == {"a": ("b",), "b": ("a", "c"), "c": ("b",)}


def test_fit_is_the_minimum_of_the_loss_written_out():
    """The loss by dictionaries, with each swapped text scored from its words; its slope at the fitted weights is nought."""
    texts = [(1, "muslims are scum", 7), (1, "scum", 9), (1, "lesbian people lie", 5), (0, "people meet", 30), (0, "gay people meet", 11), (0, "christians and muslims meet", 6), (0, "scum on the pond", 2)]
    groups = toxicity.swap_table()
    words = lambda t: toxicity.features(t)
    vocab = sorted({f for _, t, _ in texts for f in words(t)} | groups.keys() | {"christ*"})
    sample = [(y, sorted(words(t)), n, sorted(toxicity.staying(t, groups.keys()))) for y, t, n in texts]
    model = toxicity._fit(sample, vocab, groups, 0.05, 3.0, rounds=6000)

    def loss(weights, intercept):
        logit = lambda t: intercept + sum(weights.get(f, 0.0) for f in words(t) if f in vocab)
        total = sum(0.05 / 2 * w * w for w in weights.values())
        for y, t, n in texts:
            total += n * math.log1p(math.exp(-logit(t) if y else logit(t)))
            for a in t.split():
                for b in groups.get(a, ()):
                    if b not in t.split():
                        total += n * 3.0 * (logit(t) - logit(" ".join(b if w == a else w for w in t.split()))) ** 2
        return total

    assert model.swaps == sum(n * sum(b not in t.split() for a in t.split() for b in groups.get(a, ())) for _, t, n in texts) > 0
    step = 1e-4
    for f in vocab:
        up, down = ({**model.weights, f: model.weights.get(f, 0.0) + d} for d in (step, -step))
        assert abs(loss(up, model.intercept) - loss(down, model.intercept)) / (2 * step) < 0.02, f
    assert abs(loss(model.weights, model.intercept + step) - loss(model.weights, model.intercept - step)) / (2 * step) < 0.02


# --- 10 sharding


def test_sharding_edges(spark, edge, none):
    got = sharding.assign_shards(edge, shards=3).collect()
    assert len(got) == len(EDGE)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted(r.size for r in got if r.id in (1, 2)) == [8, 8]
    assert sharding.assign_shards(none).count() == 0


def test_sharding_hot_group_stays_together_and_the_rest_balances(spark):
    rows = [(i, "hot text", "en", "s") for i in range(3000)] + [(5000 + i, f"text {i} " + "x" * (i % 90), "en", "s") for i in range(3000)]
    got = sharding.assign_shards(docs(spark, *rows), shards=4).collect()
    hot = {r.shard for r in got if r.id < 5000}
    assert len(hot) == 1
    load = {}
    for r in got:
        if r.shard not in hot:
            load[r.shard] = load.get(r.shard, 0) + r.size
    assert max(load.values()) - min(load.values()) <= 0.1 * max(load.values())


def test_sharding_ranks_in_cells(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELLS", 3)
    rows = [(i, "hot text", "en", "s") for i in range(2000)] + [(5000 + i, f"text {i:05}", "en", "s") for i in range(4000)]
    got = sharding.assign_shards(docs(spark, *rows), shards=4).collect()
    hot = {r.shard for r in got if r.id < 5000}
    assert len(hot) == 1 and len(got) == len(rows)
    slots, load = {}, {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    rest = [n for s, n in load.items() if s not in hot]
    assert max(rest) - min(rest) <= 18


def test_sharding_of_equal_rows_and_a_schedule_in_chunks(spark, monkeypatch):
    rows = [(7, "same", "en", "s")] * 2500 + [(i, "x" * (i % 40), "en", "s") for i in range(300)]
    want = sorted((r.id, r.size, r.shard) for r in sharding.assign_shards(docs(spark, *rows), shards=3).collect())
    monkeypatch.setattr(sharding, "CHUNK", 4)
    monkeypatch.setattr(sharding, "CELLS", 30)
    got = sharding.assign_shards(docs(spark, *rows), shards=3).collect()
    assert sorted((r.id, r.size, r.shard) for r in got) == want
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
