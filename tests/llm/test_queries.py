"""Registered queries against SQL or brute force on whole small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import exp, log
from statistics import fmean, pstdev

import pytest

from jobloom.llm import decontam, pii, queries, sharding, toxicity
from tests.oracle import rows_of, sql_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    assert rows_of(queries.QUERIES[name](spark, sf_dir)) == sql_rows(queries.ORACLE_SQL[name], sf_dir)


def near_dup_brute(docs):
    """``{id: (n_shingles, component)}`` by comparing every pair that shares a shingle."""
    sets, holders, up = {}, defaultdict(list), {}
    for i, t in docs:
        sets[i] = decontam.shingles(t)
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_op7_brute(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = near_dup_brute(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op7_minhash_near_dedup"](spark, sf_dir).collect()}
    assert got == want


def brute_spans(text):
    out = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (12 <= len(d) <= 19 and pii.luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_op2_brute(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_skip_chain_pii"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        want = brute_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, _, k in want) for x in pii.KINDS)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_op10_brute(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.QUERIES["op10_lpt_sharding"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    size = lambda t: len((t or "").encode()) + 8
    groups, load, slots, shard_of = Counter(), Counter(), defaultdict(list), defaultdict(set)
    for d in docs:
        r = rows[d.doc_id]
        assert (r.size, r.text_crc32) == (size(d.text), zlib.crc32((d.text or "").encode()))
        groups[d.text] += r.size
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shard_of[d.text].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # which weights each shard holds, against groups handed out one by one
    want, loads = defaultdict(Counter), [0] * 24
    for w in sorted(groups.values(), reverse=True):
        s = min(range(24), key=lambda s: (loads[s], s))
        loads[s] += w
        want[s][w] += 1
    placed = defaultdict(Counter)
    for text, shards in shard_of.items():
        placed[next(iter(shards))][groups[text]] += 1
    assert placed == want and [load[s] for s in range(24)] == loads


def test_op9_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")
    try:
        labels = spark.read.parquet(f"{big}/labels.parquet")
    except Exception:
        pytest.skip("no larger tables")
    got = queries.QUERIES["op9_toxicity"](spark, big).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted == r.toxic for r in got) / len(got)
    clean = [r for r in got if r.toxic == 0]
    assert hit >= 0.95 and sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_op9_swaps_on_the_tables(spark, sf_dir):
    """The labelled texts name people, so the regulariser acts; scores are the sum of the weights of a text's features."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert model.swaps > 0
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in toxicity.score(docs, model).collect():
        words = set(re.findall(r"\w+", texts[r.id].lower()))
        z = model.intercept + sum(w for f, w in model.weights.items() if f in words or f[-1] == "*" and any(len(x) > 6 and x.startswith(f[:-1]) for x in words))
        assert abs(r.score - 1 / (1 + exp(-max(min(z, 700), -745)))) < 1e-9


def test_op8_rules_and_separation(spark, sf_dir):
    rows = queries.QUERIES["op8_url_language_model"](spark, sf_dir).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rules = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
    for r in rows:
        head, mark, rest = urls[r.page_id].partition("://")
        host = re.match(r"[^/?#]*", rest)[0].translate(LOWER) if mark else ""
        path = re.match(r"[^?#]*", rest[len(host) :])[0] if mark else ""
        fits = [(len(k), k, v) for v, k in rules if (host == k.split("/")[0] or host.endswith("." + k.split("/")[0])) and path.startswith("/" + k.split("/", 1)[1])]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else r.verdict) and r.verdict in ("allow", "block")


def brute_model(rows):
    """Model verdicts of ``(url, rule verdict)`` rows with margins: dictionaries instead of windows, one url at a time."""
    def grams(url):
        padded = "\x02\x02\x02" + url + "\x03"
        return [padded[i : i + 4] for i in range(len(url) + 1)]

    seen = {c: Counter() for c in ("allow", "block")}
    for url, verdict in rows:
        for g in grams(url) if verdict else ():
            for k in range(1, 5):
                seen[verdict][(k, g[4 - k :])] += 1
                seen[verdict][("before", k, g[4 - k : 3])] += 1

    def chance(c, g):
        p = 1 / 256
        for k in range(1, 5):
            p = (seen[c][(k, g[4 - k :])] + 4 * p) / (seen[c][("before", k, g[4 - k : 3])] + 4)
        return p

    score = {url: fmean(log(chance("allow", g) / chance("block", g)) for g in grams(url)) for url, _ in rows}
    of = {c: [score[u] for u, v in rows if v == c] for c in seen}
    mean, sd = {c: fmean(x) for c, x in of.items()}, {c: pstdev(x) for c, x in of.items()}
    cut = (mean["allow"] * sd["block"] + mean["block"] * sd["allow"]) / (sd["allow"] + sd["block"])
    return {u: s - cut for u, s in score.items()}


def test_op8_brute(spark, sf_dir):
    urls = {r.page_id: r.url or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.QUERIES["op8_url_language_model"](spark, sf_dir).collect()
    assert len(got) == len(urls)
    margin = brute_model([(urls[r.page_id], r.verdict if r.rule else None) for r in got])
    unruled = [r for r in got if not r.rule and abs(margin[urls[r.page_id]]) > 1e-5]
    assert unruled
    assert all(r.verdict == ("block" if margin[urls[r.page_id]] < 0 else "allow") for r in unruled)


@pytest.mark.parametrize("seed", range(8))
def test_schedule_in_rounds_is_the_schedule_one_by_one(seed):
    r = random.Random(seed)
    sizes = Counter(r.choice([r.randint(1, 9), r.randint(1, 400), r.randint(1, 10**6)]) for _ in range(r.randint(1, 700)))
    if seed % 2:
        sizes[10**7] = 2
        sizes[5] += 900
    shards = r.choice([1, 2, 3, 7, 24])
    loads, want = [0] * shards, defaultdict(lambda: [0] * shards)
    for w in sorted(sizes.elements(), reverse=True):
        s = min(range(shards), key=lambda s: (loads[s], s))
        loads[s] += w
        want[w][s] += 1
    assert list(sharding.longest_first(sorted(sizes.items(), reverse=True), shards)) == sorted(want.items(), reverse=True)
