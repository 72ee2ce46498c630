"""The Jaccard join, spelling variants and source divergence against brute force and on edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import divergence, jaccard, neardup, spelling
from tests.llm.test_edges import EDGE, LONG, docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def join_brute(rows, percent, k=3):
    sets, up = [(i, shingles(t, k)) for i, t in rows], {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            shared = len(s & t)
            if s and t and 100 * shared >= percent * (len(s) + len(t) - shared):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in up}


def _families(seed, n=160):
    """Texts of families whose members differ by a few words, so that links are few and far between or all over."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 4000)}"
    boiler = [word() for _ in range(30)]
    bases = [[word() for _ in range(rnd.choice([2, 3, 11, 40, 90]))] + (boiler if rnd.random() < 0.5 else []) for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, max(1, len(words) // 15))):
            at = rnd.randrange(len(words) + 1)
            words[at : at + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 1)
        rows.append((rnd.randint(0, 10**12), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,percent", [(1, 90), (2, 75), (3, 60)])
@pytest.mark.parametrize("small", [False, True])
def test_join_equals_all_pairs(spark, monkeypatch, seed, percent, small):
    if small:
        # every group is cut into cells and every key of a few rows is hot
        monkeypatch.setattr(jaccard, "CELL_SHINGLES", 150)
        monkeypatch.setattr(jaccard, "STREAMED_SHINGLES", 400)
        monkeypatch.setattr(jaccard, "hot_rows", lambda total: 4)
        monkeypatch.setattr(jaccard, "NEAR_IDS", 0)
    rows = _families(seed)
    got = {r.id: (r.n_shingles, r.component) for r in jaccard.jaccard_join(docs(spark, *[(i, t, "en", "s") for i, t in rows]), percent=percent).collect()}
    want = join_brute(rows, percent)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}
    assert len(set(want.values())) < len(rows) - 20


def test_join_edges(spark):
    got = sorted(((r.id, r.n_shingles, r.component) for r in jaccard.jaccard_join(docs(spark, *EDGE)).collect()), key=repr)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 29_998, 4), (4, 29_998, 4), (None, 4, None), (5, 1, 5), (6, 1, 5)], key=repr)
    assert jaccard.jaccard_join(docs(spark)).count() == 0
    # an id of two texts joins their classes
    two = docs(spark, (7, "a b c d", "en", "s"), (7, "x y z q", "en", "s"), (3, "x y z q", "en", "s"), (9, "a b c d", "en", "s"))
    assert {(r.id, r.component) for r in jaccard.jaccard_join(two).collect()} == {(7, 3), (3, 3), (9, 3)}


def test_texts_that_share_boilerplate_never_meet(spark, monkeypatch):
    met = []
    search = jaccard.search_cells
    monkeypatch.setattr(jaccard, "search_cells", lambda cells, *more: (met.append(cells.count()), search(cells, *more))[1])
    template = " ".join(f"t{i}" for i in range(100))
    rows = [(i, f"{template} " + " ".join(f"own{i}x{j}" for j in range(150)), "en", "s") for i in range(400)]
    assert {r.component for r in jaccard.jaccard_join(docs(spark, *rows)).collect()} == set(range(400))
    assert sum(met) == 0


def test_near_duplicates_under_a_template(spark, monkeypatch):
    """Texts of one template are alike enough to share bands and too different to link: no blocks of them meet."""
    cells, links = [], []
    monkeypatch.setattr(neardup, "BLOCK", 32)
    exact = jaccard.exact_links
    monkeypatch.setattr(neardup, "exact_links", lambda docs, ids, *more: (cells.append(ids.count()), links.append(exact(docs, ids, *more)))[1] or links[-1])
    rnd = random.Random(8)
    template = " ".join(f"t{i}" for i in range(80))
    rows = [(i, f"{template} " + " ".join(f"own{i}x{j}" for j in range(60))) for i in range(1500)]
    rows += [(2000 + i, rows[i * 7][1].replace("x30", "x30new")) for i in range(60)]
    rnd.shuffle(rows)
    out = neardup.near_duplicates(docs(spark, *[(i, t, "en", "s") for i, t in rows]))
    want = {i: i if i < 2000 else (i - 2000) * 7 for i, _ in rows}
    assert {r.id: r.component for r in out.collect()} == want
    assert cells and cells[0] > 1000 and links[0].count() <= 200


@pytest.mark.parametrize("seed", range(6))
def test_search_of_lists(seed):
    rnd = np.random.default_rng(seed)
    sets = [np.unique(rnd.integers(0, 400, rnd.integers(0, 120)).astype(np.uint64)) for _ in range(60)]
    index = jaccard.ListIndex(sets)
    for percent in (30, 75, 95):
        for s in sets:
            if not len(s):
                continue
            need = lambda j: max(1, jaccard.required(len(s), len(sets[j]), percent))  # noqa: B023, E731
            wanted = lambda j: min(len(s), len(sets[j])) * 100 >= percent * max(len(s), len(sets[j]))  # noqa: B023, E731
            got = set(index.search(s, max(1, jaccard.least_required(len(s), percent)), need, wanted))
            assert got == {j for j, t in enumerate(sets) if len(t) and 100 * len(np.intersect1d(s, t)) >= percent * len(np.union1d(s, t))}


def test_prefixes_of_sets_that_link_share_enough():
    rnd = random.Random(3)
    for _ in range(3000):
        n = rnd.randint(1, 60)
        a = set(rnd.sample(range(200), n))
        b = set(a)
        for _ in range(rnd.randint(0, n // 10 + 1)):
            b.discard(rnd.choice(sorted(b or {0})))
            b |= {rnd.randrange(200)} if rnd.random() < 0.6 else set()
        if not b or 100 * len(a & b) < 90 * len(a | b):
            continue
        first = lambda s: set(sorted(s, key=lambda x: (x * 7919) % 211)[: len(s) - jaccard.least_required(len(s), 90) + jaccard.common(len(s))])
        shared = len(first(a) & first(b))
        assert shared >= min(jaccard.common(len(a)), jaccard.common(len(b)))
        assert all(shared >= jaccard.common(jaccard.least_required(len(s), 90)) for s in (a, b))


# --- spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_brute(rows, least=7):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    form, out = {}, {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
        out[w] = [n, len(close), words[best] if form[w] else None]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w])
    return out


def _got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_equals_all_pairs(spark):
    rnd = random.Random(4)
    letters = "abcdeéàÿ×"
    bases = ["".join(rnd.choice(letters) for _ in range(rnd.randint(7, 10))) for _ in range(40)]
    words = []
    for b in bases:
        w, n = b, 2400
        while n >= 2:
            words += [w] * n
            at, n = rnd.randrange(len(w)), n // rnd.choice([10, 12, 3])
            w = rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1 :]])
    rnd.shuffle(words)
    rows = [(rnd.choice([None, i]), " ".join(words[i * 50 : i * 50 + 50]).title()) for i in range(len(words) // 50)]
    want = spelling_brute(rows)
    got = _got(spelling.spelling_groups(docs(spark, *[(i, t, "en", "s") for i, t in rows])))
    assert got == want
    assert sum(1 for v in want.values() if v[0] and v[1] != v[0]) > 3 and any(v[3] > 3 for v in want.values())


def test_spelling_edges(spark, monkeypatch):
    assert spelling.spelling_groups(docs(spark)).count() == 0
    assert _got(spelling.spelling_groups(docs(spark, *EDGE))) == spelling_brute([(i, t) for i, t, *_ in EDGE])
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = [(i, t) for i, t in enumerate(["x" * 5000 + " " + "x" * 4999 + "y"] * 3 + ["Ñandúes_ñandúes-Ñandúes中ñandúesĀñandúes"] * 4 + ["", None])]
    want = spelling_brute(rows)
    assert _got(spelling.spelling_groups(docs(spark, *[(i, t, "en", "s") for i, t in rows]))) == want and len(want) == 4


def test_near_pairs_are_made_once(spark):
    words = ["aaaaaaa", "aaaaaab", "aaaaaabb", "baaaaaa", "aaaabaaa", "ÿaaaaaa", "abababa", "bababab"]
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = [frozenset((r.a, r.b)) for r in spelling.near_pairs(df).collect()]
    assert sorted(map(sorted, got)) == sorted(sorted((a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b))


# --- divergence


def divergence_brute(rows, top):
    rows = [((x or ""), (y or ""), t or "") for x, y, t in rows]
    term_docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        term_docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {x for x, _ in counts}:
        kept = {t for t, n in term_docs[lang].items() if n >= 3}
        groups = {s: {t: counts[lang, s][t] for t in kept} for x, s in counts if x == lang}
        whole = {t: sum(g[t] for g in groups.values()) for t in kept}
        p = lambda g: {t: 1 + 10**9 * (c + 1) // (sum(g.values()) + len(kept)) for t, c in g.items()}  # noqa: B023, E731
        f = lambda x, y: (x - y) * (x - y) // y
        ps, q = {s: p(g) for s, g in groups.items()}, p(whole)
        for s in groups:
            pairs = [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(ps[s][t], q[t])) for t in kept if groups[s][t] and ps[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode())), 1) if r <= most]
    return sorted(out)


@pytest.mark.parametrize("blocks,tiles,held", [(1 << 14, 1 << 18, 300_000), (7, 9, 20), (3, 1, 5)])
def test_divergence_equals_brute_force(spark, monkeypatch, blocks, tiles, held):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", blocks)
    monkeypatch.setattr(divergence, "TILE_ENTRIES", tiles)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rnd = random.Random(6)
    vocabulary = [f"{a}{b}" for a in "abé中" for b in "xyZ"] + ["Ab", "don't", "a1b"]
    text = lambda bias: " ".join(rnd.choice(vocabulary if rnd.random() < 0.7 else vocabulary[bias : bias + 3]) for _ in range(rnd.randint(0, 25)))
    rows = [(rnd.choice(["en", "de", None]), f"s{s}" if s else None, text(s)) for s in [0, 0, 0, 1, 2, 3, 4, 5, 6] for _ in range(9)]
    rows += [("xx", "a", "rare words here"), ("xx", "b", None), ("xx", "c", ""), ("yy", "only", "a a a"), ("yy", "only", "a"), ("yy", "only", "a b")]
    got = sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in divergence.source_divergence(docs(spark, *[(i, t, x, s) for i, (x, s, t) in enumerate(rows)]), top=4).collect())
    assert got == divergence_brute(rows, 4)


def test_divergence_edges(spark):
    assert divergence.source_divergence(docs(spark)).count() == 0
    got = sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in divergence.source_divergence(docs(spark, *EDGE, (9, LONG, "en", "src9"))).collect())
    assert got == divergence_brute([(x, s, t) for _, t, x, s in [*EDGE, (9, LONG, "en", "src9")]], 200)


@pytest.mark.parametrize("tiles", [1, 2, 5, 8])
def test_each_two_tiles_meet_once_and_one_at_a_time(spark, tiles):
    vectors = spark.range(tiles).select(F.col("id").cast("int").alias("tile"), F.lit(tiles).alias("tiles"))
    rows = divergence.rotation(vectors).where("round >= 0").collect()
    meetings = [(frozenset((r.tile, r.home)), r["round"]) for r in rows]
    assert sorted(sorted(m) for m, _ in meetings) == [[i, j] for i in range(tiles) for j in range(i + 1, tiles)]
    busy = Counter((t, r) for m, r in meetings for t in m)
    assert not busy or max(busy.values()) == 1 and len({r for _, r in meetings}) == (tiles - 1 if tiles % 2 == 0 else tiles)


def test_probabilities_are_exact_for_huge_counts():
    counts, whole = np.array([0, 5, 10**9, 8 * 10**13], np.int64), 9 * 10**13
    assert divergence.probability(counts, whole).tolist() == [1 + 10**9 * (int(c) + 1) // whole for c in counts]
