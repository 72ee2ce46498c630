"""Divergence between the sources of each language, and the terms that set a source apart, by systolic rotation.

A group is a language and a source; its vector has the counts of the terms that its language keeps. A language's terms are dealt by
hash into blocks of about ``BLOCK_TERMS`` and its groups into tiles whose vectors of one block have about ``TILE_ENTRIES`` entries.
A (language, block, tile) is a resident: a task holds its vectors, compressed, and the vectors of the other tiles come past it in
the rounds of a round-robin tournament (circle method): tiles i and j meet once, at one of the two, in round (i + j) / 2 modulo the
number of tiles less one, so in a round every tile has one meeting and all tiles one another's after the last. A visiting vector is
spread out once and meets each resident in both directions. Rounds order the rows of one shuffle rather than being a job each, so a
lost executor repeats its residents' rounds from the shuffled vectors alone. Partial sums of blocks are added after. The terms
of a group are ranked by a heap in the task that packs its vector of a block, and at most ``top`` a block go on.

All arithmetic is exact in 64-bit integers up to 9e13 occurrences a language. Terms are counted in tasks before they are shuffled, a hot
source has one row a term then; no task holds more than a tile, a spread vector and one packed vector; nothing goes to the driver.

Defined cases: null text, language or source count as the empty string; a document is a row, so repeated rows count as often as they
stand there; groups without a kept term have the probabilities of no occurrences, and a language without kept terms has divergences of
0 and no terms; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

SCALE = 1_000_000_000
BLOCK_TERMS, TILE_ENTRIES = 1 << 14, 1 << 18
#: Terms held in a task before their counts are passed on.
HELD_TERMS = 300_000
#: ASCII letters in lower case and every byte of other characters; the remaining ASCII parts terms.
_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

COUNTS = "lang string, source string, term string, n long, df long"
PACKED = "lang string, block int, source string, total long, kept long, in_block long, lang_total long, vector binary, term string, value long"
PAIRS = "lang string, a string, b string, there long, back long"


def _count(batches):
    groups: dict = {}
    held = 0
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def flush():
        parts = []
        for (lang, source), (n, df) in groups.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            numbers = pa.array(list(n.values()), pa.int64()), pa.array(list(map(df.__getitem__, n)), pa.int64())
            parts.append(pa.RecordBatch.from_arrays([pa.repeat(lang, len(n)), pa.repeat(source, len(n)), terms, *numbers], names))
        marks = list(groups)
        none = pa.nulls(len(marks), pa.string()), *[pa.array([0] * len(marks), pa.int64())] * 2
        parts.append(pa.RecordBatch.from_arrays([pa.array([g[0] for g in marks], pa.string()), pa.array([g[1] for g in marks], pa.string()), *none], names))
        groups.clear()
        return parts

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            terms = (text.as_py() or "").encode("utf-8", "replace").translate(_TERMS).split()
            n, df = groups.setdefault((lang or "", source or ""), (Counter(), Counter()))
            held -= len(n)
            n.update(terms)
            df.update(set(terms))
            held += len(n)
            if held > HELD_TERMS:
                yield from flush()
                held = 0
    yield from flush()


def probability(count: np.ndarray, whole: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / whole)``, in two steps so that no product overflows."""
    high = (count + 1) * 100_000
    return 1 + high // whole * 10_000 + high % whole * 10_000 // whole


def divergence(p, q):
    d = p - q
    return d * d // q


def _pack(top: int):
    """Rows of one (lang, block, source) in order of the term's number, a marker first, into one compressed vector row, and the
    ``top`` terms of the group in the block."""

    def run(batches):
        now, parts = None, []
        empty = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string())

        def done():
            lang, block, source, total, kept, in_block, lang_total = now
            ids, n, everywhere = (np.concatenate([p[i] for p in parts]) for i in range(3))
            vector = zlib.compress(np.diff(ids, prepend=np.int32(0)).astype(np.int32).tobytes() + n.tobytes(), 1)
            yield (*now, vector, None, None)
            p, q = probability(n, max(1, total + kept)), probability(everywhere, max(1, lang_total + kept))
            value = np.where(p > q, divergence(p, q), -1)
            # Only what reaches the value of rank ``top`` goes to the heap, ties included.
            least = np.partition(value, -top)[-top] if len(value) > top else 0
            terms = pa.chunked_array([x[3] for x in parts])
            far = np.flatnonzero((value >= least) & (value >= 0))
            for worth, term in nsmallest(top, zip((-value[far]).tolist(), (t.encode() for t in terms.take(pa.array(far)).to_pylist()))):
                yield (lang, block, source, None, None, None, None, None, term.decode(), -worth)

        for batch in batches:
            out, tid = [], batch.column(3).to_numpy()
            marks = np.flatnonzero(tid == -1).tolist()
            for at, end in zip([0, *marks], [*marks, len(tid)]):
                if at == end:
                    continue
                if tid[at] == -1:
                    out += done() if now is not None else ()
                    now, parts = tuple(batch.column(i)[at].as_py() for i in (0, 1, 2, 7, 8, 9, 10)), [empty]
                    at += 1
                piece = batch.slice(at, end - at)
                parts.append((piece.column(3).to_numpy(), piece.column(4).to_numpy(), piece.column(6).to_numpy(), piece.column(5).cast(pa.string())))
            yield _rows(out)
        if now is not None:
            yield _rows(list(done()))

    return run


def _rows(rows: list) -> pa.RecordBatch:
    fields = [c.split() for c in PACKED.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows) if rows else [[]] * len(fields), fields)], [f for f, _ in fields])


class Vector:
    """A group's part of a block: the numbers and probabilities of its terms, and the probability of the others."""

    def __init__(self, source, total, kept, in_block, packed):
        raw = zlib.decompress(packed)
        n = len(raw) // 12
        self.source, self.in_block = source, in_block
        self.terms = np.cumsum(np.frombuffer(raw, np.int32, n), dtype=np.int32)
        whole = max(1, total + kept)
        self.p = probability(np.frombuffer(raw, np.int64, n, 4 * n).copy(), whole)
        self.rest = int(probability(np.zeros(1, np.int64), whole)[0])

    def spread(self) -> None:
        self.all = np.full(self.in_block, self.rest, np.int64)
        self.all[self.terms] = self.p
        self.place = np.full(self.in_block, -1, np.int32)
        self.place[self.terms] = np.arange(len(self.terms), dtype=np.int32)


def meet(a: Vector, b: Vector) -> tuple[int, int]:
    """Sums of the divergence of ``a`` from ``b`` and of ``b`` from ``a`` over the block's terms; ``b`` is spread."""
    q = b.all[a.terms]
    only = np.ones(len(b.terms), bool)
    at = b.place[a.terms]
    only[at[at >= 0]] = False
    r = b.p[only]
    neither = a.in_block - len(a.terms) - len(r)
    there = divergence(a.p, q).sum() + divergence(a.rest, r).sum()
    back = divergence(q, a.p).sum() + divergence(r, a.rest).sum()
    return int(there) + neither * divergence(a.rest, b.rest), int(back) + neither * divergence(b.rest, a.rest)


def _rounds(batches):
    now, residents = None, []
    for batch in batches:
        out = []
        for lang, block, home, round_, source, total, kept, in_block, packed in zip(*(c.to_pylist() for c in batch.columns)):
            if (lang, block, home) != now:
                now, residents = (lang, block, home), []
            visitor = Vector(source, total, kept, in_block, packed)
            visitor.spread()
            for a in residents:
                out.append((lang, a.source, source, *meet(a, visitor)))
            if round_ < 0:
                del visitor.all, visitor.place
                residents.append(visitor)
        kinds = [pa.string()] * 3 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 5, kinds)], [c.split()[0] for c in PAIRS.split(", ")])


def rotation(vectors: DataFrame) -> DataFrame:
    """Rows of ``vectors(lang, block, source, tile, tiles, ...)`` at every resident that they meet, with the round: -1 at home,
    then those of the tournament, where the two tiles' sum decides which of them stays."""
    players = F.expr("CASE WHEN tiles % 2 = 0 THEN tiles ELSE tiles + 1 END")
    v = vectors.withColumn("players", players)
    home = v.select("*", F.col("tile").alias("home"), F.lit(-1).alias("round"))
    away = v.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda i: i != F.col("tile"))).alias("home"))
    away = away.where("home = CASE WHEN (home + tile) % 2 = 1 THEN least(home, tile) ELSE greatest(home, tile) END")
    last = F.expr("greatest(home, tile) = players - 1")
    round_ = F.when(last, F.least("home", "tile")).otherwise(F.expr("((home + tile) * (players div 2)) % (players - 1)")).cast("int")
    return home.unionByName(away.withColumn("round", round_))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 3, top: int = 200) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` has a group's divergence from every other source of its
    language, part ``term`` the ``top`` terms that are more probable in the group than in its language."""
    empty = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    rows = docs.select(empty(lang_col).alias("lang"), empty(source_col).alias("source"), docs[text_col].alias("text"))
    counts = rows.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    counts = stash(counts, "counts")
    known = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("everywhere"), F.sum("df").alias("df")).where(F.col("df") >= least_docs)
    langs = known.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("everywhere").alias("lang_total"))
    every = counts.where("term IS NULL").select("lang", "source")
    langs = every.select("lang").distinct().join(langs, "lang", "left").select("lang", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("kept", "lang_total")])
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") / F.lit(BLOCK_TERMS))).cast("int").alias("blocks")
    langs = stash(langs.select("*", blocks), "langs")
    dealt = known.join(langs.select("lang", "blocks"), "lang").select("lang", "term", "everywhere", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1
    dealt = stash(dealt.select("*", number.alias("tid")), "terms")
    entries = counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(dealt, ["lang", "term"])
    entries = stash(entries.select("lang", "block", "source", "tid", "n", "term", "everywhere"), "entries")

    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("entries"))
    groups = every.join(totals, ["lang", "source"], "left").select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "entries")]).join(langs, "lang")
    size = groups.groupBy("lang").agg(F.greatest(F.lit(1), F.ceil(F.sum("entries") / (F.first("blocks") * F.lit(TILE_ENTRIES)))).cast("int").alias("tiles"))
    groups = stash(groups.join(size, "lang").select("*", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("tile")), "groups_of")
    in_block = dealt.groupBy("lang", "block").agg(F.count("*").alias("in_block"))
    markers = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "total", "kept", "lang_total").join(in_block, ["lang", "block"], "left")
    null = lambda kind: F.lit(None).cast(kind)
    markers = markers.select("lang", "block", "source", F.lit(-1).alias("tid"), null("long").alias("n"), null("string").alias("term"), null("long").alias("everywhere"), "total", "kept", F.coalesce("in_block", F.lit(0)).cast("long").alias("in_block"), "lang_total")
    marked = entries.select("*", *[null("long").alias(c) for c in ("total", "kept", "in_block", "lang_total")]).unionByName(markers)
    marked = marked.select("lang", "block", "source", "tid", "n", "term", "everywhere", "total", "kept", "in_block", "lang_total")
    key = ["lang", "block", "source"]
    packed = stash(marked.repartition(*key).sortWithinPartitions(*key, "tid").mapInArrow(_pack(top), PACKED), "packed")

    vectors = packed.where("vector IS NOT NULL").select(*key, "total", "kept", "in_block", "vector").join(groups.select("lang", "source", "tile", "tiles"), ["lang", "source"])
    cell = ["lang", "block", "home"]
    circling = rotation(vectors).select(*cell, "round", "source", "total", "kept", "in_block", "vector")
    met = circling.repartition(*cell).sortWithinPartitions(*cell, "round", "source").mapInArrow(_rounds, PAIRS)
    met = stash(met.groupBy("lang", "a", "b").agg(F.sum("there").alias("there"), F.sum("back").alias("back")), "met")
    pair = met.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.col("there").alias("value")).union(met.select("lang", "b", "a", "back"))
    terms = packed.where("vector IS NULL").select("lang", "source", F.col("term").alias("item"), "value")
    return _ranked(pair, "pair").unionByName(_ranked(terms, "term").where(F.col("rank") <= top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order: list[Column] = [F.col("value").desc(), F.col("item")]
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY 1, 2),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, (1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 1) // (coalesce(n.n, 0) + v.v))::HUGEINT AS p
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
lc AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY 1, 2),
ln AS (SELECT lang, sum(c) AS n FROM lc GROUP BY 1),
q AS (SELECT lang, term, (1 + 1000000000::HUGEINT * (lc.c + 1) // (ln.n + v.v))::HUGEINT AS q FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY 1, 2, 4),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
