"""Jaccard join of word n-gram sets by T-occurrence search (DivideSkip).

Two sets of n and m shingles reach ``percent`` when they share at least ``required(n, m)`` of them, so a search for the
partners of a set is: which sets occur on at least T of the inverted lists of its shingles? ``ListIndex`` answers it as
DivideSkip does (Li, Lu and Lu, 2008): the L longest lists are put aside, the short ones are merged through a heap, a set on
fewer than T - L of them is out, and the others are looked up in the long lists by binary search until T is reached or is
out of reach.

The search runs in cells, so no list is ever longer than a cell, and twice: on the few first shingles of each set, then, for rows that met
there, on whole sets. Plan: one pass over the texts gives each set's size and
fingerprint and ``COUNTERS`` counters of how often shingles occur, over all documents -> one class per distinct set -> of
each set the shingles that come first in the order (counter, hash), one row each: sets that link have ``common`` of these
in common at least, so a set with fewer that any other has is out, and once it is out its shingles no longer count for others
-> a star from the rows of each shingle to its smallest id -> search for the head among its star -> components -> where the rows of
a shingle still lie in several components, the rows outside the largest search among all of sizes near theirs, cell by
cell -> components. Rows already joined are never compared; no candidate is dropped. Since frequent shingles come last in
the order, texts that only share boilerplate or chance phrases never meet.

The driver holds the counters' sums (``COUNTERS`` numbers), a task one cell of about ``CELL_SHINGLES`` shingles (or one longer
text). Stars and cells are cut by their shingles; joins on keys that a group of copies can make hot broadcast the few
hot keys and shuffle the others. Shingles are 64-bit hashes and sets are told apart by 128 bits of them, neither checked
against words.

Defined cases: null or empty texts and texts without words have the empty set and link with nothing; a text of fewer words than
``k`` has its word sequence as its one shingle; rows with a null id stay alone (component null); repeated rows count once; an
id that repeats with different texts joins the classes of its texts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from heapq import merge
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_rows, join_hot, stash
from .components import connected_components
from .shingles import U, mix, shingle_sets

#: Counters of shingle frequency; a shingle adds to the one its hash begins with.
COUNTERS = 1 << 18
_COUNTER = U(64 - 18)
PARTS = 64
#: Shingles indexed in one cell, and shingles of queries that stream past it.
CELL_SHINGLES, STREAMED_SHINGLES = 50_000, 500_000
#: What a binary search costs against a step of the merge; sets how many lists count as long.
MU = 0.0085
#: Times that sets without enough shared shingles are taken out.
PEELED = 2
#: Ids up to this number are broadcast to the scan that fetches their texts.
NEAR_IDS = 500_000

SURVEY = "id long, n_shingles long, fp1 long, fp2 long, part int, counters binary"
FIRST = "id long, n int, least int, keys array<long>"
CELL = ["head", "part", "qpart"]
ROW = [*CELL, "turn", "id", "comp", "other"]


def required(n: int, m: int, percent: int) -> int:
    """Fewest common shingles of sets of ``n`` and ``m`` at the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def least_required(n: int, percent: int) -> int:
    """The same over all sizes a partner of a set of ``n`` can have."""
    return -(-percent * n // 100)


def common(n: int) -> int:
    """How many of its first shingles a set of ``n`` is to share with a partner that asks for no fewer. The prefixes of
    ``n - least_required(n) + common(n)`` shingles of two sets that link share the smaller of their two numbers."""
    return max(1, n // 20)


class ListIndex:
    """Inverted lists over a few sets, and the T-occurrence search in them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.shingles, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))
        self.rows = np.repeat(np.arange(len(sets)), self.sizes)[order].tolist()

    def search(self, s: np.ndarray, least: int, need, wanted=lambda row: True):
        """Rows that have ``need(row)`` shingles of ``s`` or more, where no row needs fewer than ``least``; ``wanted`` is asked
        before a row's long lists are."""
        if not len(s) or not len(self.shingles):
            return
        at = np.minimum(np.searchsorted(self.shingles, s), len(self.shingles) - 1)
        at = at[self.shingles[at] == s]
        if len(at) < least:
            return
        begin, end = self.starts[at], self.starts[at + 1]
        order = np.argsort(end - begin, kind="stable")
        aside = min(least - 1, int(least / (MU * log2(max(2, int((end - begin).max()))) + 1)))
        begin, end = begin[order].tolist(), end[order].tolist()
        cut = len(begin) - aside
        for row, found in groupby(merge(*(self.rows[a:b] for a, b in zip(begin[:cut], end[:cut])))):
            have = sum(1 for _ in found)
            if have < least - aside or not wanted(row):
                continue
            enough, left = need(row), aside
            for a, b in zip(begin[cut:], end[cut:]):
                if have >= enough or have + left < enough:
                    break
                left -= 1
                i = bisect_left(self.rows, row, a, b)
                have += i < b and self.rows[i] == row
            if have >= enough:
                yield row


def _survey(k: int):
    def run(batches):
        counts, waiting, held = np.zeros(COUNTERS, np.int64), [], 0
        for batch in batches:
            n, fp1, fp2 = [], [], []
            for s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                fp1.append(int(mix(s ^ U(0x51ED270B)).sum().view(np.int64)) if len(s) else 0)
                fp2.append(int(mix(s ^ U(0xC2B2AE3D)).sum().view(np.int64)) if len(s) else 0)
                waiting.append((s >> _COUNTER).astype(np.int32))
                held += len(s)
                if held > COUNTERS:
                    counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, held = [], 0
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield _batch([batch.column(0), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), *none], SURVEY)
        if held:
            counts += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        if counts.any():
            none = [pa.nulls(PARTS, pa.int64()) for _ in range(4)]
            yield _batch([*none, pa.array(range(PARTS), pa.int32()), pa.array([c.tobytes() for c in np.split(counts, PARTS)], pa.binary())], SURVEY)

    return run


def _batch(columns, schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])


def _sum(batches):
    now, total = None, None
    for batch in batches:
        for part, counters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part != now:
                if now is not None:
                    yield _batch([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], "part int, counters binary")
                now, total = part, np.zeros(COUNTERS // PARTS, np.int64)
            total += np.frombuffer(counters, np.int64)
    if now is not None:
        yield _batch([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())], "part int, counters binary")


def frequency_levels(counters: DataFrame) -> np.ndarray:
    """Eight times the binary logarithm of each counter's sum over all ``counters(part, counters)``."""
    summed = counters.repartition("part").sortWithinPartitions("part").mapInArrow(_sum, "part int, counters binary")
    total = np.zeros((PARTS, COUNTERS // PARTS), np.int64)
    for row in summed.collect():
        total[row.part] = np.frombuffer(row.counters, np.int64)
    return (8 * np.log2(total.ravel() + 1)).astype(np.uint8)


def _first_shingles(levels: np.ndarray, percent: int, k: int):
    """Of each set the shingles first in the order (level, hash), and how many of them it shares with any partner at least."""

    def run(batches):
        for batch in batches:
            n, least, keys = [], [], []
            for s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                least.append(common(least_required(len(s), percent)))
                rare = np.argsort(levels[(s >> _COUNTER).astype(np.int64)], kind="stable")
                keys.append(s[rare[: len(s) - least_required(len(s), percent) + common(len(s))]].view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield _batch([batch.column(0), pa.array(n, pa.int32()), pa.array(least, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], FIRST)

    return run


def _shared(members: DataFrame, total: int) -> DataFrame:
    """``members(key, id, n, least)`` whose key another id has too, with the key's smallest id as their head."""
    heads = members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("head"), F.max("id").alias("last"), F.count("*").alias("rows")).where("head.id < last")
    heads = stash(heads.select("key", F.col("head.id").alias("head"), F.col("head.n").alias("head_n"), "rows"), "heads")
    return stash(join_hot(members, heads, ["key"], F.col("rows") >= hot_rows(total)).select("key", "id", "n", "least", "head", "head_n"), "shared")


def _of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    return texts.join(F.broadcast(ids) if ids.count() <= NEAR_IDS else ids, "id", "left_semi")


class _Cell:
    """The indexed rows of a cell, and the components that links found in it join."""

    def __init__(self):
        self.rows, self.sets, self.sizes, self.index, self.up = [], [], [], None, {}

    def add(self, row: tuple, s: np.ndarray, size: int) -> None:
        self.rows.append(row), self.sets.append(s), self.sizes.append(size)

    def root(self, c):
        while self.up.get(c, c) != c:
            c = self.up[c]
        return c

    def partners(self, row: tuple, s: np.ndarray, n: int, percent: int, least: int, need):
        """Positions of rows that reach what is needed; of two rows that both search, the later one finds the other."""
        if not self.rows:
            return
        self.index = self.index or ListIndex(self.sets)
        id_, comp, other = row

        def wanted(j: int) -> bool:
            held, m = self.rows[j], self.sizes[j]
            both = other and held[2] and held[0] > id_
            return held[0] != id_ and not both and min(n, m) * 100 >= percent * max(n, m) and self.root(held[1]) != self.root(comp)

        yield from self.index.search(s, least, lambda j: need(n, self.sizes[j]), wanted)


def _meet(percent: int):
    """The rows of each cell whose first shingles meet another's as often as those of sets that link do."""

    def run(batches):
        now, cell, out = None, _Cell(), {}
        for batch in batches:
            done = []
            for row, n, keys in zip(zip(*(batch.column(i).to_pylist() for i in range(len(ROW)))), batch.column(len(ROW)).to_pylist(), batch.column(len(ROW) + 1)):
                if row[:3] != now:
                    done += out
                    now, cell, out = row[:3], _Cell(), {}
                s = keys.values.to_numpy().view(U)
                if row[3] == 0:
                    cell.add(row[4:], s, n)
                    continue
                for j in cell.partners(row[4:], s, n, percent, common(least_required(n, percent)), lambda n, m: min(common(n), common(m))):
                    out[(*now, 0, *cell.rows[j])] = out[row] = None
            yield _rows(done)
        yield _rows(list(out))

    return run


def _rows(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(ROW), kinds)], ROW)


def _verify(percent: int, k: int):
    """Links ``(u, v)`` of the rows of each cell on whole sets, at most one a row and component."""

    def run(batches):
        now, cell = None, _Cell()
        for batch in batches:
            us, vs = [], []
            for row, s in zip(zip(*(batch.column(i).to_pylist() for i in range(len(ROW)))), shingle_sets(batch.column(len(ROW)), k)):
                if row[:3] != now:
                    now, cell = row[:3], _Cell()
                if row[3] == 0:
                    cell.add(row[4:], s, len(s))
                    continue
                for j in cell.partners(row[4:], s, len(s), percent, least_required(len(s), percent), lambda n, m: required(n, m, percent)):
                    held, (id_, comp, _) = cell.rows[j], row[4:]
                    a, b = cell.root(held[1]), cell.root(comp)
                    cell.up[max(a, b)] = min(a, b)
                    us.append(max(id_, held[0])), vs.append(min(id_, held[0]))
            yield _batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], "u long, v long")

    return run


def search_cells(cells: DataFrame, first: DataFrame, docs: DataFrame, percent: int, k: int) -> DataFrame:
    """Links ``(u, v)`` between rows of each cell that lie in different components: rows of turn 0 are indexed, those of turn 1
    search. First shingles meet first; only rows of a cell that met one come again with their texts."""
    dealt = lambda df: df.repartition(*CELL).sortWithinPartitions(*CELL, "turn", "id")
    kinds = "head long, part long, qpart int, turn int, id long, comp long, other boolean"
    met = dealt(cells.join(first.select("id", "n", "keys"), "id").select(*ROW, "n", "keys")).mapInArrow(_meet(percent), kinds)
    met = stash(met.distinct(), "met")
    texts = _of(docs, met.select("id").distinct())
    return dealt(met.join(texts, "id").select(*ROW, "text")).mapInArrow(_verify(percent, k), "u long, v long").distinct()


def star_cells(star: DataFrame) -> DataFrame:
    """Cells of ``star(u, v, n)``: the rows of a head in parts of about ``CELL_SHINGLES``, and the head to search each."""
    width = stash(star.groupBy("v").agg(F.ceil(F.sum("n") / F.lit(CELL_SHINGLES)).cast("int").alias("k"), F.count("*").alias("rows")), "star_widths")
    rows = join_hot(star, width, ["v"], F.col("rows") >= hot_rows(0))
    part = F.pmod(F.xxhash64("u"), F.col("k")).cast("long")
    data = rows.select(F.col("v").alias("head"), part.alias("part"), F.lit(0).alias("qpart"), F.lit(0).alias("turn"), F.col("u").alias("id"), F.col("u").alias("comp"), F.lit(False).alias("other"))
    heads = width.select(F.col("v").alias("head"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("k").cast("long") - 1)).alias("part"), F.lit(0).alias("qpart"), F.lit(1).alias("turn"), F.col("v").alias("id"), F.col("v").alias("comp"), F.lit(False).alias("other"))
    return data.union(heads)


def mixed_cells(groups: DataFrame, total: int, percent: int) -> DataFrame:
    """Cells of ``groups(head, id, n, comp)`` with several components: rows of a size class, cut into parts, to which the rows
    outside the head's largest component come from their own and both neighbouring classes."""
    per = groups.groupBy("head", "comp").agg(F.count("*").alias("rows"))
    per = per.groupBy("head").agg(F.sum("rows").alias("rows"), F.max_by("comp", F.struct("rows", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    rows = join_hot(groups, stash(per, "mixed_heads"), ["head"], F.col("rows") >= hot_rows(total))
    # A class is a little wider than the ratio of sizes that can link, so partners are at most one class apart.
    size = F.floor(F.log("n") / F.lit(float(np.log(100 / percent) * 1.001))).cast("int")
    rows = stash(rows.select("head", "id", "n", "comp", (F.col("comp") != F.col("main")).alias("other"), size.alias("size")), "mixed_rows")
    data = rows.groupBy("head", "size").agg(F.ceil(F.sum("n") / F.lit(CELL_SHINGLES)).cast("int").alias("k"), F.count("*").alias("rows"))
    asking = rows.where("other").select("head", "id", "n", "comp", "other", F.explode(F.sequence(F.col("size") - 1, F.col("size") + 1)).alias("size"))
    asked = asking.groupBy("head", "size").agg(F.ceil(F.sum("n") / F.lit(STREAMED_SHINGLES)).cast("int").alias("q"))
    cut = stash(data.join(asked, ["head", "size"]), "mixed_cells")
    often = F.col("rows") >= hot_rows(total)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    part = F.xxhash64("size", "part").alias("part")
    ready = join_hot(rows, cut, ["head", "size"], often).select("*", one("k").alias("part"), every("q").alias("qpart"))
    ready = ready.select("head", part, "qpart", F.lit(0).alias("turn"), "id", "comp", "other")
    ask = join_hot(asking, cut, ["head", "size"], often).select("*", every("k").alias("part"), one("q").alias("qpart"))
    return ready.union(ask.select("head", part, "qpart", F.lit(1).alias("turn"), "id", "comp", "other"))


def survey(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """``(id, n_shingles, fp1, fp2)`` of every row of ``docs(id, text)``, and how frequent shingles are in all of them."""
    seen = stash(docs.mapInArrow(_survey(k), SURVEY), "survey")
    levels = frequency_levels(seen.where("part IS NOT NULL").select("part", "counters"))
    return seen.where("part IS NULL").select("id", "n_shingles", "fp1", "fp2"), levels


def exact_links(docs: DataFrame, ids: DataFrame, levels: np.ndarray, total: int, percent: int, k: int, known: DataFrame | None = None) -> DataFrame:
    """Links ``(u, v)`` among the texts of ``docs(id, text)`` whose id is in ``ids``, enough of them to join all rows that
    links of ``percent`` join. ``known(u, v)`` are links that need not be found again. Ids are not null."""
    first = docs.mapInArrow(_first_shingles(levels, percent, k), FIRST)
    first = stash(_of(first, ids), "first_shingles")
    members = first.select(F.explode("keys").alias("key"), "id", "n", "least")
    for _ in range(PEELED):
        shared = _shared(members, total)
        enough = shared.groupBy("id", "n", "least").agg(F.count("*").alias("held")).where("held >= least").select("id").distinct()
        members = _of(shared, stash(enough, "enough")).select("key", "id", "n", "least")
    under = _shared(members, total)
    near = F.least("n", "head_n") * 100 >= F.greatest("n", "head_n") * percent
    star = stash(under.where(near & (F.col("id") != F.col("head"))).select(F.col("id").alias("u"), F.col("head").alias("v"), "n").distinct(), "star")
    links = search_cells(star_cells(star), first, docs, percent, k)
    links = stash((links if known is None else links.union(known)).distinct(), "links")
    comps = stash(connected_components(links), "components")

    # Two rows that link share a first shingle; only shingles whose rows lie in several components can add a link.
    placed = stash(under.join(comps, under["id"] == comps["node"], "left").select("key", "head", "id", "n", F.coalesce("component", "id").alias("comp")), "placed")
    mixed = stash(placed.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("rows")).where("a < b").select("key", "rows"), "mixed_keys")
    groups = stash(join_hot(placed, mixed, ["key"], F.col("rows") >= hot_rows(total)).select("head", "id", "n", "comp").distinct(), "mixed_groups")
    if groups.isEmpty():
        return links
    return links.union(stash(search_cells(mixed_cells(groups, total, percent), first, docs, percent, k), "more_links"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, k: int = 3) -> DataFrame:
    """``(id, n_shingles, component)`` for every row: ``component`` is the smallest id that links of at least ``percent`` lead
    to, itself included. Ids are integers; see the module's notes."""
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    every, levels = survey(docs, k)
    total, sets = every.count(), ["fp1", "fp2"]
    live = every.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stash(live.groupBy(*sets).agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    several = live.groupBy("id").agg(F.min("fp1").alias("a"), F.max("fp1").alias("b"), F.min("fp2").alias("c"), F.max("fp2").alias("d")).where("a <> b OR c <> d").select("id")
    twice = live.join(several, "id", "left_semi").join(classes, sets).where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    reps = classes.select(F.col("rep").alias("id")).distinct()
    comps = stash(connected_components(exact_links(docs.where("id IS NOT NULL"), reps, levels, total, percent, k, twice)), "all_components")

    group = stash(classes.join(comps, classes["rep"] == comps["node"], "left").select(*sets, "n", F.coalesce("component", "rep").alias("component")), "groups")
    joined = join_hot(live, group, sets, F.col("n") >= hot_rows(total)).select("id", "n_shingles", "component")
    alone = every.where("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component"))
    return joined.unionByName(alone)


ORACLE = r"""
WITH RECURSIVE ws AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM ws),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 90 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, min(r.v)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.u = d.doc_id GROUP BY d.doc_id
"""
