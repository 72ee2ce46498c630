"""MinHash near-duplicate detection by fast similarity sketching, banding and exact verification.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): in round i < t every shingle is hashed to a random bin with
a value; rounds t..2t-1 put every shingle in bin i - t. A coordinate keeps its smallest (round, value).
So all t coordinates fill, for any set that is not empty, and the number on which two sets agree
concentrates round t * J as if the coordinates were drawn without replacement.

Plan: sketch each text once -> one class per distinct set -> band rows of class representatives -> a star
from each band's members to its smallest id -> exact check on whole sets -> components -> where the members under
one head still lie in several components, a check across those, block by block: first on sketches, then exactly for the
rows that some sketch met -> components. Heads of so many rows in different components that blocks would meet more than
``MOST_CELLS`` times (texts that share a template, say) go another way: their rows are joined exactly by their rarest shingles
(``jaccard.exact_links``), which costs in proportion to the rows. Two members already joined are never compared, and no candidate
is dropped.

Joins on keys that a group of copies can make hot (set, band, head) broadcast the few hot keys and shuffle the others.
Shingles are 64-bit hashes and sets of copies are told apart by 128 bits of them, neither checked against words.

Defined cases: null or empty texts and texts without words have the empty set and link with nothing; a
text under five words has its word sequence as its one shingle; rows with a null id stay alone
(component null, kept); an id that repeats with different texts joins the classes of its texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_rows, join_hot, stash
from .components import connected_components
from .jaccard import exact_links, survey
from .shingles import U, mix, shingle_sets

COORDS, ROWS = 128, 4
BANDS = COORDS // ROWS
#: At similarity 0.75, 96 of 128 coordinates agree on average, with a deviation of 4.9; 71 or fewer do with a
#: chance of about 3e-7, less than that of sharing no band.
LEAST_AGREED = 72
BLOCK = 256
#: Members of a band that meet their head in one cell; the head's text is copied to each cell.
CELL_ROWS = 64
#: Meetings of blocks under one head beyond which its rows are joined by their rarest shingles instead.
MOST_CELLS = 64
_BIN = U(57)
_KEEP = U((1 << 49) - 1)


def sketch(s: np.ndarray) -> np.ndarray:
    """The ``COORDS`` filled coordinates of a non-empty set of hashes. Filling on after the last empty
    coordinate changes nothing, since earlier rounds win; so rounds run several at a time."""
    out = np.full(COORDS, np.iinfo(np.uint64).max, U)
    at, step = 0, max(1, min(COORDS, 6 * COORDS // len(s)))
    while at < COORDS:
        rounds = np.arange(at, min(at + step, COORDS), dtype=U)
        h = mix(s[None, :] ^ mix((rounds + U(1)) * U(0x9E3779B97F4A7C15))[:, None])
        np.minimum.at(out, (h >> _BIN).ravel().astype(np.intp), ((rounds[:, None] << U(49)) | (h & _KEEP)).ravel())
        if out.max() != np.iinfo(np.uint64).max:
            return out
        at += len(rounds)
    for b in np.flatnonzero(out == np.iinfo(np.uint64).max):
        h = mix(s ^ mix(np.array([COORDS + b + 1], U) * U(0x9E3779B97F4A7C15)))
        out[b] = (U(COORDS + int(b)) << U(49)) | (h & _KEEP).min()
    return out


def band_keys(sk: np.ndarray) -> np.ndarray:
    rows = sk.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=U)
    for j in range(ROWS):
        key = mix(key * U(0xD6E8FEB86659FD93) + rows[:, j])
    return key


def _sign(batches):
    for batch in batches:
        ids, n, fp1, fp2, bands, agree = batch.column(0), [], [], [], [], []
        none = np.zeros(0, np.int64)
        for s in shingle_sets(batch.column(1)):
            n.append(len(s))
            if not len(s):
                fp1.append(0), fp2.append(0), bands.append(none), agree.append(b"")
                continue
            sk = sketch(s)
            fp1.append(mix(s ^ U(0x51ED270B)).sum().view(np.int64))
            fp2.append(mix(s ^ U(0xC2B2AE3D)).sum().view(np.int64))
            bands.append(band_keys(sk).view(np.int64))
            agree.append((sk & U(255)).astype(np.uint8).tobytes())
        flat = np.concatenate(bands) if bands else none
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)), pa.array(flat, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), lists, pa.array(agree, pa.binary())], ["id", "n_shingles", "fp1", "fp2", "bands", "bytes"])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, set size, a 128-bit fingerprint of the set, band keys and one byte of
    each coordinate."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_sign, f"id {kind}, n_shingles long, fp1 long, fp2 long, bands array<long>, bytes binary")


def verify(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int = 75) -> DataFrame:
    """Of ``pairs(u, v)`` those with 100 * intersection >= percent * union on whole sets.

    Each ``v`` and its ``u`` meet in cells of about ``CELL_ROWS`` members (a ``v`` with more is copied to
    several); sets are built once a row and only the current ``v`` is held.
    """
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    ids = pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
    texts = texts.join(F.broadcast(ids) if ids.count() <= 500_000 else ids, "id", "left_semi")
    width = stash(pairs.groupBy("v").agg(F.ceil(F.count("*") / F.lit(CELL_ROWS)).cast("int").alias("k")), "widths")
    heads = texts.join(width, texts["id"] == width["v"]).select("v", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"), F.lit(0).alias("turn"), F.col("v").alias("u"), "text")
    part = F.pmod(F.xxhash64("u"), F.col("k")).cast("int")
    members = join_hot(pairs, width, ["v"], F.col("k") >= hot_rows(0) // CELL_ROWS).select("v", part.alias("part"), F.lit(1).alias("turn"), "u")
    members = members.join(texts.withColumnRenamed("id", "u"), "u").select("v", "part", "turn", "u", "text")
    both = heads.unionByName(members).repartition("v", "part").sortWithinPartitions("v", "part", "turn", "u")

    def check(batches):
        now, head = None, []
        for batch in batches:
            v, turn, u = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            part, keep = batch.column(1).to_pylist(), []
            for i, s in enumerate(shingle_sets(batch.column(4))):
                if (v[i], part[i]) != now:
                    now, head = (v[i], part[i]), []
                if turn[i] == 0:
                    head.append(s)
                    continue
                for h in head:
                    if min(len(s), len(h)) * 100 < percent * max(len(s), len(h)):
                        continue
                    shared = len(np.intersect1d(s, h, assume_unique=True))
                    if 100 * shared >= percent * (len(s) + len(h) - shared):
                        keep.append(i)
                        break
            yield pa.RecordBatch.from_arrays([batch.column(3).take(pa.array(keep, pa.int64())), batch.column(0).take(pa.array(keep, pa.int64()))], ["u", "v"])

    kind = pairs.schema["u"].dataType.simpleString()
    return both.mapInArrow(check, f"u {kind}, v {kind}").distinct()


class _Cell:
    """The queries of one cell, past which its data rows are streamed."""

    def __init__(self):
        self.ids, self.comps, self.sketches, self.sets = [], [], [], []

    def add(self, id_, comp, sketch, shingles=None):
        self.ids.append(id_), self.comps.append(comp), self.sketches.append(np.frombuffer(sketch, np.uint8)), self.sets.append(shingles)
        self._arrays = None

    def maybe(self, id_, comp, sketch, other) -> np.ndarray:
        """Positions of queries in other components whose sketch agrees; of two queries only the later one asks."""
        if not self.ids:
            return np.zeros(0, np.int64)
        if self._arrays is None:
            self._arrays = np.stack(self.sketches), np.array(self.comps), np.array(self.ids)
        matrix, comps, ids = self._arrays
        hit = ((matrix == np.frombuffer(sketch, np.uint8)).sum(axis=1) >= LEAST_AGREED) & (comps != comp)
        return np.flatnonzero(hit & (ids < id_) if other else hit)


CELL = ["head", "part", "qpart"]
ROW = "head long, part int, qpart int, turn int, id long, comp long, other boolean, bytes binary"


def _met(batches):
    """The rows of each cell whose sketch met another's: data rows at once, queries when the cell ends."""
    now, cell, asked, names = None, _Cell(), {}, None
    for b in batches:
        names = b.schema
        out = []
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:3] != now:
                out += asked.values()
                now, cell, asked, queries = row[:3], _Cell(), {}, {}
            turn, id_, comp, other, sketch = row[3:8]
            if turn == 0:
                cell.add(id_, comp, sketch)
                queries[len(cell.ids) - 1] = row
                continue
            found = cell.maybe(id_, comp, sketch, other)
            if len(found):
                out.append(row)
                asked.update((int(j), queries[int(j)]) for j in found)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(names), names)], schema=names)
    if asked:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*asked.values()), names)], schema=names)


def verify_across(groups: DataFrame, docs: DataFrame, bytes_of: DataFrame, id_col: str, text_col: str, total: int, percent: int = 75) -> DataFrame:
    """Links ``(u, v)`` between components, of ``groups(head, id, comp)`` whose members may be alike.

    In a group, rows outside its most frequent component are the queries and all its rows the data. Both are cut
    into blocks of about ``BLOCK`` rows and each block of queries meets each block of data (a cell); a task holds one block
    of queries and streams the data past it. Sketches meet first, and only rows of a cell that met one come again with
    their texts. Only links that join two components come out, so neither step gives more rows than came in.
    """
    sizes = groups.groupBy("head", "comp").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("head").agg(F.sum("n").alias("all"), F.max("n").alias("most"), F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    every = stash(sizes.select("head", "main", blocks(F.col("all")).alias("k"), blocks(F.col("all") - F.col("most")).alias("q")), "mixed_heads")
    wide = F.col("k").cast("long") * F.col("q") > MOST_CELLS
    sizes = every.where(~wide)
    rows = stash(join_hot(groups, sizes, ["head"], F.col("k") >= hot_rows(total) // BLOCK), "mixed_groups")
    other = F.col("comp") != F.col("main")
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")
    data = rows.select("head", block(F.col("k"), 1).alias("part"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qpart"), F.lit(1).alias("turn"), "id", "comp", other.alias("other"))
    queries = rows.where(other).select("head", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("part"), block(F.col("q"), 2).alias("qpart"), F.lit(0).alias("turn"), "id", "comp", F.lit(True).alias("other"))
    dealt = lambda df: df.repartition(*CELL).sortWithinPartitions(*CELL, "turn", "id")
    met = data.union(queries).join(bytes_of, "id").select(*CELL, "turn", "id", "comp", "other", "bytes")
    met = stash(dealt(met).mapInArrow(_met, ROW).distinct(), "met")
    ids = met.select("id").distinct()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = texts.join(F.broadcast(ids) if ids.count() <= 500_000 else ids, "id", "left_semi")

    def run(batches):
        now, cell, up = None, _Cell(), {}

        def root(c):
            while up.get(c, c) != c:
                c = up[c]
            return c

        for b in batches:
            us, vs = [], []
            for row, s in zip(zip(*(b.column(i).to_pylist() for i in range(8))), shingle_sets(b.column(8))):
                if row[:3] != now:
                    now, cell, up = row[:3], _Cell(), {}
                turn, id_, comp, other_, sketch = row[3:8]
                if turn == 0:
                    cell.add(id_, comp, sketch, s)
                    continue
                for j in cell.maybe(id_, comp, sketch, other_):
                    a, c = root(cell.comps[j]), root(comp)
                    h = cell.sets[j]
                    if a == c or min(len(s), len(h)) * 100 < percent * max(len(s), len(h)):
                        continue
                    shared = len(np.intersect1d(s, h, assume_unique=True))
                    if 100 * shared >= percent * (len(s) + len(h) - shared):
                        up[max(a, c)] = min(a, c)
                        us.append(max(id_, cell.ids[j])), vs.append(min(id_, cell.ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    links = dealt(met.join(texts, "id").select(*CELL, "turn", "id", "comp", "other", "bytes", "text")).mapInArrow(run, "u long, v long").distinct()
    many = every.where(wide)
    if many.isEmpty():
        return links
    ids = stash(join_hot(groups, many, ["head"], F.col("k") >= hot_rows(total) // BLOCK).select("id").distinct(), "wide_ids")
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = stash(texts.join(F.broadcast(ids) if ids.count() <= 500_000 else ids, "id", "left_semi"), "wide_texts")
    return links.union(exact_links(texts, ids, survey(texts, 5)[1], total, percent, 5))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """``(id, n_shingles, component, kept)`` for every row; see the module's notes.

    Ids are integers. Memory: a task holds one Arrow batch and at most about ``BLOCK`` sets.
    """
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    sig = stash(signatures(docs, "id", "text"), "signatures")
    total, sets = sig.count(), ["fp1", "fp2"]
    narrow = sig.select("id", "n_shingles", *sets)
    live = narrow.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stash(live.groupBy(*sets).agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    own = sig.join(classes.select(F.col("rep").alias("id"), *sets), ["id", *sets]).groupBy("id", *sets).agg(F.first("bands").alias("bands"), F.first("bytes").alias("bytes"))
    reps = stash(own.select("id", "bands", "bytes"), "reps")
    members = reps.select(F.explode("bands").alias("key"), "id")
    heads = members.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last"), F.count("*").alias("n")).where("head < last")
    heads = stash(heads.select("key", "head", "n"), "heads")
    star = join_hot(members, heads, ["key"], F.col("n") >= hot_rows(total)).where("id <> head")
    star = stash(star.select(F.col("id").alias("u"), F.col("head").alias("v")).distinct(), "star_pairs")
    bytes_of = reps.select("id", "bytes")
    alike = stash(_agreeing(star, bytes_of), "alike")
    # an id that stands for several sets links them
    several = live.groupBy("id").agg(F.min("fp1").alias("a"), F.max("fp1").alias("b"), F.min("fp2").alias("c"), F.max("fp2").alias("d")).where("a <> b OR c <> d").select("id")
    twice = live.join(several, "id", "left_semi").join(classes, sets).where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    links = stash(verify(alike, docs, "id", "text", percent).union(twice).distinct(), "links")
    comps = stash(connected_components(links), "components")

    # Two members of a band share its head, so the members of a head hold every candidate pair.
    under = star.select(F.col("v").alias("head"), F.col("u").alias("id")).union(star.select(F.col("v").alias("head"), F.col("v").alias("id")).distinct())
    placed = under.join(comps, under["id"] == comps["node"], "left").select("head", "id", F.coalesce("component", "id").alias("comp"))
    more = stash(verify_across(placed, docs, bytes_of, "id", "text", total, percent), "more_links")
    if not more.isEmpty():
        comps = stash(connected_components(links.union(more)), "all_components")

    group = classes.join(comps, classes["rep"] == comps["node"], "left").select(*sets, "n", F.coalesce("component", "rep").alias("component"))
    joined = join_hot(live, stash(group, "groups"), sets, F.col("n") >= hot_rows(total)).select("id", "n_shingles", "component")
    alone = narrow.where("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component"))
    out = joined.unionByName(alone)
    return out.select("id", "n_shingles", "component", F.col("component").eqNullSafe(F.col("id")).alias("kept"))


def _agreeing(pairs: DataFrame, bytes_of: DataFrame) -> DataFrame:
    """Pairs whose sketches agree often enough to be worth the exact check."""
    a = bytes_of.select(F.col("id").alias("u"), F.col("bytes").alias("x"))
    b = bytes_of.select(F.col("id").alias("v"), F.col("bytes").alias("y"))

    def agree(batches):
        for pdf in batches:
            x, y = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(-1, COORDS) for c in "xy")
            yield pdf.loc[(x == y).sum(axis=1) >= LEAST_AGREED, ["u", "v"]]

    return pairs.join(a, "u").join(b, "v").select("u", "v", "x", "y").mapInPandas(agree, "u long, v long")
