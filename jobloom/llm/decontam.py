"""Benchmark decontamination by size-partitioned MinHash containment search.

Benchmark items are dealt into size classes (powers of two of their shingle count), and each class has its own rate,
requirement and index. The rate is the share of all hash values below which shingles are kept in the sketches of that class,
of its items and of documents alike, chosen so that an item keeps ``KEPT`` shingles or more on average; classes of fewer
shingles keep all. So a document's sketch for a class grows with the document, and the share of an item's sketch that is
found in it estimates the containment however long the document is, where sketches of one length for all would
only see a resemblance near nought. An item contained to the threshold gives fewer hits than the class asks for with a chance
below ``MISS``; for classes that keep all, the number asked for is exact. Documents too small for a class skip it.
Candidates are then checked on the words themselves.

One pass over the documents without a shuffle. The benchmark is the query set: its items are taken in
blocks whose shingles number at most ``BLOCK_SHINGLES``, one pass a block, so what the driver holds and sends to each task
is bounded by that constant; what a block finds or leaves is written before the next block is made.

Defined cases: null or empty texts contain nothing and are contained in nothing; a text under five words
has its word sequence as its only shingle, so a short item meets only a document of the same words; repeated
items or documents give repeated pairs; null ids are carried through.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, stash, text_buffers
from .shingles import U, mix, shingle_hashes, shingle_sets

KEPT, MISS = 64, 1e-9
BLOCK_SHINGLES = 2_000_000
_WORD = re.compile(r"[^ \t-\r]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str, k: int = 5) -> set:
    w = _WORD.findall((text or "").translate(_LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@lru_cache
def hits_needed(kept: int, size: int, percent: int) -> int:
    """Fewest hits of ``kept`` coordinates to ask of an item of ``size`` shingles."""
    if kept == size:
        return -(-percent * size // 100)
    p, below = percent / 100, 0.0
    for r in range(kept + 1):
        below += math.comb(kept, r) * p**r * (1 - p) ** (kept - r)
        if below > MISS:
            return max(r, 1)
    return kept


def sampling_hash(shingles: np.ndarray) -> np.ndarray:
    """What decides whether a shingle is kept in a sketch, apart from the hash it is looked up by."""
    return mix(shingles ^ U(0x6A09E667F3BCC909))


def class_of(size: int) -> int:
    """Sizes of ``2 ** (k - 1)`` up to ``2 ** k - 1`` are class ``k``."""
    return size.bit_length()


def class_limit(k: int) -> int:
    """Sketches of class ``k`` keep the shingles whose sampling hash is at most this."""
    return (1 << 64) - 1 if 1 << (k - 1) <= KEPT else (KEPT << 65 - k) - 1


class SizeClass:
    """Sketches of the items of one size class as a sorted index, and the search for them in sketches of documents."""

    def __init__(self, k: int, items: list[int], sets: list[np.ndarray], percent: int):
        self.least_shingles = -(-percent * (1 << (k - 1)) // 100)
        self.limit = U(class_limit(k))
        kept = [s[sampling_hash(s) <= self.limit] for s in sets]
        # an item that by chance keeps next to nothing is looked up by all its shingles
        self.limit = self.limit if min(map(len, kept)) >= KEPT // 4 or k <= class_of(KEPT) else U((1 << 64) - 1)
        kept = [s[sampling_hash(s) <= self.limit] for s in sets]
        self.need = np.array([hits_needed(len(x), len(s), percent) for x, s in zip(kept, sets)], np.int64)
        flat = np.concatenate(kept)
        order = np.argsort(flat, kind="stable")
        self.values, starts = np.unique(flat[order], return_index=True)
        self.starts = np.append(starts, len(flat))
        self.owners = np.repeat(np.arange(len(kept)), [len(x) for x in kept])[order]
        self.items = np.array(items, np.int64)

    def candidates(self, found: np.ndarray, chosen: np.ndarray, row: np.ndarray, size: np.ndarray):
        """``(row, item)`` of documents whose sketch holds enough of an item's; ``found`` are shingles of documents that
        some item has, with their sampling hashes and rows, and ``size`` each row's shingles."""
        mine = (chosen <= self.limit) & (size[row] >= self.least_shingles)
        found, row = found[mine], row[mine]
        slot = np.minimum(np.searchsorted(self.values, found), len(self.values) - 1)
        real = self.values[slot] == found
        if not real.any():
            return
        row, slot = np.unique(np.stack([row[real], slot[real]]), axis=1)
        n = self.starts[slot + 1] - self.starts[slot]
        owner = self.owners[np.repeat(self.starts[slot] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        pair, hits = np.unique(np.stack([np.repeat(row, n), owner]), axis=1, return_counts=True)
        for r, o in pair[:, hits >= self.need[pair[1]]].T:
            yield int(r), int(self.items[o])


class Matcher:
    """The size classes of one block of benchmark items, and the search in a batch of documents."""

    def __init__(self, ids: list, texts: list, percent: int):
        sets = list(shingle_sets(pa.array(texts, pa.large_string())))
        rows = [(i, t, s) for i, t, s in zip(ids, texts, sets) if len(s)]
        self.ids, self.texts, self.sizes, self.percent = [r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows], percent
        members: dict[int, list[int]] = {}
        for i, n in enumerate(self.sizes):
            members.setdefault(class_of(n), []).append(i)
        self.classes = [SizeClass(k, at, [rows[i][2] for i in at], percent) for k, at in sorted(members.items())]
        self.maybe = np.zeros(1 << 20, bool)
        for c in self.classes:
            self.maybe[(c.values >> U(44)).astype(np.int64)] = True
        self._sets: dict[int, set] = {}

    def match(self, column: pa.Array):
        """Yield (row, item, shared) for the pairs at the threshold or above."""
        if not self.classes:
            return
        raw, offsets = text_buffers(column)
        for lo, hi in byte_slices(offsets):
            all_of, bounds = shingle_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            at = np.flatnonzero(self.maybe[(all_of >> U(44)).astype(np.int64)])
            if not len(at):
                continue
            found, row, size = all_of[at], np.searchsorted(bounds, at, side="right") - 1, bounds[1:] - bounds[:-1]
            chosen = sampling_hash(found)
            pairs = sorted(p for c in self.classes for p in c.candidates(found, chosen, row, size))
            for r, i in pairs:
                shared = len(self._item(i) & self._doc(column, lo + r))
                if 100 * shared >= self.percent * self.sizes[i]:
                    yield lo + r, i, shared

    def _item(self, i: int) -> set:
        if i not in self._sets:
            self._sets[i] = shingles(self.texts[i])
        return self._sets[i]

    def _doc(self, column: pa.Array, row: int) -> set:
        if getattr(self, "_last", (None, None))[0] != (id(column), row):
            self._last = ((id(column), row), shingles(column[row].as_py()))
        return self._last[1]


def _blocks(items: DataFrame, id_col: str, text_col: str, percent: int):
    """Blocks of items of bounded size, streamed to the driver one after another."""
    ids, texts, n = [], [], 0
    for row in items.select(items[id_col].alias("id"), items[text_col].alias("text")).where("text IS NOT NULL").toLocalIterator():
        words = len(row.text) // 2 + 1
        if ids and n + words > BLOCK_SHINGLES:
            yield Matcher(ids, texts, percent)
            ids, texts, n = [], [], 0
        ids.append(row.id), texts.append(row.text)
        n += words
    if ids:
        yield Matcher(ids, texts, percent)


def _with_last(blocks):
    """Each block with whether it is the last; two are held at once."""
    blocks = iter(blocks)
    now = next(blocks, None)
    while now is not None:
        later = next(blocks, None)
        yield now, later is None
        now = later


def contamination(docs: DataFrame, items: DataFrame, percent: int = 75, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs ``(doc, item, n_item, n_shared)`` with 100 * n_shared >= percent * n_item over whole texts."""
    rows = docs.select(docs[doc_id].alias("id"), docs[doc_text].alias("text"))
    kinds = rows.schema["id"].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc {kinds[0]}, item {kinds[1]}, n_item long, n_shared long"
    out = docs.sparkSession.createDataFrame([], schema)
    for matcher, last in _with_last(_blocks(items, item_id, item_text, percent)):

        def scan(batches, matcher=matcher):
            for batch in batches:
                found = list(matcher.match(batch.column(1)))
                which = [i for _, i, _ in found]
                item = pa.array([matcher.ids[i] for i in which], pa.int64() if kinds[1] in ("bigint", "long") else None)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r for r, _, _ in found], pa.int64())), item, pa.array([matcher.sizes[i] for i in which], pa.int64()), pa.array([s for _, _, s in found], pa.int64())], ["doc", "item", "n_item", "n_shared"])

        pairs = rows.mapInArrow(scan, schema)
        out = out.unionByName(pairs if last else stash(pairs, "pairs"))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 75, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that contain no benchmark item to the threshold."""
    for matcher, last in _with_last(_blocks(items, item_id, item_text, percent)):

        def clean(batches, matcher=matcher, at=docs.columns.index(doc_text)):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, _, _ in matcher.match(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
        docs = docs if last else stash(docs, "clean")
    return docs


ORACLE = r"""
WITH ws AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM documents),
iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM ws),
bs AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM iw),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1)
SELECT doc_id, item_id, any_value(n_item) AS n_item_shingles, count(*) AS n_shared
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n_item)
"""
