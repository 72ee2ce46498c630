"""Groups of spelling variants of a corpus's words by letter-parity bitmask bands.

A word's mask has one bit for each residue of its code points modulo ``BITS`` (a to z each have their own), set if that many
of its letters are odd in number. An inserted or deleted letter flips one bit and a replaced one at most two, so of
``BANDS`` = 3 bands of the mask one is equal in any two words that are one edit apart. Words meet on an equal band, under the
length of the shorter word (each word also stands as the longer of a pair), and are verified by edit distance.

A band has 1024 values, so a vocabulary of millions would still meet by the thousand under one. One edit also leaves the first
half of the shorter length or the rest of it as it is, so the key has that too; this splits what a band would gather without
losing a pair. Each pair is made once, at its first equal band and half. Words' counts are summed in tasks before they are
shuffled, the vocabulary is the largest thing joined, and a word has as many rows under the keys whatever its count.

Defined cases: null or empty texts have no words; a null id counts as the empty string in the hash that damages words; repeated
rows count as often as they stand there; of near words of equal count the smallest in code-point order is the form; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from math import ceil, log2, log10
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

BITS, BANDS = 30, 3
BAND_BITS = BITS // BANDS
#: Words held in a task before their counts are passed on.
HELD_WORDS = 300_000
#: Letters in Latin-1, the ASCII ones in lower case; every other byte parts words.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def damaged(doc_id: str, run: bytes) -> bytes:
    """``run`` (Latin-1), without one letter if the hash of it and its document says so."""
    h = crc32(f"{doc_id}:{run.decode('latin-1')}".encode())
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _tally(least: int):
    def run(batches):
        counts: Counter = Counter()

        def flush():
            words = [w.decode("latin-1") for w in counts]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = (text.as_py() or "").encode("latin-1", "replace").translate(_LETTERS).split()
                for word, n in Counter(r for r in runs if len(r) >= least).items():
                    word = damaged(doc_id, word)
                    if len(word) >= least:
                        counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield flush()
        yield flush()

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2) -> DataFrame:
    """``(word, n)``: words of ``least_length`` letters or more that occur ``least_count`` times or more in all texts."""
    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), docs[text_col].alias("text"))
    counts = rows.mapInArrow(_tally(least_length), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def parity_mask(word: Column) -> Column:
    """The bits of the residues that an odd number of the word's code points have."""
    bits = F.transform(F.split(word, ""), lambda c: F.expr("1L") * F.pow(F.lit(2.0), F.ascii(c) % BITS).cast("long"))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda mask, bit: mask.bitwiseXOR(bit))


def near_pairs(words: DataFrame, least_length: int = 7) -> DataFrame:
    """``(a, a_n, b, b_n)`` once for each two of ``words(word, n)`` that differ by one inserted, deleted or replaced code
    point; ``a`` is the shorter or, of equal lengths, the smaller. No word is shorter than ``least_length``."""
    masked = words.select("word", "n", F.length("word").alias("len"), parity_mask(F.col("word")).alias("mask"))
    lengths = F.filter(F.array(F.col("len"), F.col("len") - 1), lambda x: x >= least_length)
    keyed = masked.select("*", F.explode(lengths).alias("short"))
    bands = [F.expr(f"(shiftright(mask, {BAND_BITS * i}) & {(1 << BAND_BITS) - 1}L)") for i in range(BANDS)]
    # An edit in the first half leaves what follows it, and one beyond leaves the first half.
    half = {"left": F.expr("short div 2").cast("int"), "right": F.expr("short - short div 2").cast("int")}
    keys = [F.struct(F.lit(i).alias("band"), b.alias("bits"), F.lit(end).alias("end"), getattr(F, end)("word", half[end]).alias("half")) for i, b in enumerate(bands) for end in ("left", "right")]
    rows = keyed.select("word", "n", "len", "mask", "short", F.explode(F.array(*keys)).alias("key")).select("word", "n", "len", "mask", "short", "key.*")
    on = ["short", "band", "bits", "end", "half"]
    a = rows.where("len = short").select(*on, F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("mask").alias("a_mask"))
    b = rows.select(*on, F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("len").alias("b_len"), F.col("mask").alias("b_mask"))
    same = lambda i: F.expr(f"((a_mask ^ b_mask) & {((1 << BAND_BITS) - 1) << BAND_BITS * i}L) = 0")
    earlier = (F.col("band") > 0) & same(0) | (F.col("band") > 1) & same(1)
    left = F.left("a", F.expr("short div 2").cast("int")) == F.left("b", F.expr("short div 2").cast("int"))
    once = ((F.col("b_len") > F.col("short")) | (F.col("a") < F.col("b"))) & ~earlier & ((F.col("end") == "left") | ~left)
    return a.join(b, on).where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_count: int = 2, times: int = 10) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary: ``form`` is the near word of the largest count, if
    it is ``times`` the word's own at least, and ``root`` the last word that forms lead to."""
    words = stash(vocabulary(docs, id_col, text_col, least_length, least_count), "words")
    pairs = stash(near_pairs(words, least_length), "near_pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("rank"), F.col("b").alias("word")).alias("other"))
    both = both.union(pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("rank"), F.col("a").alias("word")).alias("other")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    formed = -F.col("best.rank") >= times * F.col("n")
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.rank")).alias("form_n"))
    out = stash(out, "forms")
    # Each form is times as frequent as its word, so a chain has no more steps than the largest count allows.
    most = out.agg(F.max("n")).first()[0] or 1
    up = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(ceil(log2(log10(most) / log10(times) + 2))):
        up = stash(up.join(up.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return out.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT list(x ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda v, j: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS x FROM range(256) r(i))),
runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2),
coded AS (
  SELECT run, c, list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [(192 + (unicode(ch) >> 6))::BIGINT, (128 + (unicode(ch) & 63))::BIGINT] END))) AS bytes FROM runs),
hashed AS (
  SELECT run, c, xor(list_reduce(bytes, lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1])), 4294967295) AS h FROM coded, bits),
words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed)
  GROUP BY 1 HAVING length(word) >= 7 AND sum(c) >= 2),
cut AS (SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT DISTINCT word, other, m FROM (
    SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN words b ON a.rest = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
    UNION ALL SELECT a.word, b.word, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word)),
best AS (SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (WHERE m = top) AS other FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.at WHERE e.form IS NULL
"""
