"""A counterfactually regularised toxicity classifier.

Logistic regression on the words, and the stems of long words, that a text has. For each labelled text that mentions a group, copies are made with the
mention swapped for other groups of its kind; the loss adds ``swap_weight`` times the squared change of the
logit (counterfactual logit pairing), so naming a group does not carry the label by itself. A copy has all features
of the swapped text: the old word's stem goes with it, unless another word of the text has that stem, and the new
word's stem comes in.

Training is bounded: at most ``max_rows`` labelled rows (those with the smallest hash of their id), at most
``max_features`` words, chosen by the z-score of their log-odds over all sampled rows. Scoring covers every
whole text and needs no shuffle.

Defined cases: null or empty texts score as the intercept alone; labelled rows without a document, label or
id are not learned from, a repeated labelled id counts once (its highest label); without any usable label every score is
0. Texts that name no group make no swap; the model says how many swaps it was fitted with. Other columns are
never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

WORD = re.compile(r"\w+")
#: Words longer than this also count by their first letters, which joins inflected and compounded forms.
STEM = 6
#: Words that name or point at people of a group, by kind and language; a swap stays within the kind.
#: A word of several kinds can be swapped within each.
IDENTITY_TERMS = (
    # English
    ("he", "she"),
    ("his", "her"),
    ("himself", "herself"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("mexican", "american", "chinese", "african", "european", "indian"),
    ("old", "young", "elderly"),
    ("deaf", "blind", "disabled"),
    # French
    ("il", "elle"),
    ("ils", "elles"),
    ("homme", "femme"),
    ("hommes", "femmes"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noir", "blanc", "asiatique", "arabe"),
    ("immigrés", "réfugiés", "citoyens", "étrangers"),
    # German
    ("er", "sie"),
    ("ihm", "ihr"),
    ("mann", "frau"),
    ("männer", "frauen"),
    ("muslim", "christ", "jude", "hindu", "buddhist", "atheist"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("einwanderer", "flüchtlinge", "bürger", "ausländer"),
    # Spanish
    ("él", "ella"),
    ("ellos", "ellas"),
    ("hombre", "mujer"),
    ("hombres", "mujeres"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
)


def swap_table(terms=IDENTITY_TERMS) -> dict[str, tuple[str, ...]]:
    """For each term the terms it can be swapped for."""
    out: dict[str, set[str]] = {}
    for kind in terms:
        for t in kind:
            out.setdefault(t, set()).update(x for x in kind if x != t)
    return {t: tuple(sorted(others)) for t, others in out.items()}


def stems(words) -> set[str]:
    """The stems of the long words among these, as ``stem*``."""
    return {w[:STEM] + "*" for w in words if len(w) > STEM}


def features(text: str) -> set[str]:
    """The distinct words of a text, and the stems of the long ones."""
    words = set(WORD.findall(text.lower()))
    return words | stems(words)


def staying(text: str, terms) -> set[str]:
    """Those of ``terms`` in a text whose stem another word of the text has as well."""
    words = set(WORD.findall(text.lower()))
    times = Counter(w[:STEM] for w in words if len(w) > STEM)
    return {t for t in words & terms if len(t) > STEM and times[t[:STEM]] > 1}


@dataclass(frozen=True)
class ToxicityModel:
    """``swaps`` is how many swapped copies of labelled texts the loss was made with."""

    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = -745.0
    swaps: int = 0

    def score(self, texts) -> np.ndarray:
        """Scores between 0 and 1 of an iterable of texts."""
        vocab, logits = self.weights.keys(), []
        for t in texts:
            found = vocab & features(t) if t else ()
            logits.append(self.intercept + sum(self.weights[w] for w in sorted(found)))
        return 1 / (1 + np.exp(-np.clip(np.array(logits, float), -745, 700)))


def training_fold(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 != 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000, max_features: int = 2_000, least_z: float = 3.0, least_log_odds: float = 1.0, l2: float = 0.05, swap_weight: float = 1.0, identity_terms=IDENTITY_TERMS, fold=training_fold) -> ToxicityModel:
    """Fit on labelled rows of the training fold; see the module's notes for the bounds."""
    y = labels.where(fold(labels[id_col])).groupBy(labels[id_col].alias("id")).agg(F.max(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    y = y.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("text IS NOT NULL")

    groups = swap_table(identity_terms)

    def bags(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            bag, held = ([sorted(f(t)) for t in texts] for f in (features, lambda t: staying(t, groups.keys())))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.list_(pa.string())) for x in (bag, held))], ["y", "words", "held"])

    rows = stash(texts.join(F.broadcast(y), "id").select("y", "text").mapInArrow(bags, "y int, words array<string>, held array<string>"), "labelled_words")
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return ToxicityModel({}, -745.0 if not n.get(1) else 700.0)
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n[1] + 0.5 - F.col("a"))) - F.log(b / (n[0] + 0.5 - F.col("b")))
    z = odds / F.sqrt(1 / a + 1 / b)
    counts = rows.select("y", F.explode("words").alias("w")).groupBy("w").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
    chosen = counts.select("w", odds.alias("o"), z.alias("z")).where((F.abs("z") >= least_z) & (F.abs("o") >= least_log_odds)).orderBy(F.abs("z").desc(), "w").limit(max_features)
    vocab = sorted({r.w for r in chosen.collect()} | set(groups))
    keep = F.array(*[F.lit(w) for w in vocab])
    sample = rows.select("y", F.array_sort(F.array_intersect("words", keep)).alias("words"), "held").groupBy("y", "words", "held").agg(F.count("*").alias("n")).orderBy("y", "words", "held").collect()
    return _fit([(r.y, r.words, r.n, r.held) for r in sample], vocab, groups, l2, swap_weight)


def _fit(sample: list, vocab: list[str], groups: dict, l2: float, swap_weight: float, rounds: int = 600) -> ToxicityModel:
    """Full-batch training with Adam on rows ``(label, words, times)``; the intercept comes last and is not shrunk.
    A fourth field names the group terms whose stem stays when they are swapped."""
    at = {w: i for i, w in enumerate(vocab)}
    d = len(vocab)
    y = np.array([s[0] for s in sample], float)
    times = np.array([s[2] for s in sample], float)
    row = np.repeat(np.arange(len(sample)), [len(s[1]) for s in sample])
    col = np.array([at[w] for s in sample for w in s[1]], np.int64)
    swaps = Counter()  # (features that go, features that come): copies
    for _, words, n, *held in sample:
        words = set(words)
        for a in words & groups.keys():
            gone = {a} if held and a in held[0] else {a} | stems([a])
            for b in groups[a]:
                if b not in words:
                    new = {b} | stems([b])
                    swaps[tuple(sorted(gone & words - new)), tuple(sorted((new - words) & at.keys()))] += n
    pairs = sorted(swaps)
    weight = np.array([swaps[x] for x in pairs], float)
    side = [(k, at[w], sign) for k, x in enumerate(pairs) for ws, sign in zip(x, (1, -1)) for w in ws]
    swap, changed, sign = (np.array(x) for x in zip(*side)) if side else (np.zeros(0, int),) * 3
    w = np.zeros(d + 1)
    w[d] = np.log((times * y).sum() / (times * (1 - y)).sum())
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    scale = times.sum()
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(w[d] + np.bincount(row, w[col], len(sample)))))
        r = (p - y) * times
        grad = np.append(np.bincount(col, r[row], d), r.sum())
        grad[:d] += l2 * w[:d]
        if pairs:
            gap = 2 * swap_weight * weight * np.bincount(swap, sign * w[changed], len(pairs))
            grad[:d] += np.bincount(changed, sign * gap[swap], d)
        grad /= scale
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w -= 0.1 * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return ToxicityModel({k: float(w[i]) for k, i in at.items() if abs(w[i]) > 1e-6}, float(w[d]), int(weight.sum()))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(b.column(1).to_pylist()))], ["id", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below ``threshold``."""

    def run(batches, at=docs.columns.index(text_col)):
        for b in batches:
            yield b.filter(pa.array(model.score(b.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)
