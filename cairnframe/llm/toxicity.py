"""Toxicity by a counterfactual-regularised classifier (operator 3).

A logistic regression over the words that a text holds. Learning takes a bounded sample of labelled
rows; their features are made on the executors and come to the driver as hashes. For each sample
text that names an identity group, counterfactuals are made: the text again and again, each time
with all identity terms in its sentences swapped for others of the same kind, until each term has
stood for each other. Besides the log loss, the squared change of the logit over each swap is
penalised. So a term cannot gain weight only because toxic texts mention its group more often.
Scores are computed from whole texts in one pass over the documents, with no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: Labelled rows to learn from at most, in the order of a hash of doc_id.
SAMPLE_ROWS = 20_000
#: Words that the model can weigh at most, and the texts of the sample that must hold each.
MAX_WORDS, MIN_TEXTS = 4096, 3
#: The least evidence (half of G squared) for a word; it keeps rare words from learning single texts by heart.
MIN_EVIDENCE = 8.0
RIDGE, PAIR_WEIGHT, STEPS = 0.5, 1.0, 400
HELD_OUT_OF = 5
BUCKETS = 1 << 22
WORD = re.compile(r"\w+")

# Identity terms by kind; terms of one line can stand for each other.
IDENTITY_TERMS: list[str] = [
    "women men girls boys",
    "woman man girl boy",
    "muslims christians jews hindus buddhists atheists",
    "muslim christian jewish hindu buddhist atheist",
    "black white asian latino african european arab",
    "gay straight lesbian bisexual transgender",
    "immigrants refugees foreigners natives",
    "disabled blind deaf elderly young",
    "frauen männer mädchen jungen",
    "muslime christen juden",
    "femmes hommes filles garçons",
    "musulmans chrétiens juifs",
    "mujeres hombres niñas niños",
    "musulmanes cristianos judíos",
]
#: For each term the others of its line, from the next one on.
SWAPS: dict[str, list[str]] = {t: line.split()[k + 1 :] + line.split()[:k] for line in IDENTITY_TERMS for k, t in enumerate(line.split())}


def tokens_of(text: str | None) -> list[str]:
    """The words of a text in order, as often as they occur."""
    return WORD.findall((text or "").lower())


def words_of(text: str | None) -> set[str]:
    return set(tokens_of(text))


def code(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def counterfactuals(tokens: list[str]) -> list[list[str]]:
    """The word sequence with each identity term replaced by the next of its kind, by the one after, and so on.

    There are as many as the largest kind in the text has other terms; a smaller kind starts again.
    """
    terms = [SWAPS[w] for w in tokens if w in SWAPS]
    return [[SWAPS[w][k % len(SWAPS[w])] if w in SWAPS else w for w in tokens] for k in range(max(map(len, terms), default=0))]


def codes(words: set[str]) -> bytes:
    return np.array(sorted({code(w) for w in words}), "<i4").tobytes()


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the rows from whose labels nothing is learned; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % HELD_OUT_OF == 0


class Rows:
    """Sparse rows of 0 and 1."""

    def __init__(self, sets: list[np.ndarray], width: int) -> None:
        self.n, self.width = len(sets), width
        self.row = np.repeat(np.arange(self.n), [len(s) for s in sets])
        self.col = np.concatenate(sets).astype(np.int64) if sets else np.zeros(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=r[self.row], minlength=self.width)


def choose_words(sets: list[np.ndarray], toxic: np.ndarray, always: set[int]) -> np.ndarray:
    """The codes with the strongest association with the label (G squared), and those in `always`."""
    own = np.concatenate(sets) if sets else np.zeros(0, np.int32)
    y = np.repeat(toxic, [len(s) for s in sets])
    values, at = np.unique(own, return_inverse=True)
    with_word = np.bincount(at, minlength=len(values)).astype(float)
    both = np.bincount(at, weights=y, minlength=len(values))
    n, n1 = float(len(sets)), float(toxic.sum())
    cells = [(both, with_word * n1 / n), (with_word - both, with_word * (n - n1) / n), (n1 - both, (n - with_word) * n1 / n), (n - with_word - n1 + both, (n - with_word) * (n - n1) / n)]
    strength = sum(np.where(o > 0, o * np.log(np.maximum(o, 1e-12) / np.maximum(e, 1e-12)), 0) for o, e in cells)
    strength[with_word < MIN_TEXTS] = -1
    best = np.lexsort((values, -strength))[:MAX_WORDS]
    return np.array(sorted({int(v) for v in values[best[strength[best] >= MIN_EVIDENCE]]} | always), np.int64)


def fit(texts: list[tuple[bytes, int, list[bytes]]], pair_weight: float = PAIR_WEIGHT) -> tuple[dict[int, float], float]:
    """(weights by code, intercept) from (codes, label, codes of the counterfactuals) of distinct texts."""
    toxic = np.array([y for _, y, _ in texts], float)
    if not len(texts):
        return {}, -np.inf
    prior = float(np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5)))
    if toxic.min() == toxic.max():
        return {}, prior
    sets = [np.frombuffer(x, "<i4") for x, _, _ in texts]
    names = choose_words(sets, toxic, {code(t) for t in SWAPS})
    place = lambda s: (k := np.searchsorted(names, s))[(k < len(names)) & (names[np.minimum(k, len(names) - 1)] == s)]
    x = Rows([place(s) for s in sets], len(names))
    pairs = [(i, place(np.frombuffer(c, "<i4"))) for i, (_, _, others) in enumerate(texts) for c in others]
    left, right = Rows([place(sets[i]) for i, _ in pairs], len(names)), Rows([c for _, c in pairs], len(names))
    w, b = np.zeros(len(names)), prior
    # Adam on the full batch: as deterministic as the sample.
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, STEPS + 1):
        error = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -40, 40))) - toxic
        g = x.back(error) + RIDGE * w
        if pairs:
            change = left.dot(w) - right.dot(w)
            g += 2 * pair_weight * (left.back(change) - right.back(change))
        g = np.r_[g, error.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return {int(c): float(a) for c, a in zip(names, w, strict=True) if abs(a) > 1e-6}, float(b)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[dict[int, float], float]:
    """Fit on labelled rows that are not held out; a doc_id with several labels takes their majority, ties 1.

    Of rows that share a doc_id one text counts, the least by its hashes.
    """
    label = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    label = label.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("__toxic"))
    label = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # At most `sample_rows` rows of two numbers, so the documents need no shuffle.
    sample = docs.select("doc_id", "text").join(F.broadcast(label), "doc_id").select("doc_id", F.col("text").cast("string"), "__toxic")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [tokens_of(t) for t in batch.column("text").to_pylist()]
            others = [[codes(set(c)) for c in counterfactuals(w)] for w in tokens]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([codes(set(w)) for w in tokens], pa.binary()), batch.column("__toxic"), pa.array(others, pa.list_(pa.binary()))], names=["doc_id", "words", "toxic", "others"])

    rows = sample.mapInArrow(features, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, words binary, toxic int, others array<binary>")
    # Rows that share a doc_id count as one, so no more than the sample's bound comes to the driver.
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("words", "toxic", "others")).alias("r")).select("r.*").collect()
    # Copies of a text teach nothing new; sorting makes the result independent of the order of tasks.
    distinct = {(bytes(r.words), r.toxic): [bytes(o) for o in r.others] for r in rows}
    return fit([(x, y, distinct[x, y]) for x, y in sorted(distinct)])


def toxicity_scores(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(keep columns, held_out, score, predicted) for each row of `docs` (doc_id, text; `keep` is doc_id unless given).

    Null and empty texts have no words; their score is that of the intercept. Without any label to
    learn from all scores are 0; with labels of one kind only, all have the smoothed share of that
    kind. Repeated rows stay; texts count whole; an empty table gives no rows.
    """
    text_batches(docs.sparkSession)
    keep = keep or ["doc_id"]
    weights, intercept = learn(docs, labels, sample_rows)
    names = [f"__keep_{k}" for k in range(len(keep))]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, crc = weights.get, zlib.crc32
        for batch in batches:
            z = []
            for text in batch.column("__text").to_pylist():
                found = {crc(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words_of(text)}
                z.append(intercept + sum(sorted(x for c in found if (x := get(c)) is not None)))
            s = 1 / (1 + np.exp(-np.clip(np.array(z, float), -700, 700)))
            s[np.isneginf(z)] = 0.0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), batch.column("__held"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*names, "held_out", "score", "predicted"])

    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, keep, strict=True))
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), held_out().alias("__held"), F.col("text").cast("string").alias("__text"))
    out = rows.mapInArrow(score, schema + ", held_out boolean, score double, predicted int")
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)), "held_out", "score", "predicted")
