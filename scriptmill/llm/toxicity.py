"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max
inverted index, distance-weighted votes, calibrated.

Terms are lower-cased words and their beginnings of four to six letters
(marked ``^``), so inflected forms meet.  The examples are a bounded sample of
labelled documents (``per_class`` of each label, held-out fold left out).  The
vocabulary keeps the terms that mark toxic examples: seen at least ``lift``
times as often in them as in the others, with a log ratio at least ``min_z``
times its standard error.  Near copies count once or nearly so: examples are
told apart by the smallest hash of their five-word shingles.  An example is a vector of (1 + ln tf) * idf, length 1.

Search.  Postings are grouped into blocks of ``BLOCK`` examples; each term
keeps its largest weight per block.  A query adds these up to an upper bound
per block and scores blocks in falling bound order, until no block left can
reach the ``k``-th best cosine: the result is the exact top k.

Score.  Neighbours vote with their cosine squared against a prior vote of
``PRIOR`` at the base rate.  The votes of the examples themselves, each left
out of its own search and weighted back to the labels' true rate, are turned
into probabilities by isotonic regression; the score is read off that curve.
A text that shares no term with any example gets the score of an empty vote.

Defined results: null and empty texts share no term; ties in cosine go to the
smaller example number; rows that repeat a doc_id are scored one by one; null
labels are not used, several labels of one doc_id count as their maximum;
without examples of both classes every score is the labels' base rate (0 if
there are no labels); other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.quality import labelled_rows, labelled_sample

PER_CLASS = 3000
LIFT = 4.0
MIN_Z = 3.0
MAX_TERMS = 20_000
NEIGHBOURS = 15
BLOCK = 64
PRIOR = 0.1
THRESHOLD = 0.7
EVIDENCE = 3

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6)


def terms_of(word: str) -> list[str]:
    return [word] + ["^" + word[:n] for n in _STEMS if len(word) >= n]


def count_terms(text: str | None, vocabulary: dict[str, int] | None = None) -> Counter:
    """Term counts of a whole text; with a vocabulary, of its term numbers."""
    words = _WORD.findall((text or "").lower())
    if vocabulary is None:
        out: Counter = Counter()
        for w, n in Counter(words).items():
            for t in terms_of(w):
                out[t] += n
        return out
    get = vocabulary.get
    hits = [v for w in words if (v := get(w)) is not None]
    for n in _STEMS:
        hits += [v for w in words if len(w) >= n and (v := get("^" + w[:n])) is not None]
    return Counter(hits)


def kin(text: str | None) -> int:
    """Smallest hash of the five-word shingles: near copies mostly share it."""
    words = _WORD.findall((text or "").lower())
    return min(xxhash.xxh64_intdigest(" ".join(words[i:i + 5])) >> 1 for i in range(max(1, len(words) - 4)))


@dataclass
class Index:
    """Examples as unit vectors in term-major postings with block maxima."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    doc_ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray  # how many labelled documents an example stands for
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # per term: examples, weights
    block_max: np.ndarray | None = None  # terms x blocks
    curve: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.0]))
    base_rate: float = 0.0

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Terms and unit-length weights."""
        terms = np.array(sorted(counts), dtype=np.int64)
        w = (1 + np.log([counts[t] for t in terms.tolist()])) * self.idf[terms] if len(terms) else np.zeros(0)
        return terms, w / max(np.sqrt((w * w).sum()), 1e-12)

    def build(self, counts: list[Counter]) -> None:
        """Fill the postings from the examples' term counts."""
        held: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for i, c in enumerate(counts):
            for t, w in zip(*(x.tolist() for x in self.vector(c)), strict=True):
                held[t].append((i, w))
        self.postings = [(np.array([i for i, _ in p], dtype=np.int64), np.array([w for _, w in p])) for p in held]
        self.block_max = np.zeros((len(held), -(-max(len(counts), 1) // BLOCK)))
        for t, (ids, w) in enumerate(self.postings):
            np.maximum.at(self.block_max[t], ids // BLOCK, w)

    def nearest(self, counts: Counter, k: int, leave_out: int = -1) -> list[tuple[float, int]]:
        """The ``k`` most similar examples with a cosine above 0: (cosine, example)."""
        terms, weights = self.vector(counts)
        if not len(terms):
            return []
        bounds = weights @ self.block_max[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or (len(best) == k and bounds[b] < best[-1][0] - 1e-12):
                break
            score = np.zeros(BLOCK)
            for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                if self.block_max[t, b]:
                    ids, ws = self.postings[t]
                    lo, hi = np.searchsorted(ids, (b * BLOCK, (b + 1) * BLOCK))
                    score[ids[lo:hi] - b * BLOCK] += w * ws[lo:hi]
            found = [(float(np.round(score[i], 12)), b * BLOCK + i) for i in np.flatnonzero(score > 0).tolist()]
            best = sorted(best + [x for x in found if x[1] != leave_out], key=lambda x: (-x[0], x[1]))[:k]
        return best

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Share of toxic votes among neighbours, with the prior's vote."""
        w = np.array([s * s for s, _ in near]) * self.weights[[i for _, i in near]] if near else np.zeros(0)
        toxic = self.labels[[i for _, i in near]] if near else np.zeros(0)
        prior = PRIOR * float(self.weights.min(initial=1.0))
        return float(((w * toxic).sum() + prior * self.base_rate) / (w.sum() + prior))

    def score(self, counts: Counter, k: int = NEIGHBOURS) -> tuple[float, list[tuple[float, int]]]:
        near = self.nearest(counts, k)
        return float(np.interp(self.vote(near), *self.curve)), near


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing weighted least-squares fit: knots and their values."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # smallest x, largest x, weight, weighted sum
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        if blocks and blocks[-1][1] == a:
            blocks[-1][2] += c
            blocks[-1][3] += b * c
        else:
            blocks.append([a, a, c, b * c])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots, values = [], []
    for lo, hi, c, s in blocks:
        for at in dict.fromkeys((lo, hi)):
            knots.append(at)
            values.append(s / c)
    return np.array(knots), np.array(values)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, lift: float = LIFT, min_z: float = MIN_Z,
        max_terms: int = MAX_TERMS, k: int = NEIGHBOURS) -> Index:
    """The index of a bounded sample of labelled documents."""
    sample = labelled_sample(labels, "toxic", per_class)
    examples = labelled_rows(docs, sample, per_class)

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text, label in zip(pdf["text"], pdf["label"], strict=True):
                yield pd.DataFrame({"term": list(count_terms(text)), "label": label, "kin": kin(text)})

    train = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    total = {int(r["y"]): r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = {int(r["label"]): r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = total.get(1, 0) / max(1, sum(total.values()))
    index = Index({}, np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0), np.ones(0), base_rate=rate,
                  curve=(np.array([0.0]), np.array([rate])), block_max=np.zeros((0, 1)))
    if not (size.get(0) and size.get(1)):
        return index
    ratio = F.log((F.col("toxic") + 0.5) / (size[1] + 1)) - F.log((F.col("clean") + 0.5) / (size[0] + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (examples.mapInPandas(distinct, "term string, label int, kin long")
             .distinct().groupBy("term")
             .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
             .filter((ratio >= float(np.log(lift))) & (ratio >= min_z * error))
             .orderBy(F.desc(F.round(ratio / error, 9)), "term")
             .limit(max_terms).select("term", (F.col("toxic") + F.col("clean")).alias("df")).collect())
    index.vocabulary = {r["term"]: i for i, r in enumerate(found)}
    n = size[0] + size[1]
    index.idf = np.array([np.log((n + 1) / (r["df"] + 1)) + 1 for r in found])
    vocabulary = index.vocabulary

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = [count_terms(t, vocabulary) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "terms": [list(c) for c in counts],
                                "tf": [list(c.values()) for c in counts]})

    # neighbours of a block should be alike: sorted by label, then by their terms
    rows = (examples.mapInPandas(vectors, "doc_id long, label int, terms array<int>, tf array<int>")
            .orderBy("label", F.sort_array("terms"), "doc_id").collect())  # at most 2 * per_class
    index.doc_ids = np.array([r["doc_id"] for r in rows], dtype=np.int64)
    index.labels = np.array([r["label"] for r in rows], dtype=float)
    index.weights = np.array([total[r["label"]] / size[r["label"]] for r in rows])
    counts = [Counter(dict(zip(r["terms"], r["tf"], strict=True))) for r in rows]
    index.build(counts)
    votes = np.array([index.vote(index.nearest(c, k, leave_out=i)) for i, c in enumerate(counts)])
    index.curve = isotonic(votes, index.labels, index.weights)
    return index


def score(docs: DataFrame, index: Index, k: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` of every row: the
    evidence holds the nearest examples with their labels and cosines."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the sample and the vocabulary
    kind = "score double, evidence array<struct<doc_id:bigint,toxic:int,cosine:double>>"

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        ix, scores, evidence = shared.value, [], []
        for t in texts:
            s, near = ix.score(count_terms(t, ix.vocabulary), k)
            scores.append(s)
            evidence.append([{"doc_id": int(ix.doc_ids[i]), "toxic": int(ix.labels[i]), "cosine": c} for c, i in near[:EVIDENCE]])
        return pd.DataFrame({"score": scores, "evidence": evidence})

    return (docs.select("doc_id", judge(F.coalesce("text", F.lit(""))).alias("r"))
            .select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"),
                    "r.score", (F.col("r.score") >= threshold).cast("int").alias("predicted"), "r.evidence"))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
