"""Quality rules: a linear-chain CRF marks each line content or boilerplate.

A document's lines are a sequence; each line has binned shape features
(symbols, capitals, repeated words, length, ...).  A two-state linear-chain
conditional random field scores the sequence, Viterbi decoding labels the
lines, and the share of words on content lines decides retention.

Fitting.  The CRF is fitted on a bounded sample of labelled documents
(``max_docs`` per class with at most ``max_lines`` lines each, lowest keyed
hash of doc_id first, rows equal in doc_id and text once, documents of the held-out fold crc32(doc_id) mod 3 = 1
left out).  Labels are of documents, lines are latent: a document of quality 1
has at least ``CONTENT_SHARE`` of its words on content lines, one of quality 0
less.  Lines are first told apart by a logistic model of their features alone,
then fit and labelling alternate: the chain is fitted by gradient ascent on the
penalised likelihood of the present labels (forward-backward), and each document
is labelled anew by its best path among those that meet its share (a score per
line, raised or lowered until the best path does).  All of it runs on the driver
over the collected feature codes of the sample, never over texts.

Base rules come first: fewer than ``min_words`` words, or more than half of
the words inside repeated three-word windows, reject a document outright.

Defined results: null text counts as empty; an empty text has no words and
fails; equal lines keep their first; rows that repeat a doc_id are scored one
by one; an empty table gives an empty result; a column named ``__quality`` raises;
a very long text is one row of arrays, about 100 bytes a character; a label that is null is not used, several labels of one doc_id count
as their maximum; without any labelled document of both classes every line is
content; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import doc_key, materialize, reserve

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
MAX_DOCS = 1500
MAX_LINES = 2000
L2 = 1.0
STEPS = 200
ROUNDS = 4

_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [32, 9, 10, 11, 12, 13])
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC3)
_STARTS = (_BYTES & 0xC0) != 0x80  # first byte of a code point
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_END = np.isin(_BYTES, list(b".!?:;\"'"))

#: upper bin edges of the line features; a value falls into the first bin whose edge it does not pass
EDGES = {
    "symbols": (0.0, 0.01, 0.03, 0.06, 0.12, 0.25),
    "capitals": (0.0, 0.05, 0.15, 0.3, 0.6),
    "bangs": (0.0, 0.01, 0.05, 0.1),
    "digits": (0.0, 0.05, 0.15, 0.4),
    "repeats": (0.0, 0.05, 0.15, 0.3, 0.5, 0.75),
    "doubled": (0.0, 0.05, 0.2, 0.5),
    "words": (0, 1, 3, 8, 20, 60),
    "ended": (0.5,),
    "seen": (0.5,),
}
_OFFSET = dict(zip(EDGES, np.cumsum([0] + [len(e) + 1 for e in EDGES.values()]), strict=False))
N_FEATURES = sum(len(e) + 1 for e in EDGES.values())


@dataclass(frozen=True)
class Crf:
    """Scores in favour of content: per feature, at the start, and per pair of
    neighbouring labels (0 boilerplate, 1 content)."""

    weights: tuple[float, ...] = (0.0,) * N_FEATURES
    start: float = 1.0
    pairs: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))


def analyse(text: str | None) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Base counts, words per line, and the feature codes (lines x features)."""
    raw = (text or "").encode()
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    n = len(ids)
    repeated = np.zeros(n, dtype=bool)
    if n >= 3:
        v = max(len(seen), 1)
        if v < 2_000_000:
            windows = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
        else:
            pairs = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
            windows = pairs[:-1] * v + ids[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        repeated[:-2] |= twice
        repeated[1:-1] |= twice
        repeated[2:] |= twice
    lines = raw.split(b"\n")
    earlier: set[bytes] = set()
    again = np.zeros(len(lines), dtype=np.int64)
    for i, line in enumerate(lines):
        if line in earlier:
            again[i] = bool(line.strip())
        else:
            earlier.add(line)
    codes = np.frombuffer(raw + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(x) + 1 for x in lines])
    begins = np.concatenate(([0], ends[:-1]))
    space = _SPACE[codes]
    word_start = ~space
    word_start[1:] &= space[:-1]

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, begins, dtype=np.int64)

    chars = per_line(_STARTS[codes] & ~space)
    symbols = per_line(_SYMBOL[codes])
    in_line = per_line(word_start)
    counts = {"n_words": n, "word_chars": int(chars.sum()), "n_symbols": int(symbols.sum()),
              "n_dup_lines": int(again.sum()), "n_repeat_words": int(repeated.sum())}

    of_line = np.repeat(np.arange(len(lines)), in_line)
    distinct = np.bincount(np.unique(of_line * (len(seen) + 1) + ids) // (len(seen) + 1), minlength=len(lines))
    same = np.zeros(n, dtype=np.int64)
    if n > 1:
        same[1:] = (ids[1:] == ids[:-1]) & (of_line[1:] == of_line[:-1])
    doubled = np.bincount(of_line, weights=same, minlength=len(lines))
    letters = np.maximum(per_line(_LETTER[codes]), 1)
    some, some_words = np.maximum(chars, 1), np.maximum(in_line, 1)
    last = np.array([x.rstrip()[-1:] or b" " for x in lines], dtype="S1").view(np.uint8)
    values = {
        "symbols": symbols / some, "capitals": per_line(_UPPER[codes]) / letters,
        "bangs": per_line(codes == 33) / some, "digits": per_line(_DIGIT[codes]) / some,
        "repeats": 1 - np.where(in_line > 0, distinct / some_words, 1.0), "doubled": doubled / some_words,
        "words": in_line, "ended": _END[last], "seen": again,
    }
    feats = np.stack([np.searchsorted(EDGES[k], values[k], side="left") + _OFFSET[k] for k in EDGES], axis=1)
    return counts, in_line, feats.astype(np.uint8)


def viterbi(scores: np.ndarray, crf: Crf) -> list[int]:
    """Best label sequence; a tie prefers content."""
    (bb, bc), (cb, cc) = crf.pairs
    e = scores.tolist()
    b, c, back = 0.0, crf.start + e[0], []
    for x in e[1:]:
        to_b, to_c = c + cb >= b + bb, c + cc >= b + bc  # whether the best way here comes from content
        back.append((to_b, to_c))
        b, c = c + cb if to_b else b + bb, (c + cc if to_c else b + bc) + x
    state, path = int(c >= b), []
    for step in reversed(back):
        path.append(state)
        state = int(step[state])
    path.append(state)
    return path[::-1]


def verdict(text: str | None, crf: Crf) -> dict:
    """All result columns of one text, with the labels of its lines."""
    counts, in_line, feats = analyse(text)
    failed = counts["n_words"] < MIN_WORDS or 100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    labels = viterbi(np.asarray(crf.weights)[feats].sum(axis=1), crf)
    share = float(in_line[np.array(labels) == 1].sum() / counts["n_words"]) if counts["n_words"] else 0.0
    return counts | {"base_failed": failed, "content_share": share, "kept": not failed and share >= CONTENT_SHARE,
                     "line_labels": labels}


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def fit_crf(examples: list[tuple[np.ndarray, np.ndarray | int]], steps: int = STEPS, l2: float = L2, begin_at: Crf | None = None) -> Crf:
    """Gradient ascent (Adam) on the penalised log-likelihood of the label
    sequences; ``examples``: feature codes and the labels of the lines (or one for all)."""
    examples = [(x, np.broadcast_to(np.asarray(y), (len(x),))) for x, y in examples]
    if len({int(v) for _, y in examples for v in np.unique(y)}) < 2:
        return Crf()
    examples = sorted(examples, key=lambda e: -len(e[0]))
    n, t_max = len(examples), len(examples[0][0])
    lengths = np.array([len(x) for x, _ in examples])
    y = np.concatenate([label for _, label in examples])
    alive = [int((lengths > t).sum()) for t in range(t_max)]  # longest first: those alive at t are a prefix
    flat = np.concatenate([x for x, _ in examples])
    begin = np.cumsum(lengths) - lengths
    seq = np.repeat(np.arange(n), lengths)
    counts_1 = np.bincount(flat[y == 1].ravel(), minlength=N_FEATURES).astype(float)
    inner = np.ones(len(flat), dtype=bool)
    inner[begin] = False
    at_inner = np.flatnonzero(inner)
    pair_counts = np.bincount(2 * y[at_inner - 1] + y[at_inner], minlength=4)
    theta = np.zeros(N_FEATURES + 5)
    if begin_at is not None:
        theta = np.array([*begin_at.weights, begin_at.start, *begin_at.pairs[0], *begin_at.pairs[1]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for it in range(1, steps + 1):
        w, s, pairs = theta[:N_FEATURES], theta[N_FEATURES], theta[N_FEATURES + 1:].reshape(2, 2)
        e = w[flat].sum(axis=1)
        alpha, beta = np.zeros((len(flat), 2)), np.zeros((len(flat), 2))
        alpha[begin] = np.stack([np.zeros(n), s + e[begin]], axis=1)
        for t in range(1, t_max):
            at = begin[:alive[t]] + t
            prev = alpha[at - 1]
            alpha[at, 0] = _log_add(prev[:, 0] + pairs[0, 0], prev[:, 1] + pairs[1, 0])
            alpha[at, 1] = _log_add(prev[:, 0] + pairs[0, 1], prev[:, 1] + pairs[1, 1]) + e[at]
        for t in range(t_max - 2, -1, -1):
            at = begin[:alive[t + 1]] + t
            nxt = beta[at + 1] + np.stack([np.zeros(len(at)), e[at + 1]], axis=1)
            beta[at, 0] = _log_add(pairs[0, 0] + nxt[:, 0], pairs[0, 1] + nxt[:, 1])
            beta[at, 1] = _log_add(pairs[1, 0] + nxt[:, 0], pairs[1, 1] + nxt[:, 1])
        z = _log_add(*alpha[begin + lengths - 1].T)
        p1 = np.exp(alpha[:, 1] + beta[:, 1] - z[seq])
        grad = np.zeros_like(theta)
        grad[:N_FEATURES] = counts_1 - np.bincount(flat.ravel(), weights=np.repeat(p1, flat.shape[1]), minlength=N_FEATURES)
        grad[N_FEATURES] = (y[begin] - p1[begin]).sum()
        at = at_inner
        for a in (0, 1):
            for b in (0, 1):
                p = np.exp(alpha[at - 1, a] + pairs[a, b] + b * e[at] + beta[at, b] - z[seq[at]])
                grad[N_FEATURES + 1 + 2 * a + b] = pair_counts[2 * a + b] - p.sum()
        grad = (grad - l2 * theta) / n
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    t = [float(x) for x in theta]
    return Crf(tuple(t[:N_FEATURES]), t[N_FEATURES], ((t[-4], t[-3]), (t[-2], t[-1])))


def fit_lines(examples: list[tuple[np.ndarray, int]], steps: int = STEPS, l2: float = L2) -> np.ndarray:
    """Feature weights of a logistic model of single lines, each document's lines
    weighing 1 together, from the labels of the documents."""
    flat = np.concatenate([x for x, _ in examples])
    weight = np.concatenate([np.full(len(x), 1 / max(len(x), 1)) for x, _ in examples])
    y = np.concatenate([np.full(len(x), label, dtype=float) for x, label in examples])
    theta, m, v = np.zeros(N_FEATURES), np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for it in range(1, steps + 1):
        p = 1 / (1 + np.exp(-theta[flat].sum(axis=1)))
        grad = np.bincount(flat.ravel(), weights=np.repeat(weight * (y - p), flat.shape[1]), minlength=N_FEATURES)
        grad = (grad - l2 * theta) / len(examples)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    return theta


def share_path(scores: np.ndarray, words: np.ndarray, crf: Crf, label: int) -> np.ndarray:
    """The best label sequence whose share of words on content lines is that of a
    document with this label: all lines' scores shift by as little as it takes."""
    total = max(int(words.sum()), 1)

    def path(shift: float) -> np.ndarray:
        return np.array(viterbi(scores + shift, crf))

    def fits(found: np.ndarray) -> bool:
        return (words[found == 1].sum() >= CONTENT_SHARE * total) == bool(label)

    best = path(0.0)
    if fits(best):
        return best
    low, high, sign = 0.0, 64.0, 1 if label else -1
    best = np.full(len(scores), label)
    for _ in range(12):
        middle = (low + high) / 2
        found = path(sign * middle)
        if fits(found):
            best, high = found, middle
        else:
            low = middle
    return best


def fit_latent(examples: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = ROUNDS) -> Crf:
    """The chain of documents whose lines are not labelled; ``examples``: feature
    codes, words per line, label of the document."""
    if len({y for *_, y in examples}) < 2:
        return Crf()
    weights = fit_lines([(x, y) for x, _, y in examples])
    alone = Crf(start=0.0)
    labels = [share_path(weights[x].sum(axis=1), n, alone, y) for x, n, y in examples]
    crf = None
    for k in range(rounds):
        crf = fit_crf([(x, z) for (x, *_), z in zip(examples, labels, strict=True)], STEPS if crf is None else STEPS // 4, begin_at=crf)
        if k + 1 < rounds:
            new = [share_path(np.asarray(crf.weights)[x].sum(axis=1), n, crf, y) for x, n, y in examples]
            if all((a == b).all() for a, b in zip(labels, new, strict=True)):
                break
            labels = new
    return crf


def labelled_sample(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """(``label_id``, ``label``): at most ``per_class`` doc_ids of each label,
    held-out fold left out, in the order of a keyed hash.  Bounded: safe to broadcast."""
    rows = (labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
            .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
            .groupBy("doc_id").agg(F.max(column).alias("label"))
            .select(F.col("doc_id").alias("label_id"), "label"))
    key = F.xxhash64(F.lit("sample"), F.col("label_id"))
    return F.broadcast(rows.filter("label = 1").orderBy(key, "label_id").limit(per_class)
                       .unionByName(rows.filter("label = 0").orderBy(key, "label_id").limit(per_class)))


def labelled_rows(docs: DataFrame, sample: DataFrame, per_class: int) -> DataFrame:
    """``doc_id, text, label`` of the sampled documents, rows equal in doc_id and text
    once, at most ``per_class`` of each label in the order of a keyed hash: repeated
    doc_ids cannot crowd a class out.  Written once."""
    rows = (docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("label_id"))
            .select("doc_id", "text", F.col("label").cast("int").alias("label"), doc_key().alias("__key")).dropDuplicates(["__key"]))
    first = lambda label: (rows.filter(F.col("label") == label)
                           .orderBy(F.xxhash64(F.lit("row"), "__key"), "__key").limit(per_class).drop("__key"))
    return materialize(first(1).unionByName(first(0)), "examples")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_lines: int = MAX_LINES) -> Crf:
    sample = labelled_sample(labels, "quality", max_docs)

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(label, *analyse(t)[1:]) for t, label in zip(pdf["text"], pdf["label"], strict=True)]
            yield pd.DataFrame({"label": [g[0] for g in got], "lines": [len(g[1]) for g in got],
                                "words": [g[1].astype("<i4").tobytes() for g in got], "codes": [g[2].tobytes() for g in got]})

    rows = (labelled_rows(docs, sample, max_docs).select("text", "label")
            .mapInPandas(codes, "label int, lines int, words binary, codes binary").filter(F.col("lines") <= max_lines)
            .orderBy("label", F.xxhash64("codes"), "codes", "words").collect())  # at most 2 * max_docs
    width = len(EDGES)
    return fit_latent([(np.frombuffer(r["codes"], dtype=np.uint8).reshape(-1, width), np.frombuffer(r["words"], dtype="<i4"),
                        int(r["label"])) for r in rows])


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, content_share double, kept boolean, line_labels array<int>")


def score(docs: DataFrame, crf: Crf) -> DataFrame:
    """Every column of ``docs`` plus the struct ``__quality`` of the result columns."""
    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        got = [verdict(t, crf) for t in texts]
        return pd.DataFrame({k.split()[0]: [g[k.split()[0]] for g in got] for k in RESULT.split(", ")})

    reserve(docs, "__quality")
    return docs.withColumn("__quality", judge(F.coalesce("text", F.lit(""))))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and the result columns of every row."""
    return score(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "__quality.*")


def reject_boilerplate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged."""
    return score(docs, fit(docs, labels)).filter("__quality.kept").drop("__quality")
