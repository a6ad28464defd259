"""Embedding whitening with mixed-precision eigenvectors.

Two passes over the vectors give their exact integer covariance: counts and
sums per dimension, then sums of products of vectors less a whole-number
centre, both added up by task.  What reaches the driver is one matrix of the
embedding's dimension.  Its eigenvectors are first found in float32; Ogita and
Aishima's iteration, matrix products in extended precision, then corrects them
all at once, with the square of the error left after each step.  Eigenvalues
too close to be told apart at a step are one cluster: a small problem solved
inside the cluster's subspace (shifted by its mean, so its digits are not
lost), after which the iteration goes on.

Every entry c becomes x = floor(1024 * c) + 100000.  The result has a row per
vector and component: the vector less the mean, projected on the component,
over the root of its eigenvalue.

Defined results: vectors that are null, or hold null or non-finite entries,
are dropped, and so are vectors whose length is not the commonest one (ties:
the smaller; a vector of no entries never counts).  Components whose eigenvalue
is rounding only (a constant table, fewer vectors than dimensions) are left
out: they cannot be scaled to unit variance.  Signs: a component's largest
entry is positive.  Repeated rows each keep rows, a null vec_id is kept, an
empty table gives an empty result, other columns are ignored; an entry or a
deviation beyond 64 bits raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import materialize

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: rows whose products are added as doubles before they go into whole numbers
CHUNK = 1 << 10


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(fine(c), F.lit(False)))


def to_whole(vector: Column) -> Column:
    """Entries as whole numbers."""
    return F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("long"))


def fit_rows(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of all usable vectors of the commonest length, written."""
    rows = materialize(embeddings.filter(usable(F.col(vector))).select("vec_id", to_whole(F.col(vector)).alias("x")), "whole-vectors")
    commonest = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("x") == (commonest["size"] if commonest else 0))


def _add(totals: dict, key, value) -> None:
    totals[key] = totals[key] + value if key in totals else value


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sum of each dimension."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                fits = max(-int(x.min()), int(x.max())) * len(x) < 1 << 62
                part = (x if fits else x.astype(object)).sum(0).astype(object)
                n, total = n + len(batch), part if total is None else total + part
        if n:
            yield pd.DataFrame({"n": [n], "s": [[str(v) for v in total]]})

    n, total = 0, 0
    for row in rows.select("x").mapInPandas(add, "n long, s array<string>").toLocalIterator():  # a row per task
        n, total = n + row["n"], total + np.array([int(v) for v in row["s"]], object)
    return n, total


def products(rows: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact sum over all vectors of the products of their entries less ``centre``.

    Products are added by BLAS as doubles in chunks short enough to stay below
    2^53, so every sum is a whole number without rounding; larger entries go
    through Python's integers.
    """
    centre = np.asarray(centre, np.int64)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                d = np.stack(batch["x"].to_numpy()[at:at + CHUNK]) - centre
                if int(np.abs(d).max()) ** 2 * len(d) < 1 << 53:
                    d = d.astype(np.float64)
                    part = (d.T @ d).astype(np.int64).astype(object)
                else:
                    d = d.astype(object)
                    part = d.T @ d
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"row": range(len(centre)), "sums": [[str(v) for v in r] for r in total]})

    made = rows.select("x").mapInPandas(add, "row int, sums array<string>")
    # a matrix per task: added up row by row in Spark before anything is gathered
    entry = F.expr("cast(s as decimal(38,0))")
    added = (made.select("row", F.posexplode("sums").alias("col", "s")).groupBy("row", "col").agg(F.sum(entry).alias("s")))
    out = np.zeros((len(centre), len(centre)), object)
    for r in added.collect():  # dimension squared
        out[r["row"], r["col"]] = int(r["s"])
    return out


@dataclass(frozen=True)
class Whitener:
    n: int
    total: np.ndarray  # exact sums per dimension, Python integers
    centre: np.ndarray  # whole numbers near the mean
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors as columns
    trace: float


def covariance(n: int, total: np.ndarray, centre: np.ndarray, prods: np.ndarray) -> np.ndarray:
    """The covariance (divisor n) in extended precision, from whole numbers:
    products about ``centre`` less those of the mean about it."""
    off = total - n * centre  # n times (mean - centre)
    exact = n * prods - np.multiply.outer(off, off)  # n^2 V, whole
    high = np.vectorize(lambda v: np.longdouble(v // n) + np.longdouble(v % n) / n, otypes=[np.longdouble])(exact)
    return high / np.longdouble(n)


def clusters(values: np.ndarray, delta: float) -> list[np.ndarray]:
    """Index groups of eigenvalues that lie no more than ``delta`` apart in a row."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > delta) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refine(a: np.ndarray, x: np.ndarray, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of symmetric ``a`` (extended precision) from
    approximate eigenvectors ``x``, by Ogita and Aishima's iteration."""
    a, x = np.asarray(a, np.longdouble), np.asarray(x, np.longdouble)
    one = np.eye(len(a), dtype=np.longdouble)
    norm = float(np.sqrt((a * a).sum()))
    done = 16 * np.finfo(np.float64).eps ** 2 if np.finfo(np.longdouble).eps < 1e-18 else 4 * np.finfo(np.float64).eps
    best, values = np.inf, None
    for _ in range(steps):
        r, s = one - x.T @ x, x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding must not look like a lack of orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        apart = s - np.diag(values)
        delta = 2 * (float(np.sqrt((apart * apart).sum())) + norm * float(np.sqrt((r * r).sum())))
        groups = clusters(values, delta)
        gap = values[None, :] - values[:, None]
        known = np.abs(gap) > delta
        e = np.where(known, (s + values[None, :] * r) / np.where(known, gap, 1), r / 2)
        np.fill_diagonal(e, np.diag(r) / 2)
        x = x + x @ e
        for g in groups:  # inside a cluster the iteration cannot tell vectors apart: solve the subspace
            shift = values[g].mean()
            sub = x[:, g]
            small = sub.T @ (a @ sub - shift * sub)
            small = (small + small.T) / 2
            size = float(np.abs(small).max())
            if size > 0:
                turn = np.linalg.eigh(np.asarray(small / size, np.float64))[1]
                x[:, g] = sub @ turn.astype(np.longdouble)
        change = float(np.abs(e).max())
        if change <= np.sqrt(done) or (not groups and change >= best / 2):
            break
        best = change if not groups else np.inf
    s, length = x.T @ a @ x, np.sqrt((x * x).sum(0))
    return np.diag(s) / length ** 2, x / length


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The mean and leading components of all rows; nothing for an empty table."""
    n, total = sums(rows)
    if not n:
        return None
    centre = np.array([round(v / n) if abs(v) < 1 << 52 else (2 * v + n) // (2 * n) for v in total], object)
    v = covariance(n, total, centre, products(rows, centre))
    scale = float(np.abs(v).max()) or 1.0
    rough = np.linalg.eigh((v / scale).astype(np.float32))[1]
    values, vectors = refine(v / np.longdouble(scale), rough)
    values = values * np.longdouble(scale)
    trace = np.trace(v)
    order = np.argsort(-values, kind="stable")[:components]
    real = order[values[order] > trace * len(v) * np.finfo(np.float64).eps]
    picked = vectors[:, real]
    sign = np.sign(picked[np.abs(picked).argmax(0), np.arange(picked.shape[1])])
    return Whitener(n, total, centre, values[real].astype(np.float64), (picked * sign).astype(np.float64), float(trace))


def transform(rows: DataFrame, w: Whitener) -> DataFrame:
    """``vec_id, deviation, whitened`` (array, by component) of every row."""
    off = w.total - w.n * w.centre
    shift = np.array([float(v / w.n) for v in off])  # mean less centre
    centre, scale = w.centre.astype(np.int64), w.vectors / np.sqrt(w.values)
    n, rest = w.n, off
    most = (1 << 63) - 1

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            d = np.stack(batch["x"].to_numpy()) - centre
            bound = n * int(np.abs(d).max()) + max(abs(int(v)) for v in rest)
            kind = np.int64 if bound * bound * d.shape[1] <= most else object
            far = n * d.astype(kind) - rest.astype(kind)
            deviation = (far * far).sum(1)
            if kind is object and max(deviation) > most:
                raise OverflowError("a deviation does not fit 64 bits")
            yield pd.DataFrame({"vec_id": batch["vec_id"], "deviation": deviation.astype(np.int64), "whitened": list((d - shift) @ scale)})

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInPandas(apply, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` less the identity,
    centred on its own mean."""
    mean = white.agg(*[F.avg(F.col("whitened")[i]).alias(f"m{i}") for i in range(k)]).first()
    c = [F.col("whitened")[i] - F.lit(mean[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = white.agg(*[F.avg(c[i] * c[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, got))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """A row per usable vector and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    rows = fit_rows(embeddings, vector)
    w = fit(rows, components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if w is None or not len(w.values):
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    white = materialize(transform(rows, w), "whitened")
    error = identity_error(white, len(w.values))
    share = F.array(*[F.lit(float(v / w.trace)) for v in w.values])
    return (white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation",
                    "whitened", share[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))
