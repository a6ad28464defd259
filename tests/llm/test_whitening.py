import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptmill.llm import whitening as W


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<float>").repartition(4)


def random_vectors(n=400, d=12, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(3, 0.2, d) @ np.linalg.qr(rng.normal(size=(d, d)))[0]).astype(np.float32)


def whole(vectors):
    return np.floor(1024 * np.asarray(vectors, np.float64)).astype(np.int64) + 100_000


def test_matches_plain_numpy(spark):
    v = random_vectors()
    got = W.whiten(table(spark, [*v, None, [1.0, None] * 6, [float("nan")] * 12, [float("inf")] * 12])).toPandas()
    x = whole(v)
    n = len(x)
    values, vectors = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    white = (x - x.mean(0)) @ vectors[:, :8] / np.sqrt(values[:8])
    assert len(got) == 8 * n and set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    exact = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, x.sum(0))) for i, row in enumerate(x)}
    assert {int(i): int(d) for i, d in zip(got["vec_id"], got["deviation"])} == exact
    for c, part in got.groupby("component"):
        mine = part.sort_values("vec_id")["whitened"].to_numpy()
        sign = np.sign(mine @ white[:, c - 1])
        assert np.abs(sign * mine - white[:, c - 1]).max() < 1e-9
        assert abs(part["explained"].iloc[0] - values[c - 1] / values.sum()) < 1e-12


def residual(a, values, x):
    return float(np.abs(a @ x - x * values).max() / np.abs(a).max()), float(np.abs(x.T @ x - np.eye(x.shape[1])).max())


@pytest.mark.parametrize("spectrum", [
    [9, 5, 3, 1, 0.5, 0.1], [4, 4, 4, 1, 1, 0.2], [1 + 1e-9, 1, 1 - 1e-9, 0.5, 1e-6, 1e-7], [1, 1e-3, 1e-3 + 1e-12, 0, 0, 0], [2, 2, 2, 2, 2, 2]])
def test_refinement_reaches_double_precision(spectrum):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(np.longdouble)
    a = (q * np.array(spectrum, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    rough = np.linalg.eigh(a.astype(np.float32))[1]
    values, x = W.refine(a, rough)
    far, skew = residual(a, values, x)
    assert far < 1e-15 and skew < 1e-15
    assert np.allclose(np.sort(values.astype(float)), np.sort(np.linalg.eigvalsh(a.astype(float))), atol=1e-14)
    assert max(residual(a.astype(float), *np.linalg.eigh(a.astype(np.float32)))) > 1e-9  # what float32 alone leaves


def test_sums_and_products_are_exact(spark):
    x = [[10 ** 9 + i, -(10 ** 9) * i, 7] for i in range(50)]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(x)], "vec_id long, x array<long>").repartition(3)
    n, total = W.sums(rows)
    assert n == 50 and list(total) == [sum(c) for c in zip(*x)]
    centre = np.array([10 ** 9, 0, 0])
    c = [10 ** 9, 0, 0]
    want = [[sum((r[i] - c[i]) * (r[j] - c[j]) for r in x) for j in range(3)] for i in range(3)]
    assert (W.products(rows, centre) == np.array(want, object)).all()


def test_degenerate_tables(spark):
    none = table(spark, [[1.0, 2.0]]).limit(0)
    assert W.whiten(none).count() == 0
    assert W.whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0  # constant: no component has any variance
    line = W.whiten(table(spark, [[float(i), 2.0 * i] for i in range(20)])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 20 and line[0]["explained"] == pytest.approx(1)
    mixed = table(spark, [*random_vectors(40, 6), [1.0], [], None])
    extra = mixed.withColumn("x", F.lit("clash")).withColumn("whitened", F.lit(None))
    assert {r["n"] for r in W.whiten(extra).collect()} == {40}
    twice = mixed.unionByName(mixed).withColumn("vec_id", F.lit(None).cast("long"))
    assert W.whiten(twice).count() == 80 * 6
    with pytest.raises(Exception, match="64 bits"):
        W.whiten(table(spark, [[1e12 * i, 1.0 * i] for i in range(20)])).collect()
    with pytest.raises(Exception, match="(?i)overflow"):  # an entry that is no 64-bit number
        W.whiten(table(spark, [[1e15 * i, 1.0 * i] for i in range(20)])).collect()
