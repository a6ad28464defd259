import zlib
from collections import Counter

import numpy as np
import pytest

from scriptmill.llm import toxicity as T


def index_of(counts, labels):
    n_terms = max((t for c in counts for t in c), default=0) + 1
    ix = T.Index({str(i): i for i in range(n_terms)}, np.linspace(1, 3, n_terms), np.arange(len(counts)),
                 np.array(labels, dtype=float), np.ones(len(counts)), base_rate=0.3)
    ix.build(counts)
    return ix


@pytest.mark.parametrize("seed", range(5))
def test_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    make = lambda: Counter({int(t): int(rng.integers(1, 4)) for t in rng.choice(40, rng.integers(0, 9), replace=False)})
    counts = [make() for _ in range(300)] + [Counter({1: 1})] * 5
    ix = index_of(counts, [0] * len(counts))
    for _ in range(30):
        q, k = make(), int(rng.integers(1, 20))
        vec = lambda c: dict(zip(*(x.tolist() for x in ix.vector(c))))
        qv = vec(q)
        sims = [(round(sum(w * vec(c).get(t, 0) for t, w in qv.items()), 12), i) for i, c in enumerate(counts)]
        want = sorted([s for s in sims if s[0] > 0], key=lambda x: (-x[0], x[1]))[:k]
        got = ix.nearest(q, k)
        assert [i for _, i in got] == [i for _, i in want]
        assert np.allclose([s for s, _ in got], [s for s, _ in want])


def test_isotonic_is_the_monotone_least_squares_fit():
    rng = np.random.default_rng(0)
    x, w = rng.integers(0, 6, 40).astype(float), rng.uniform(0.5, 2, 40)
    y = (rng.uniform(size=40) < x / 8).astype(float)
    knots, values = T.isotonic(x, y, w)
    assert (np.diff(values) >= 0).all() and (np.diff(knots) > 0).all()
    fit = np.interp(x, knots, values)
    for level in set(values):  # each level is the weighted mean of its members
        at = fit == level
        assert (w[at] * y[at]).sum() / w[at].sum() == pytest.approx(level)


def test_terms():
    assert T.count_terms("Trash, trash 12 ab") == Counter({"trash": 2, "^tras": 2, "^trash": 2, "ab": 1})
    assert T.count_terms("Trash trashy ab", {"^tras": 0, "ab": 1}) == Counter({0: 2, 1: 1})
    assert T.count_terms(None) == Counter() == T.count_terms("", {"a": 0})


def test_assess(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    data = []
    for i in range(600):
        words = [word() for _ in range(40)]
        if i % 4 == 0:
            words[3], words[17] = "vilestuff", "nastything"
        data.append((i, " ".join(words), "x", 0.5))
    data += [(1000, None, "x", 0.5), (1001, "", "x", 0.5), (None, "vilestuff nastything", "x", 0.5), (4, data[4][1], "x", 0.5),
             (1002, "fine words " * 4000 + "vilestuff nastything", "x", 0.5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)] + [(None, 1, 1), (7, 1, None)],
                                   "doc_id long, quality int, toxic int")
    rows = T.assess(docs, labels).collect()
    assert len(rows) == len(data)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
            if r.doc_id < 600:
                assert r.predicted == (r.doc_id % 4 == 0)
                assert all(e.toxic == 1 and zlib.crc32(str(e.doc_id).encode()) % 3 != 1 for e in r.evidence)
    by = {r.doc_id: r for r in rows}
    assert by[None].predicted == 1 and by[1002].predicted == 1 and by[1000].predicted == by[1001].predicted == 0
    assert {r.score for r in T.assess(docs, labels.limit(0)).collect()} == {0.0}
    assert T.assess(docs.limit(0), labels).count() == 0


def test_repeated_rows_leave_both_classes(spark):
    rng = np.random.default_rng(4)
    make = lambda i: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(20)) + (" vilestuff nastything" if i % 2 else "")
    data = [row for i in range(200) for row in [(i, make(i))] * 2]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    index = T.fit(docs, labels, per_class=50)
    assert index.vocabulary and Counter(index.labels.tolist()) == {0.0: 50, 1.0: 50}
