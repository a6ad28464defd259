import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest

from scriptmill.llm import sharding as S


def brute_capacity(sizes, k):
    best = sum(sizes)
    for cuts in itertools.combinations_with_replacement(range(len(sizes) + 1), k - 1):
        edges = [0, *cuts, len(sizes)]
        best = min(best, max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])))
    return best


@pytest.mark.parametrize("seed", range(8))
def test_cuts_are_minimax(seed):
    rng = np.random.default_rng(seed)
    sizes, k = rng.integers(1, 30, rng.integers(1, 9)), int(rng.integers(1, 5))
    cuts = S.minimax_cuts(sizes, [0] * k)
    edges = [0, *cuts]
    assert max(sizes[a:b].sum() for a, b in zip(edges, edges[1:])) == brute_capacity(sizes.tolist(), k)


def test_a_group_above_the_ideal_shard_leaves_the_rest_even():
    rng = np.random.default_rng(1)
    size = np.concatenate(([60_000, 30_000], rng.integers(1, 20, 20_000)))
    placed, firsts = S.assign_atoms(np.arange(len(size)), size, 8)
    load = [0] * 8
    for a, n in enumerate(size.tolist()):
        load[placed[a] if a in placed else sum(a >= f for f in firsts)] += n
    rest = sorted(load)[:-1]
    assert max(load) == 60_000 and max(rest) - min(rest) < 200


def test_rows(spark):
    data = [(i % 50, f"text {i % 97} ü" * (i % 7), "x", i) for i in range(3000)]
    data += [(1, "copy", "x", 0)] * 500 + [(None, None, "x", 0), (2, None, "x", 0), (3, "", None, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, shard string, atom int")
    rows = S.shard_rows(docs, shards=5).collect()
    assert len(rows) == len(data)
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in data)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"], r.text_crc32) for r in rows) == want
    slots, of_text, load = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
        if r["size"] > 16:
            of_text[r.text_crc32].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(5))
    assert all(len(v) == 1 for v in of_text.values())
    assert max(load.values()) < 1.2 * sum(load.values()) / 5
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_empty_table(spark):
    assert S.shard_rows(spark.createDataFrame([], "doc_id long, text string")).count() == 0
