import numpy as np
import pytest
import xxhash

from scriptmill.llm import simhash_gray as S


def brute_fp(text, n=4):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(codes, bits):
    comp = list(range(len(codes)))
    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


@pytest.mark.parametrize("text", ["", None, "One", "a b  c", "A b\tc\nd E", "x y z w " * 50, "É a B c d", "　a b"])
def test_fingerprint_is_the_plain_majority_vote(text):
    assert S.fingerprint(text) == brute_fp(text)


@pytest.mark.parametrize("seed,limit", [(0, 4), (1, 4), (2, 0), (3, 9)])
def test_index_finds_every_component(seed, limit):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 7), replace=False)) for b in base for _ in range(12)]
    codes = np.array(sorted(set(codes)), dtype=np.uint64)
    codes = codes[np.argsort(S.gray_rank(codes))]
    got = S.GrayIndex(codes, np.zeros(len(codes), dtype=np.int64), limit).connected()
    assert got.tolist() == brute_components([int(c) for c in codes], limit)


def test_groups_are_searched_apart():
    codes = np.array([1, 3, 1, 3], dtype=np.uint64)
    got = S.GrayIndex(codes, np.array([0, 0, 1, 1]), 4).connected()
    assert got.tolist() == [0, 0, 2, 2]


@pytest.mark.parametrize("group_limit", [100_000, 5])
def test_near_duplicates_match_brute_force(spark, group_limit):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(15):
        base = list(rng.choice(words, 120))
        for _ in range(5):
            t = list(base)
            for _ in range(rng.integers(0, 3)):
                t[rng.integers(0, len(t))] = "zz"
            rows.append(" ".join(t))
    rows += ["", None, "   ", rows[0], rows[0].upper()]
    data = [(i * 7 % 101, t, i, "x") for i, t in enumerate(rows)] + [(3, rows[2], 0, "x"), (None, rows[4], 0, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp int, component_id string")
    got = S.near_duplicates(docs, group_limit=group_limit).select(
        "doc_id", S.fingerprint_hex().alias("f"), "component_id").collect()
    codes = [brute_fp(t) for _, t, _, _ in data]
    comp = brute_components(codes, 4)
    small = {}
    for (i, *_), c in zip(data, comp):
        if i is not None:
            small[c] = min(small.get(c, i), i)
    want = [(i, f"{f:016x}", small[c]) for (i, *_), f, c in zip(data, codes, comp)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
