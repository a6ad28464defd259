import hashlib
import math
import random
import re
import zlib

from scriptmill.llm import importance as I

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(docs, target, min_words, percent):
    s, t = [0] * 10_000, [0] * 10_000
    for texts, counts in ((docs, s), (target, t)):
        for _, text in texts:
            for c in plain_features(text)[1]:
                counts[c % 10_000] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        n, sums = plain_features(text)
        w = sum(gain[c % 10_000] for c in sums)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(sums), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return sorted((i, f, w, sc, rank.get(i)) for i, _, f, w, sc in out)


def test_features_match_joined_ngrams():
    for text in ("", "One", "Ünï-cödé x_y 42\x00a", "a b c d", "\x85 é  ", "A" * 10 + " b" * 50):
        assert tuple(map(sorted, (I.features(text.encode())[1], plain_features(text)[1]))) and sorted(
            I.features(text.encode())[1]) == sorted(plain_features(text)[1])
        assert I.features(text.encode())[0] == plain_features(text)[0]


def test_resample_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = ["Alpha", "beta", "Gamma9", "дом", "straße", "x", "42", "delta,eps"]
    docs = [(i, None if i % 17 == 0 else " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    docs[5] = (5, "Alpha beta " * 40_000)  # very long
    docs[6] = (6, "")
    target = [(0, "alpha beta gamma9 дом"), (1, None), (2, "delta eps 42 42 42")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = I.resample(df.withColumn("score", df["doc_id"]).withColumn("rank", df["text"]),
                     spark.createDataFrame(target, "item_id long, text string"), percent=30)
    assert sorted(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got.collect()) == plain(docs, target, 20, 30)


def test_ties_repeats_nulls_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten " * 3
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text), (3, "short")], "doc_id long, text string")
    none = docs.limit(0)
    got = I.resample(docs, none, percent=100).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4] and [r["rank"] for r in got if r["doc_id"] == 3] == [None]
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["score"] for r in ranked] == sorted((r["score"] for r in ranked), reverse=True)
    assert I.resample(none, docs).count() == 0
