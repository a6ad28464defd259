import random
import re

import pytest

from scriptmill.llm import line_dedup as L


def brute(docs, min_words):
    """Cut every run of lines of min_words words or more that occurs earlier in
    (doc_id, key, line) order; docs in that order, distinct."""
    split = [(t or "").split("\n") if t is not None else [] for _, t in docs]
    words = [[len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in ls] for ls in split]
    seen, out = {}, []
    for d, ls in enumerate(split):
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                if sum(words[d][a:b]) >= min_words:
                    seen.setdefault(tuple(ls[a:b]), (d, a))
    for d, ls in enumerate(split):
        cut = set()
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                if sum(words[d][a:b]) >= min_words and seen[tuple(ls[a:b])] < (d, a):
                    cut |= set(range(a, b))
        out.append("\n".join(x for i, x in enumerate(ls) if i not in cut) if docs[d][1] is not None else None)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    line = ["", " ", "a", "b c", "d e f", "g h i j", "k l m n o p", "q r s t u v w x y z", "a"]
    texts = ["\n".join(rng.choice(line) for _ in range(rng.randint(1, 25))) for _ in range(25)]
    run = "\n".join(rng.choice(line) for _ in range(40))
    texts += ["x1\n" + run + "\nx2", run, "y\n" + run, "", None, "\n\n"]
    docs = [(i if i else None, t) for i, t in enumerate(texts)]
    data = [(i, t, "x", 1) for i, t in docs] + [(7, texts[7], "x", 1)]  # a repeated row
    df = spark.createDataFrame(data, "doc_id long, text string, line string, pos int").repartition(3)
    got = L.dedup_lines(df, 8)
    assert got.columns == [*df.columns, "__runs"]
    rows = got.collect()
    assert len(rows) == len(data)
    want = dict(zip([i for i, _ in docs], brute(docs, 8)))
    for r in rows:
        assert r.text == want[r.doc_id], r.doc_id


def test_hot_line_and_hot_copies(spark):
    common = " ".join(f"w{i}" for i in range(60))
    data = [(i, f"own line {i}\n{common}\ntail {i}") for i in range(300)] + [(1000 + i, f"{common}\nsame doc again") for i in range(200)]
    rows = {r.doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert rows[0] == data[0][1] and rows[5] == "own line 5\ntail 5" and rows[1100] == ""
    assert rows[1000] == "same doc again"


def test_empty_and_unique(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {(r.doc_id, r.text, r["__runs"]) for r in L.dedup_lines(df).collect()} == {(1, "a b", None), (2, None, None)}
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_many_runs_in_one_text_and_reserved_names(spark):
    import pytest
    from pyspark.sql import functions as F

    from scriptmill.llm import line_dedup

    n = 18_000
    block = [" ".join(f"w{i}x{k}" for k in range(10)) for i in range(8)]
    text = "\n".join(x for i in range(n // 9) for x in (block + [f"line {i}"]))  # 2,000 runs, less the first, to cut
    docs = spark.createDataFrame([(1, text), (2, "other text"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).select("doc_id", "text", F.size("__runs").alias("n")).collect()}
    assert got[1].text.split("\n") == block + [f"line {i}" for i in range(n // 9)] and got[1].n == n // 9 - 1
    assert got[2].text == "other text" and got[3].text is None
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs.withColumn("__runs", F.lit(1)))
