import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from scriptmill.llm import pipeline_stages as P
from scriptmill.llm import quality
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash_gray import brute_components, brute_fp

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Documents with junk, repeated passages, near copies, benchmark passages and edge rows."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghijklmno"), rng.integers(2, 8)))
    prose = lambda n: ". ".join(" ".join(word() for _ in range(9)).capitalize() for _ in range(n // 9)) + "."
    item, passage = prose(27), " ".join(word() for _ in range(60))
    texts = [prose(120) + "\n" + prose(80) for _ in range(30)]
    texts += [" ".join(word() + "###" for _ in range(80)) for _ in range(20)]
    texts += [t + " extra" for t in texts[:3]] + [texts[4]] * 3
    texts += [prose(90) + "\n" + passage + "\n" + prose(90) for _ in range(3)]
    texts += [prose(90) + "\n" + item + "\n" + prose(90) for _ in range(2)] + ["", None, "too short", "rep rep " * 100]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(None, prose(100), "en", "s", 0), (7, texts[7], "en", "s", 1)]
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, int(i < 30), 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, item


def test_stages_names_and_columns(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup",
                                                      "benchmark_decontamination", "sentencepiece"]


def test_run_matches_brute_force(spark, sf):
    base, item = sf
    docs = [tuple(r) for r in spark.read.parquet(f"{base}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{base}/labels.parquet")
    crf = quality.fit(spark.read.parquet(f"{base}/documents.parquet"), labels)
    left = [(i, t) for i, t, *_ in docs if quality.verdict(t, crf)["kept"]]
    assert {i for i, _ in left} == {*range(30), *range(50, 61), None}
    # distinct documents in order; null doc_id first
    order = sorted(set(left), key=lambda r: (r[0] is not None, r[0] or 0))
    cut = dict(zip(order, brute_lines(order, 50)))
    left = [(i, cut[(i, t)]) for i, t in order]
    comp = brute_components([brute_fp(t) for _, t in left], 4)
    groups = {}
    for row, c in zip(left, comp):
        groups.setdefault(c, []).append(row)
    left = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    words = lambda t: re.findall(r"\w+", t.lower())
    left = [(i, t) for i, t in left if " ".join(words(item)) not in " ".join(words(t))]
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    key = lambda r: (r[0] is not None, r[0] or 0)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.n_ids, r.round_trip)
                  for r in corpus_pipeline.run(spark, base).collect()), key=key)
    assert got == sorted(((i, sp.encode(t), len(sp.encode(t)), True) for i, t in left), key=key)


def test_stages_keep_the_columns_and_take_empty_tables(spark, sf):
    base, _ = sf
    docs = spark.read.parquet(f"{base}/documents.parquet").withColumn("group", docs_extra())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), base)
        assert out.dtypes == docs.dtypes and out.count() == 0, name
    assert P.sentencepiece(spark, docs.limit(0), base).count() == 0


def docs_extra():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_simhash_keeps_one_row_of_each_group(spark):
    t = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(60)) for i in range(3)]
    data = [(5, t[0], "", "", 0), (5, t[1], "", "", 0), (5, t[0], "", "", 0), (None, t[0], "", "", 0), (None, t[2] + " q r s", "", "", 0)]
    docs = spark.createDataFrame(data, COLUMNS)
    left = P.simhash_near_dedup(spark, docs, "")
    codes = [brute_fp(x[1]) for x in data]
    assert left.count() == len(set(brute_components(codes, 4)))
