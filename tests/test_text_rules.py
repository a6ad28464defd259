from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptmill.functions.text import decode_text, line_count, py_strip
from scriptmill.operators.blocks import extract_blocks, strip_comments
from tests import plain

STRIP_CASES = [
    ("a = 1 # x\nb", "a = 1 \nb"),
    ('s = "a # b" # c', 's = "a # b" '),
    ('# say "hi\nk = "v"', '\nk = "v"'),
    ('s = "open\n# kept', 's = "open\n# kept'),
    ('s = "a\\" # b"', 's = "a\\" '),
    ("", ""),
]

BLOCK_CASES = [
    ("a = {\n x = 1\n}", [(0, "a", "a = {\n x = 1\n}", "")]),
    ("a = { x = 1 }", [(0, "a", "a = { x = 1 }", "")]),
    ("a = {\n} else = {\n}", [(0, "a", "a = {\n} else = {\n}", "")]),
    ("a = {\n b = {", [(0, "a", "a = {\n b = {", "")]),
    ("scope:x = {\n b = {\n }\n}", [(1, "b", " b = {\n }", "")]),
    ("a =\n{\n}", []),
    ("a = { } }\nb = {}", [(0, "a", "a = { } }", ""), (1, "b", "b = {}", "")]),
    ("}\na = {\n}", [(1, "a", "a = {\n}", "")]),
    ("é.1 = {\n}", [(0, "é.1", "é.1 = {\n}", "")]),
    ("# one\n  # two\na = {\n}", [(2, "a", "a = {\n}", "# one\n  # two")]),
    ("# one\n\na = {\n}", [(2, "a", "a = {\n}", "")]),
]


def test_strip_comments_edge_rows(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(STRIP_CASES)], "i int, t string")
    got = dict(df.select("i", strip_comments("t").alias("o")).collect())
    for i, (_, want) in enumerate(STRIP_CASES):
        assert got[i] == want


def _blocks(spark, texts):
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")
    out = {}
    for r in extract_blocks(df).collect():
        out.setdefault(r.path, []).append((r.ln, r.name, r.code, r.comment_header))
    return [sorted(out.get(f"f{i}", [])) for i in range(len(texts))]


def test_block_edge_rows(spark):
    got = _blocks(spark, [t for t, _ in BLOCK_CASES])
    for (text, want), g in zip(BLOCK_CASES, got):
        assert g == want, text


ALPHABET = st.sampled_from(["a", "b.c", " ", "\t", "=", "{", "}", "\n", "#", '"', "x = {", "} }", "é", " "])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=1, max_size=20))
def test_blocks_match_plain_scanner(spark, texts):
    got = _blocks(spark, texts)
    for t, g in zip(texts, got):
        assert g == plain.blocks(t)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=1, max_size=20))
def test_strip_matches_plain_scanner(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(df.select("i", strip_comments("t").alias("o")).collect())
    for i, t in enumerate(texts):
        assert got[i] == plain.strip_comments(t)


def test_decode_bom_crlf_and_bad_bytes(spark):
    raw = bytes([0xEF, 0xBB, 0xBF, 0x6B, 0x0D, 0x0A, 0xFF, 0x0D, 0x7D])
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(decode_text("b")).first()[0] == raw.decode("utf-8-sig", errors="replace").replace("\r\n", "\n").replace("\r", "\n")


def test_strip_and_line_count_unicode_whitespace(spark):
    texts = ["  a b \n", "\x1c x \x85", "", "a\nb\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(py_strip("t").alias("s"), line_count("t").alias("n")).collect()
    assert [r.s for r in got] == [t.strip() for t in texts]
    assert [r.n for r in got] == [t.count("\n") + 1 for t in texts]


def test_block_extraction_is_one_shuffle(spark):
    df = spark.createDataFrame([("f", "a = {\n}")], "path string, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = extract_blocks(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange" not in plan and "Window" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
