"""Split scans against the plain scanners: every cut, every chunk width."""

import random

import pytest
from pyspark.sql import functions as F

from scriptmill.operators import chunks as C
from scriptmill.operators import logs
from scriptmill.sources import lines as L
from tests import plain

PIECES = ["a = {", "}", "{", "x = { y }", "# c {", "#", "", '"', ' s = "a # b', "b.c = { # {", "} else = {", "\t", "plain", "  # h", "k = { }", "----", " -----x", "e: f"]


def texts(seed, n, most):
    rng = random.Random(seed)
    return ["\n".join(rng.choice(PIECES) for _ in range(rng.randrange(most))) for _ in range(n)]


def frame(spark, found):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(found)], "path string, text string")


def test_comment_effect_at_every_cut(spark):
    found = ['a "b # c" # d\n"e\n# f" g # "h\n"', '#"\n"#', '"""#"\n#', "", "\n", 'x # "y"\n z "'] + [t[:14] for t in texts(2, 12, 6)]
    cuts = [(t, t[:i], t[i:j], t[j:]) for t in found for i in range(len(t) + 1) for j in range(i, len(t) + 1)]
    df = spark.createDataFrame(cuts, "text string, a string, b string, c string").repartition(4)
    s = F.element_at(C.scan_effect(F.col("a")), F.lit(1))
    df = df.withColumn("s", s).withColumn("t", F.element_at(C.scan_effect(F.col("b")), F.col("s") + 1))
    joined = F.concat(C.strip_from(F.col("a"), F.lit(C.PLAIN)), C.strip_from(F.col("b"), F.col("s")), C.strip_from(F.col("c"), F.col("t")))
    for r in df.select("text", joined.alias("x")).distinct().collect():
        assert r.x == plain.strip_comments(r.text)


@pytest.mark.parametrize("width", [1, 2, 5, 1024])
def test_blocks_match_plain_scanner(spark, width):
    found = texts(width, 50, 40) + ["a = {\n" + "x\n" * 20 + "}\n# h\n# i\nb = { }", "# a\n" * 9 + "b = {", "", "}\n}\na = {\n}\n}\nb = {\n{\n}", "#\n#\n#\n#"]
    lines = L.text_lines(frame(spark, found))
    got = {}
    for r in C.extract_blocks_by_lines(lines, keep_comments=True, width=width).collect():
        got.setdefault(r.path, []).append((r.ln, r.name, r.code, r.comment_header))
        assert r.lines == r.code.count("\n") + 1
    assert {p: sorted(b) for p, b in got.items()} == {f"f{i}": plain.blocks(t) for i, t in enumerate(found) if plain.blocks(t)}


@pytest.mark.parametrize("width", [1, 3, 1024])
def test_stripped_blocks_match_plain_scanner(spark, width):
    found = texts(width + 70, 50, 30) + ['a = { "\n' * 5 + "# no\n}", '"' + "\n# x" * 9 + '"\nb = {\n# y {\n}']
    got = {}
    for r in C.extract_blocks_by_lines(L.text_lines(frame(spark, found)), width=width).collect():
        got.setdefault(r.path, []).append((r.ln, r.name, r.code, r.comment_header))
    bare = [plain.strip_comments(t) for t in found]
    assert {p: sorted(b) for p, b in got.items()} == {f"f{i}": plain.blocks(t) for i, t in enumerate(bare) if plain.blocks(t)}


@pytest.mark.parametrize("width", [1, 4, 1024])
def test_entries_match_plain_scanner(spark, width):
    found = texts(width + 9, 40, 40) + ["", "----", "a\n" * 30, "----\n" * 9, "a\n ----\n\n----- b\nc"]
    lines = L.text_lines(frame(spark, found))
    for dashes in (4, 5):
        got = {}
        for r in C.split_entries_by_lines(lines, dashes, width).collect():
            got.setdefault(r.path, []).append((r.entry_no, r.entry))
        for i, t in enumerate(found):
            want = plain.split_entries(t, dashes)
            assert sorted(got.get(f"f{i}", [])) == list(enumerate(want, 1))


def test_scanned_lines_of_split_files(spark, tmp_path):
    """Small byte ranges, CR and CRLF, marks and bad bytes: as decoding the whole file."""
    rng = random.Random(4)
    files = {"a.txt": "﻿one\r\ntwo\rthree\n\n".encode() + b"bad \xff\xc3 x\n" + "ü".encode() * 40 + b"\nlast",
             "b/c.txt": b"\n".join(rng.choice([b"x" * 30, b"", b"\xef\xbb\xbfmark", "жук".encode(), b"\xe4\xb8"]) for _ in range(200)),
             "empty.txt": b"", "d.log": b"not read"}
    for name, raw in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(raw)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        df = L.scan_lines(spark, str(tmp_path), str(tmp_path), "*.txt")
        assert spark.read.option("recursiveFileLookup", "true").text(str(tmp_path)).rdd.getNumPartitions() > 8
        got = {}
        for r in df.collect():
            got.setdefault(r.path, []).append((r.ln, r.line))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name in ("a.txt", "b/c.txt"):
        want = files[name].decode("utf-8-sig", "replace").replace("\r\n", "\n").replace("\r", "\n").split("\n")
        assert sorted(got[name]) == list(enumerate(want if want[-1] else want[:-1]))
    assert set(got) == {"a.txt", "b/c.txt"}
    assert L.scan_lines(spark, str(tmp_path / "none"), str(tmp_path)).count() == 0


def test_a_log_in_splits_gives_the_entries_of_the_whole(spark, tmp_path):
    rng = random.Random(8)
    text = "\n".join(rng.choice(["----", "-----", "name - text", "x" * 50, ""]) for _ in range(4000))
    (tmp_path / "big.log").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = C.split_entries_by_lines(L.scan_lines(spark, str(tmp_path), str(tmp_path), "*.log"), 4, 64).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.entry_no, r.entry) for r in got) == list(enumerate(plain.split_entries(text, 4), 1))
    whole = logs.split_entries(spark.createDataFrame([("big.log", text)], "file string, text string"), 4)
    assert sorted((r.entry_no, r.entry) for r in got) == sorted((r.entry_no, r.entry) for r in whole.collect())
