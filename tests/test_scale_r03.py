"""Work that must be done once, however large the tables are."""

from pyspark.sql import functions as F

from scriptmill.fixed import CATEGORY_DIRS
from scriptmill.operators import blocks as B
from scriptmill.operators.categories import directory_categories, in_category_directory
from scriptmill.operators.chunks import extract_blocks_by_lines
from scriptmill.sources.lines import text_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocks_by_lines_reads_its_lines_once(spark):
    df = spark.createDataFrame([("f", "# h\na = {\n}\nb = { }")], "path string, text string")
    for keep in (True, False):
        found = extract_blocks_by_lines(text_lines(df), keep_comments=keep, width=2)
        assert "posexplode" not in _plan(found)  # the plan begins at what was written
        assert {(r.ln, r.name, r.comment_header) for r in found.collect()} == {(1, "a", "# h" if keep else ""), (3, "b", "")}


def test_block_fold_takes_lines_with_braces_alone(spark):
    text = "plain\n# h\n#\nx = { y }\nz\nq = {\n w\n}\ntail"
    df = spark.createDataFrame([(text,)], "text string").withColumn("lines", F.split("text", "\n", -1))
    r = df.select(F.size(B.line_events(F.col("lines"))).alias("n"), B.block_spans("lines").alias("s")).first()
    assert r.n == 5
    assert [tuple(x) for x in r.s] == [(3, 3, 0), (5, 7, 4)]


def test_category_directories_by_depth(spark):
    dirs = sorted({d for _, _, d in CATEGORY_DIRS})
    paths = [f"{d}/x.txt" for d in dirs] + [f"{d}/sub/x.txt" for d in dirs] + dirs + [f"{d}x/y.txt" for d in dirs] + ["", "a", "/", "a/b.txt", None]

    def plain(p):
        parts = p.split("/")
        above = ["/".join(parts[:i]) for i in range(1, len(parts))] or [p]
        return sorted((o, c) for o, c, d in CATEGORY_DIRS if d in above)

    df = spark.createDataFrame([(p,) for p in paths], "path string")
    for r in df.select("path", directory_categories("path").alias("c"), in_category_directory("path").alias("k")).collect():
        if r.path is not None:
            assert [tuple(x) for x in r.c] == plain(r.path)
            assert r.k == bool(r.c)


def test_category_filter_builds_no_map(spark):
    df = spark.createDataFrame([("events/a.txt", "a = {\n}")], "path string, text string")
    plan = _plan(B.structured_blocks(df))
    assert "INSET" in plan and "map(" not in plan and "keys: [" not in plan
