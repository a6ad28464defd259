"""Text files as numbered lines and as chunks of lines, read split by split.

Spark's text source reads a file in byte ranges that begin and end at line
breaks, so a file of any size is many rows in many tasks.  A line's number
needs no sort: rows of a split are consecutive, so its place in the split is its
row id less the split's first one, and the lines of the splits before it are a
sum over one small row per split.

Lines become chunks of ``width`` lines with one shuffle.  Operators that need
what lies before a line (an open string, an open block, an entry begun in an
earlier chunk) make a small summary of each chunk, scan a file's summaries in
order, and hand every chunk the state it begins in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import col_of, relative_path
from .files import SCRIPT_GLOB, path_exists, qualified

CHUNK_LINES = 1024


def scan_lines(spark: SparkSession, dirs: list[str] | str, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """``path`` (below ``root``), ``ln`` (from 0) and ``line`` of all files below
    the directories that exist.

    Decoded as whole files are: bad bytes become U+FFFD, one byte-order mark at
    offset 0 goes, ``\\r\\n``, ``\\r`` and ``\\n`` end a line.  A line break at the
    end of a file makes no empty line behind it.
    """
    found = [d for d in ([dirs] if isinstance(dirs, str) else dirs) if path_exists(spark, d)]
    if not found:
        return spark.createDataFrame([], "path string, ln long, line string")
    raw = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
           .option("ignoreMissingFiles", "true").text(found)
           .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_id"), "value"))
    splits = raw.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ln = F.col("_before") + F.col("_id") - F.col("_first")
    line = F.make_valid_utf8("value")
    return (raw.join(starts, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
            .select(relative_path("_file", qualified(spark, root)).alias("path"), ln.alias("ln"),
                    F.when(ln == 0, F.regexp_replace(line, "^﻿", "")).otherwise(line).alias("line")))


def scan_localization_lines(spark: SparkSession, root: str, lang: str = "english", glob: str = "*.yml") -> DataFrame:
    """The lines of ``localization/<lang>/**/*.yml``: what ``parse_loc`` takes."""
    root = root.rstrip("/")
    return scan_lines(spark, f"{root}/localization/{lang}", root, glob)


def scan_script_lines(spark: SparkSession, root: str, subdirs: list[str] | None = None, glob: str = SCRIPT_GLOB) -> DataFrame:
    """The lines of every script file below ``root`` (or the given subdirectories of it)."""
    root = root.rstrip("/")
    return scan_lines(spark, [f"{root}/{d}" for d in subdirs] if subdirs else root, root, glob)


def text_lines(texts: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``path, ln, line`` of texts held whole in a column."""
    return texts.select(F.col(path).alias("path"), F.posexplode(F.split(text, "\n", -1)).alias("ln", "line")).select(
        "path", F.col("ln").cast("long").alias("ln"), "line")


def chunk_lines(lines: DataFrame, width: int = CHUNK_LINES) -> DataFrame:
    """``path, chunk, lines``: runs of ``width`` lines in order.

    The rows move once, as they are, and are grouped by a number first: paths that
    begin alike are slow to sort.
    """
    sorted_lines = F.array_sort(F.collect_list(F.struct("ln", "line")))
    placed = lines.select("path", F.floor(F.col("ln") / width).alias("chunk"), "ln", "line")
    return (placed.withColumn("_k", F.xxhash64("path", "chunk")).repartition("_k").groupBy("_k", "path", "chunk")
            .agg(F.transform(sorted_lines, lambda x: x["line"]).alias("lines")).drop("_k"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_array(xs, start: Column, step: Callable[[Column, Column], Column], kind: str, block: int = 512) -> Column:
    """Fold an array from ``start``; ``step(acc, x)`` gives the next struct of
    ``state`` and ``out`` (items of ``kind``, appended to).

    Appending copies what was appended before, so the fold goes by blocks whose
    results are arrays of their own: linear for any length in practice.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")
    nested = F.expr(f"cast(array() as array<array<{kind}>>)")

    def fold(xs: Column) -> Column:
        def outer(acc: Column, i: Column) -> Column:
            done = F.aggregate(F.slice(xs, i, block), F.struct(acc["state"].alias("state"), none.alias("out")), step)
            return let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        begin = lambda out: F.struct(start.alias("state"), out.alias("out"))
        long = F.aggregate(F.sequence(F.lit(1), F.size(xs), F.lit(block)), begin(nested), outer,
                           lambda a: F.struct(a["state"].alias("state"), F.flatten(a["out"]).alias("out")))
        return F.when(F.size(xs) <= block, F.aggregate(xs, begin(none), step)).otherwise(long)

    return let(col_of(xs), fold)


def fold_append(xs, start: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]], kind: str, block: int = 512) -> Column:
    """:func:`fold_array` where ``step(state, x)`` gives the next state, whether
    to append, and the item (of ``kind``) to append."""
    def inner(acc: Column, x: Column) -> Column:
        state, appends, item = step(acc["state"], x)
        return F.struct(state.alias("state"), F.when(appends, F.concat(acc["out"], F.array(item))).otherwise(acc["out"]).alias("out"))

    return fold_array(xs, start, inner, kind, block)


def entering_states(summaries: DataFrame, summary: str, start: Column, step: Callable[[Column, Column], Column], kind: str) -> DataFrame:
    """``path, chunk, entering``: the state (of type ``kind``) before each chunk,
    from one summary per chunk.  A file's summaries are one row of numbers."""
    ordered = summaries.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("chunk", F.col(summary).alias("s")))).alias("_xs"))

    def one(state: Column, x: Column) -> tuple[Column, Column, Column]:
        return step(state, x["s"]), F.lit(True), F.struct(x["chunk"].alias("chunk"), state.alias("entering"))

    scanned = fold_append("_xs", start.cast(kind), one, f"struct<chunk:bigint,entering:{kind}>")["out"]
    return ordered.select("path", F.explode(scanned).alias("_s")).select("path", "_s.chunk", "_s.entering")
