"""Comment stripping and top-level block extraction for script text.

Block rules: outside a block, a line whose stripped form matches ``name = {``
(``name`` = a word character then word characters or dots) opens a block; the
brace level is a running sum of ``{`` minus ``}`` per line with quotes ignored;
the block reaches to the first line after which the level is back where it was
before the opener, or to the end of the text.  Lines inside a block open
nothing of their own.

``extract_blocks`` takes a file as a row: its lines are an array, a fold over
those with a brace or a ``#`` gives the spans of the blocks (an opener is looked
for outside of blocks alone), and each block is cut out of the array by
``slice``.  No shuffle, no window, no sort; the fold
appends by blocks of lines, so its cost is linear in a file's lines.  Files above
a row's size are read by lines: see :mod:`.chunks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD, WS, col_of, count_char
from ..sources.lines import fold_array, let

# Strings run from a quote to the next quote (no escapes) or to the end of the
# text; '#' outside a string starts a comment that runs to the end of the line.
COMMENT_RE = r'("[^"]*(?:"|\z))|#[^\n]*'
OPENER_RE = rf"^{WS}*({WORD}[\p{{L}}\p{{N}}_.]*){WS}*={WS}*\{{"


SPAN = "struct<first:int,last:int,above:int>"


def strip_comments(text) -> Column:
    """Remove ``#`` comments outside quoted strings; newlines stay."""
    return F.regexp_replace(col_of(text), COMMENT_RE, "$1")


def line_events(lines: Column) -> Column:
    """``array<struct<at, line, change, hash>>`` of the lines that can change a scan's
    state, those with a brace or a ``#``."""
    numbered = F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    found = F.filter(numbered, lambda x: x["line"].contains("}") | x["line"].contains("{") | x["line"].contains("#"))
    return F.transform(found, lambda x: F.struct(
        x["at"].alias("at"), x["line"].alias("line"), (count_char(x["line"], "{") - count_char(x["line"], "}")).alias("change"),
        (x["line"].contains("#") & x["line"].rlike(rf"^{WS}*#")).alias("hash")))


def block_spans(lines) -> Column:
    """``array<struct<first, last, above>>`` of the blocks in an array of lines:
    0-based first and last line, and the last line before the first that is no
    ``#`` line (-1 if there is none)."""
    none, zero = F.lit(-1), F.lit(0).cast("long")

    def state(first: Column, level: Column, above: Column, start: Column, stop: Column) -> Column:
        # the open block, its level above the opener's; the last run of '#' lines
        return F.struct(first.alias("first"), level.alias("level"), above.alias("above"), start.alias("start"), stop.alias("stop"))

    def step(acc: Column, x: Column) -> Column:
        a, out, at = acc["state"], acc["out"], x["at"]
        start = F.when(x["hash"] & (a["stop"] != at - 1), at).otherwise(a["start"])
        stop = F.when(x["hash"], at).otherwise(a["stop"])
        level = a["level"] + x["change"]
        above = F.when(a["stop"] == at - 1, a["start"]).otherwise(at) - 1
        to = lambda s, out: F.struct(s.alias("state"), out.alias("out"))
        span = lambda first, above: F.concat(out, F.array(F.struct(first.alias("first"), at.alias("last"), above.alias("above"))))
        inside = F.when(level > 0, to(state(a["first"], level, a["above"], start, stop), out)).otherwise(
            to(state(none, zero, none, start, stop), span(a["first"], a["above"])))
        opens = F.when(x["change"] > 0, to(state(at, x["change"], above, a["start"], a["stop"]), out)).otherwise(to(a, span(at, above)))
        # a line's other work is done only where the line can open a block
        return (F.when(a["first"] >= 0, inside).when(x["line"].contains("{") & x["line"].rlike(OPENER_RE), opens)
                .when(x["hash"], to(state(none, zero, none, start, stop), out)).otherwise(acc))

    def spans(lines: Column) -> Column:
        def finish(a: Column) -> Column:
            last = a["state"]
            rest = F.array(F.struct(last["first"].alias("first"), (F.size(lines) - 1).alias("last"), last["above"].alias("above")))
            return F.when(last["first"] >= 0, F.concat(a["out"], rest)).otherwise(a["out"])

        return let(fold_array(line_events(lines), state(none, zero, none, F.lit(-2), F.lit(-2)), step, SPAN), finish)

    return let(col_of(lines), spans)


def extract_blocks(df: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """One row per top-level block of each text.

    Returns ``path, ln, name, code, comment_header, lines`` where ``ln`` is the
    0-based line of the opener, ``code`` the block's lines joined by ``\\n``
    and ``comment_header`` the run of ``#`` lines directly above the opener.
    Any extra columns of ``df`` are not carried; join on ``path`` for them.
    """
    def blocks(lines: Column) -> Column:
        # cut out before the rows are made: a row holds its block, not the file
        return F.transform(block_spans(lines), lambda b: F.struct(
            b["first"].cast("long").alias("ln"), F.slice(lines, b["first"] + 1, b["last"] - b["first"] + 1).alias("body"),
            F.slice(lines, b["above"] + 2, b["first"] - b["above"] - 1).alias("header")))

    return (df.select(F.col(path).alias(path), F.explode(let(F.split(F.col(text), "\n", -1), blocks)).alias("_b"))
            .select(path, "_b.ln", F.regexp_extract(F.col("_b.body")[0], OPENER_RE, 1).alias("name"),
                    F.array_join("_b.body", "\n").alias("code"), F.array_join("_b.header", "\n").alias("comment_header"),
                    F.size("_b.body").cast("long").alias("lines")))


def structured_blocks(scripts: DataFrame, keep_comments: bool = False) -> DataFrame:
    """Blocks of every script below a category directory, with its category.

    ``scripts`` has ``path`` (relative to the game root) and ``text``.  By
    default comments are stripped first, so ``comment_header`` is empty except
    for ``#`` lines inside an open string; ``keep_comments=True`` extracts
    from the raw text (braces inside comments then count).  A file below the
    directories of two categories yields its blocks once per category.
    """
    from .categories import directory_categories, in_category_directory

    # files outside the map skip the block work; the categories depend on the path alone,
    # so they are looked up again behind the blocks instead of joined
    src = scripts.select("path", "text").where(in_category_directory("path"))
    texts = src if keep_comments else src.select("path", strip_comments("text").alias("text"))
    return (extract_blocks(texts).select("*", F.explode(directory_categories("path")).alias("c"))
            .select("name", F.col("c.category").alias("category"), F.col("path").alias("source_file"), "code",
                    "comment_header", "lines", "ln", F.col("c.cat_ord").alias("cat_ord")))
