"""Comments, blocks and entries over chunks of lines, for files of any size.

The rules are those of :mod:`.blocks` and :mod:`.logs`; here no row holds a file.
Each rule is a state machine over lines.  A chunk's effect on the state is a
small summary that does not depend on the state it begins in:

* comments: a function on the scanner's three states (plain, string, comment);
* blocks: the net and the lowest brace level, and the block that a scan
  beginning outside of all blocks leaves open.  Blocks nest, so where the block
  that reaches into a chunk ends, a scan begun at the chunk's first line is
  outside of all blocks too: its later blocks are right as they are, its earlier
  ones lie inside and go;
* entries: the number of delimiter lines.

The summaries of a file are scanned in order, the entering states joined back,
and what crosses chunks (a block, an entry, a comment header) is put together
from one piece per chunk.  All of it is keyed by (path, chunk), so a file of
any size is dealt over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import count_char, py_strip
from ..session import write_once
from ..sources.lines import CHUNK_LINES, chunk_lines, entering_states, fold_array, let
from .blocks import OPENER_RE, SPAN, line_events, strip_comments
from .logs import delimiter_re

PLAIN, STRING, COMMENT = 0, 1, 2
#: what stands before a text that begins in a state
_PREFIX = ("", '"', "#")


# ---- comments

def scan_effect(text: Column) -> Column:
    """What a piece of text does to the comment scanner: the state behind it for
    each state before it (plain, string, comment)."""
    def after(state: int) -> Column:
        whole = F.concat(F.lit(_PREFIX[state]), text)

        def end(bare: Column) -> Column:
            tail = lambda x: F.length(F.substring_index(x, "\n", -1))
            return (F.when(count_char(bare, '"') % 2 == 1, STRING)
                    .when(tail(whole) != tail(bare), COMMENT)  # a comment not yet ended was taken off the last line
                    .otherwise(PLAIN))

        return let(strip_comments(whole), end)

    return F.array(after(PLAIN), after(STRING), after(COMMENT))


def strip_from(text: Column, state: Column) -> Column:
    """A piece of text without its comments, begun in a state."""
    return (F.when(state == STRING, _behind_first(strip_comments(F.concat(F.lit('"'), text))))
            .when(state == COMMENT, strip_comments(F.concat(F.lit("#"), text))).otherwise(strip_comments(text)))


def _behind_first(text: Column) -> Column:
    return F.substring(text, 2, (1 << 31) - 1)


def strip_comment_chunks(chunks: DataFrame) -> DataFrame:
    """``path, chunk, lines`` without comments, strings over any number of chunks.
    The chunks are written once, for their effects and their text."""
    chunks = write_once(chunks, "chunks")
    text = F.array_join("lines", "\n")
    effects = chunks.select("path", "chunk", scan_effect(F.concat(text, F.lit("\n"))).alias("_e"))
    states = entering_states(effects, "_e", F.lit(PLAIN), lambda s, e: F.element_at(e, s + 1), "int")
    return (chunks.join(states, ["path", "chunk"])
            .select("path", "chunk", F.split(strip_from(text, F.col("entering")), "\n", -1).alias("lines")))


# ---- blocks

def _local_scan(lines: Column) -> Column:
    """Blocks of a chunk scanned from outside of all blocks: ``out`` (those that
    end in it) and ``state`` (net and lowest level, the open block, the last run of
    ``#`` lines)."""
    none = F.lit(-1)
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("level"), zero.alias("low"), none.alias("first"), zero.alias("floor"), none.alias("above"),
                     F.lit(-2).alias("start"), F.lit(-2).alias("stop"))

    def step(acc: Column, x: Column) -> Column:
        a, at = acc["state"], x["at"]
        level = a["level"] + x["change"]
        above = F.when(a["stop"] == at - 1, a["start"]).otherwise(at) - 1

        def to(first: Column, floor: Column, above: Column, *done: Column) -> Column:
            state = F.struct(level.alias("level"), F.least(a["low"], level).alias("low"), first.alias("first"), floor.alias("floor"), above.alias("above"),
                             F.when(x["hash"] & (a["stop"] != at - 1), at).otherwise(a["start"]).alias("start"),
                             F.when(x["hash"], at).otherwise(a["stop"]).alias("stop"))
            return F.struct(state.alias("state"), (F.concat(acc["out"], F.array(*done)) if done else acc["out"]).alias("out"))

        span = lambda first, above: F.struct(first.alias("first"), at.alias("last"), above.alias("above"))
        inside = F.when(level > a["floor"], to(a["first"], a["floor"], a["above"])).otherwise(
            to(none, zero, none, span(a["first"], a["above"])))
        opens = F.when(x["change"] > 0, to(at, a["level"], above)).otherwise(to(none, zero, none, span(at, above)))
        return (F.when(a["first"] >= 0, inside).when(x["line"].contains("{") & x["line"].rlike(OPENER_RE), opens)
                .otherwise(to(none, zero, none)))

    return fold_array(line_events(lines), start, step, SPAN)


def _closing_line(lines: Column, level: Column, floor: Column) -> Column:
    """The first line of a chunk behind which the level is at most ``floor`` (-1: none)."""
    start = F.struct(level.alias("level"), F.lit(-1).alias("hit"))
    return F.aggregate(line_events(lines), start, lambda a, x: F.when(a["hit"] >= 0, a).otherwise(F.struct(
        (a["level"] + x["change"]).alias("level"), F.when(a["level"] + x["change"] <= floor, x["at"]).otherwise(-1).alias("hit"))), lambda a: a["hit"])


_STATE = "struct<level:bigint,open:bigint,floor:bigint,plain:bigint>"


def extract_block_chunks(chunks: DataFrame, width: int = CHUNK_LINES) -> DataFrame:
    """``path, ln, name, code, comment_header, lines`` of every top-level block of
    the files that ``chunks`` (of ``width`` lines) make up.

    The scanned chunks and the parts of blocks are written once: each is read
    several times.
    """
    scanned = write_once(chunks.withColumn("_scan", _local_scan(F.col("lines"))), "chunks")
    chunks = scanned.select("path", "chunk", "lines")
    run, n = F.col("_scan.state"), F.size("lines")
    plain = F.when(run["stop"] == n - 1, run["start"]).otherwise(n) - 1  # the last line that is no '#' line
    base = F.col("chunk") * width
    summary = scanned.select("path", "chunk", F.struct(
        F.col("_scan.state.level").alias("net"), F.col("_scan.state.low").alias("low"),
        F.when(F.col("_scan.state.first") >= 0, base + F.col("_scan.state.first")).otherwise(-1).cast("long").alias("open"),
        F.col("_scan.state.floor").alias("floor"),
        F.when(plain >= 0, base + plain).otherwise(-1).cast("long").alias("plain")).alias("_s"))

    def step(a: Column, s: Column) -> Column:
        stays = (a["open"] >= 0) & (a["level"] + s["low"] > a["floor"])
        return F.struct((a["level"] + s["net"]).alias("level"), F.when(stays, a["open"]).otherwise(s["open"]).alias("open"),
                        F.when(stays, a["floor"]).otherwise(a["level"] + s["floor"]).alias("floor"),
                        F.when(s["plain"] >= 0, s["plain"]).otherwise(a["plain"]).alias("plain"))

    outside = F.struct(F.lit(0).alias("level"), F.lit(-1).alias("open"), F.lit(0).alias("floor"), F.lit(-1).alias("plain"))
    entered = scanned.join(entering_states(summary, "_s", outside, step, _STATE), ["path", "chunk"])
    inside = F.col("entering.open") >= 0
    close = F.when(inside, _closing_line(F.col("lines"), F.col("entering.level"), F.col("entering.floor"))).otherwise(-1)
    entered = entered.select("path", "chunk", "lines", "entering", inside.alias("_inside"), close.alias("_close"),
                             F.col("_scan.state").alias("_end"), F.col("_scan.out").alias("_spans"))
    free = ~F.col("_inside") | (F.col("_close") >= 0)  # some line of the chunk is outside of the block it begins in

    def cut(lines: Column, first: Column, n: Column) -> Column:
        return F.array_join(F.slice(lines, first + 1, n), "\n")

    def piece(lines: Column, ln: Column, first: Column, last: Column, above: Column) -> Column:
        """A block, or the part of it that lies in this chunk."""
        name = F.regexp_extract(F.element_at(lines, first + 1), OPENER_RE, 1)
        return F.struct(ln.alias("ln"), name.alias("name"), cut(lines, first, last - first + 1).alias("code"),
                        cut(lines, above + 1, first - above - 1).alias("header"), (above < 0).alias("more"),
                        (last - first + 1).cast("long").alias("lines"))

    lines, size = F.col("lines"), F.size("lines")
    none = F.array().cast("array<struct<ln:bigint,name:string,code:string,header:string,more:boolean,lines:bigint>>")
    whole = F.when(free, F.transform(F.filter("_spans", lambda b: b["first"] > F.col("_close")), lambda b: piece(
        lines, base + b["first"], b["first"], b["last"], b["above"]))).otherwise(none)
    end = F.col("_end")
    opened = F.when(free & (end["first"] > F.col("_close")), F.array(piece(lines, base + end["first"], end["first"], size - 1, end["above"]))
                    ).otherwise(none)
    last = F.when(F.col("_close") >= 0, F.col("_close")).otherwise(size - 1)
    ongoing = F.when(F.col("_inside"), F.array(F.struct(
        F.col("entering.open").alias("ln"), F.lit(None).cast("string").alias("name"), cut(lines, F.lit(0), last + 1).alias("code"),
        F.lit(None).cast("string").alias("header"), F.lit(False).alias("more"), (last + 1).cast("long").alias("lines")))).otherwise(none)
    tag = lambda xs, crosses: F.transform(xs, lambda p: F.struct(F.lit(crosses).alias("crosses"), p.alias("p")))
    parts = write_once(entered.select("path", "chunk", F.col("entering.plain").alias("_plain"),
                                      F.explode(F.concat(tag(ongoing, True), tag(whole, False), tag(opened, True))).alias("_x"))
                       .select("path", "chunk", "_plain", "_x.crosses", "_x.p.*"), "parts")
    cols = ["path", "ln", "name", "code", "header", "more", "_plain", "chunk", "lines"]
    inner = parts.where(~F.col("crosses")).select(*cols)
    crossing = (parts.where("crosses").groupBy("path", "ln").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "name", "code", "header", "more", "_plain"))).alias("_p"), F.sum("lines").alias("lines"))
        .select("path", "ln", F.col("_p")[0]["name"].alias("name"), F.array_join(F.transform("_p", lambda p: p["code"]), "\n").alias("code"),
                F.col("_p")[0]["header"].alias("header"), F.col("_p")[0]["more"].alias("more"), F.col("_p")[0]["_plain"].alias("_plain"),
                F.col("_p")[0]["chunk"].alias("chunk"), "lines"))
    found = inner.unionByName(crossing)
    # headers that begin in an earlier chunk: '#' lines from the last other line on
    start = F.col("_plain") + 1
    reaching = F.col("more") & (start < F.col("chunk") * width)
    wanted = found.where(reaching).select("path", "ln", start.alias("_from"), (F.col("chunk") * width).alias("_to"), "header")
    headers = (cut_lines(chunks, wanted, width).join(wanted.select("path", "ln", "header"), ["path", "ln"])
               .select("path", "ln", F.when(F.col("header") == "", F.col("cut")).otherwise(F.concat_ws("\n", "cut", "header")).alias("_header")))
    return (found.join(headers, ["path", "ln"], "left")
            .select("path", "ln", "name", "code", F.coalesce("_header", "header").alias("comment_header"), "lines"))


def cut_lines(chunks: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``path, ln, cut``: the lines ``_from`` (included) to ``_to`` of each wanted row, joined."""
    places = wanted.select("path", "ln", "_from", "_to", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor((F.col("_to") - 1) / width)))
                           .alias("chunk"))
    first = F.greatest(F.col("_from") - F.col("chunk") * width, F.lit(0))
    stop = F.least(F.col("_to") - F.col("chunk") * width, F.lit(width))
    part = F.array_join(F.slice("lines", (first + 1).cast("int"), (stop - first).cast("int")), "\n")
    return (places.join(chunks, ["path", "chunk"]).select("path", "ln", "chunk", part.alias("part"))
            .groupBy("path", "ln").agg(F.array_sort(F.collect_list(F.struct("chunk", "part"))).alias("_p"))
            .select("path", "ln", F.array_join(F.transform("_p", lambda p: p["part"]), "\n").alias("cut")))


# ---- entries

def split_entry_chunks(chunks: DataFrame, dashes: int, bucket: int = 1 << 16) -> DataFrame:
    """``path, entry_no, entry``: what lies between the delimiter lines of each file."""
    cut = chunks.select("path", "chunk", F.split(F.array_join("lines", "\n"), delimiter_re(dashes), -1).alias("_pieces"))
    delimiters = F.size("_pieces") - 1
    before = Window.partitionBy("path").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a number per chunk
    starts = (cut.select("path", "chunk", delimiters.alias("_n"))
              .select("path", "chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    pieces = (cut.join(starts, ["path", "chunk"]).select("path", "chunk", "_before", delimiters.alias("_n"), F.posexplode("_pieces").alias("_i", "_piece"))
              .select("path", "chunk", (F.col("_before") + F.col("_i")).alias("_no"),
                      ((F.col("_i") == 0) | (F.col("_i") == F.col("_n"))).alias("_edge"), "_piece"))
    inner = pieces.where(~F.col("_edge")).select("path", "_no", py_strip("_piece").alias("entry"))
    # the text before a chunk's first delimiter and behind its last meets that of its neighbours
    edges = (pieces.where("_edge").groupBy("path", "_no").agg(F.array_sort(F.collect_list(F.struct("chunk", "_piece"))).alias("_p"))
             .select("path", "_no", py_strip(F.array_join(F.transform("_p", lambda p: p["_piece"]), "\n")).alias("entry")))
    entries = inner.unionByName(edges).where("entry <> ''").withColumn("_b", F.floor(F.col("_no") / bucket))
    below = Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (entries.groupBy("path", "_b").agg(F.count(F.lit(1)).alias("_n"))
               .select("path", "_b", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_offset")))
    place = F.row_number().over(Window.partitionBy("path", "_b").orderBy("_no"))
    return (entries.join(offsets, ["path", "_b"])
            .select("path", (F.col("_offset") + place).cast("long").alias("entry_no"), "entry"))


def split_entries_by_lines(lines: DataFrame, dashes: int, width: int = CHUNK_LINES) -> DataFrame:
    """:func:`split_entry_chunks` of a table of lines."""
    return split_entry_chunks(chunk_lines(lines, width), dashes)


def extract_blocks_by_lines(lines: DataFrame, keep_comments: bool = False, width: int = CHUNK_LINES) -> DataFrame:
    """:func:`extract_block_chunks` of a table of lines, comments stripped first by default."""
    chunks = chunk_lines(lines, width)
    return extract_block_chunks(chunks if keep_comments else strip_comment_chunks(chunks), width)
