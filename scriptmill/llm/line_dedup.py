"""Line dedup: a suffix array over line-id sequences by distributed prefix
doubling; repeated line runs are the array's longest-common-prefix intervals.

Every text is a sequence of lines, each named by a 128-bit hash.  Doubling
sorts the suffixes by their first 1, 2, 4, ... lines: the rank at one step is
the number of suffixes that sort before, found from the pair of ranks half as
deep.  Suffixes whose rank no other shares repeat nothing further and leave;
what is left at depth h are the intervals of the suffix array whose longest
common prefix is at least h lines, each interval one rank.

A run is removed where it repeats an earlier one (smaller doc_id, then text
hash, then line) and has at least ``min_words`` words.  For every place the
shortest run of that many words beginning there, and the shortest one ending
there, are looked up: a run of m lines is named by the ranks at depth
2^floor(log2 m) of its first and of its last such stretch, so one grouping
tells whether it lies in an interval with an earlier member.  Their union is
the union of all maximal repeated runs of ``min_words`` words or more.

Only DataFrame functions are used.  Lines that occur once are dropped after
the first count, with partial aggregation before the shuffle; a line or run
with very many copies is a key that aggregates to one row, and joins back to
its members can be split.

Defined results: null text counts as empty and stays null; lines are split at
``\\n`` alone; an empty text is one empty line; rows equal in doc_id and text
are one document and get the same result; runs inside one document count too;
a document that is all repeats keeps an empty text; a null doc_id sorts first; an
empty table gives an empty result; very long texts are split whole, their lines
met with their runs in one pass; columns named ``__...`` are reserved and raise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.llm.common import WORD_RE, doc_key, materialize, reserve, running_total
from scriptmill.sources.lines import let

MIN_WORDS = 50


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc, pos, line`` (hash) and ``n_words`` of every line that occurs more than once."""
    lines = (docs.filter("text is not null")
             .select(doc_key().alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
             .select("doc", "pos",
                     F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit("line"), "text").alias("b")).alias("line"),
                     F.regexp_count("text", F.lit(WORD_RE)).alias("n_words")))
    lines = materialize(lines, "lines")
    # written, so that the join below has a shuffle of its own whose hot lines can be split
    often = materialize(lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("line"), "often")
    return materialize(lines.join(often, "line").dropDuplicates(["doc", "pos"]), "lines")


def word_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``doc, start, stop``: within each stretch of neighbouring repeated lines,
    the shortest runs of at least ``min_words`` words that begin, or that end,
    at a line."""
    stretch = (lines.withColumn("stretch", F.col("pos") - F.row_number().over(Window.partitionBy("doc").orderBy("pos")))
               .withColumn("upto", F.sum("n_words").over(Window.partitionBy("doc", "stretch").orderBy("pos")))
               .withColumn("last", F.lead("pos").over(Window.partitionBy("doc", "stretch").orderBy("pos")).isNull()))
    # a border before each line and one after the last, with the words before it
    here = F.struct(F.col("pos").alias("at"), (F.col("upto") - F.col("n_words")).alias("words"))
    after = F.struct((F.col("pos") + 1).alias("at"), F.col("upto").alias("words"))
    borders = (stretch.select("doc", "stretch", F.explode(F.when(F.col("last"), F.array(here, after)).otherwise(F.array(here))).alias("b"))
               .select("doc", "stretch", "b.at", "b.words"))
    # running frames both: of the borders at least min_words further on the nearest, and of those before
    part = Window.partitionBy("doc", "stretch")
    further = part.orderBy(F.desc("words")).rangeBetween(Window.unboundedPreceding, -min_words)
    before = part.orderBy("words").rangeBetween(Window.unboundedPreceding, -min_words)
    found = borders.withColumn("stop", F.min("at").over(further)).withColumn("start", F.max("at").over(before))
    return (found.filter("stop is not null").select("doc", F.col("at").alias("start"), "stop")
            .unionByName(found.filter("start is not null").select("doc", "start", F.col("at").alias("stop"))).distinct())


def suffix_ranks(lines: DataFrame, longest: int) -> DataFrame:
    """``level, doc, pos, rank``: for depths 2^level up to ``longest`` lines, the
    suffixes that share their rank with others (an interval of two or more)."""
    pairs = lines.select("doc", "pos", F.col("line").alias("one"), F.lit(0).cast("long").alias("two"))
    levels, level = [], 0
    while True:
        classes = pairs.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"))
        ranked = running_total(classes, ["one", "two"], "n", "rank", "ranks").filter("n > 1").select("one", "two", "rank")
        held = materialize(pairs.join(ranked, ["one", "two"]).select("doc", "pos", "rank"), "suffixes")
        levels.append(held.select(F.lit(level).alias("level"), "doc", "pos", "rank"))
        if 2 << level > longest or not held.limit(1).count():
            return reduce(DataFrame.unionByName, levels)
        ahead = held.select("doc", (F.col("pos") - (1 << level)).alias("pos"), F.col("rank").alias("two"))
        pairs = held.withColumnRenamed("rank", "one").join(ahead, ["doc", "pos"])
        level += 1


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc, runs``: per document the maximal runs of lines (``start``, ``stop``)
    that repeat earlier ones."""
    lines = repeated_lines(docs)
    runs = materialize(word_runs(lines, min_words).withColumn("m", F.col("stop") - F.col("start"))
                       .withColumn("level", F.floor(F.log2("m")).cast("int")), "runs")
    ranks = suffix_ranks(lines, runs.agg(F.max("m")).first()[0] or 1)
    head = ranks.select("level", "doc", F.col("pos").alias("start"), F.col("rank").alias("head"))
    tail = ranks.select("level", "doc", F.col("pos").alias("tail_at"), F.col("rank").alias("tail"))
    named = materialize(runs.withColumn("tail_at", (F.col("stop") - F.expr("shiftleft(1, level)")).cast("int"))
                        .join(head, ["level", "doc", "start"]).join(tail, ["level", "doc", "tail_at"])
                        .select("doc", "start", "stop", "m", "head", "tail"), "named")
    place = F.struct("doc", "start")
    interval = materialize(named.groupBy("m", "head", "tail").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                           .filter("n > 1"), "intervals")
    later = named.join(interval, ["m", "head", "tail"]).filter(place > F.col("first")).select("doc", "start", "stop")
    # overlapping and touching runs grow together into maximal ones
    by_start = Window.partitionBy("doc").orderBy("start", "stop")
    joined = (later.withColumn("reach", F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("group", F.sum(F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)).over(by_start)))
    return (joined.groupBy("doc", "group").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` with the repeated runs cut out of ``text``, plus
    ``__runs`` (those runs, null if none)."""
    reserve(docs)
    runs = materialize(repeated_runs(docs, min_words), "repeats").select(F.col("doc").alias("__doc"), F.col("runs").alias("__runs"))

    def between(lines: Column) -> Column:
        """The lines outside of the runs: runs are apart and in order, so one slice before each and one behind the last."""
        def gap(i: Column) -> Column:
            start = F.when(i > 0, F.get("__runs", i - 1)["stop"]).otherwise(F.lit(0))
            stop = F.when(i < F.size("__runs"), F.get("__runs", i)["start"]).otherwise(F.size(lines))
            return F.slice(lines, start + 1, stop - start)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size("__runs")), lambda i: gap(i)))

    kept = let(F.split("text", "\n", -1), between)
    # the runs grow with the documents: merged at every size, never broadcast
    return (docs.withColumn("__key", doc_key()).join(runs.hint("merge"), F.col("__key") == F.col("__doc"), "left")
            .withColumn("text", F.when(F.col("__runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
            .drop("__key", "__doc"))
