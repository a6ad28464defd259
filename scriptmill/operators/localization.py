"""Localization files: entries, last-key-wins map, descriptions, key groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DESC_SUFFIXES, LOC_HEADER, LOC_INSTRUCTION, SYSTEM_LOCALIZATION
from ..functions.hashing import keyed_hash
from ..functions.text import DIGIT, DOT, WORD, WS, col_of, py_strip

# A stripped line ``key:<digits> "value"``; the value runs to the last quote.
LOC_RE = rf'^{WS}*({WORD}+):{DIGIT}*{WS}+"({DOT}+)"'


def parse_loc(lines: DataFrame, line: str = "line") -> DataFrame:
    """Matching lines with their ``key`` and ``value``; others dropped."""
    return (lines.withColumn("key", F.regexp_extract(line, LOC_RE, 1))
                 .withColumn("value", F.regexp_extract(line, LOC_RE, 2))
                 .where(F.col("key") != ""))


def latest_loc(entries: DataFrame) -> DataFrame:
    """One value per key: the last one in (path, line) order wins."""
    return entries.groupBy("key").agg(F.max_by("value", F.struct("path", "ln")).alias("value"))


def clean_description(value) -> Column:
    """Drop ``#x`` format codes and ``[...]`` script calls, then strip."""
    v = F.regexp_replace(col_of(value), rf"#{WORD}{WS}*", "")
    v = F.regexp_replace(v, r"\[[^\n]*?\]", "")
    return py_strip(v)


def descriptions(loc: DataFrame) -> DataFrame:
    """``base, loc_desc``: per name, the first non-empty cleaned description.

    A name's candidates are the keys ``name``, ``name_desc``,
    ``name_tooltip``, ``name_title`` in that order.  Instead of looking up four
    keys per block, every key is re-keyed to the base name it can describe,
    so a block needs a single equi-join on its name.
    """
    cands = [F.struct(F.col("key").alias("base"), F.lit(0).alias("prio"))]
    for prio, suf in enumerate(DESC_SUFFIXES[1:], start=1):
        cands.append(F.when(F.col("key").endswith(suf),
                            F.struct(F.expr(f"left(key, length(key) - {len(suf)})").alias("base"),
                                     F.lit(prio).alias("prio"))))
    rekeyed = (loc.select(clean_description("value").alias("desc"),
                          F.explode(F.filter(F.array(*cands), lambda x: x.isNotNull())).alias("c"))
                  .where(F.col("desc") != "")
                  .select("c.base", "c.prio", "desc"))
    return rekeyed.groupBy("base").agg(F.min_by("desc", "prio").alias("loc_desc"))


def key_prefix(key) -> Column:
    """``key.rsplit('_', 1)[0]`` (the key itself when it has no ``_``)."""
    k = col_of(key)
    return F.when(F.instr(k, "_") > 0, F.regexp_extract(k, r"^([\s\S]*)_", 1)).otherwise(k)


def loc_pairs(loc: DataFrame, min_size: int = 2, max_size: int | None = 20, oversize: str = "drop") -> DataFrame:
    """Instruction pairs for groups of keys sharing a prefix.

    ``max_size`` keys at most make a group (the original's 20; None: any
    number).  Larger groups are dropped as the original does, or, with
    ``oversize='split'``, dealt by a hash of the key into parts of about
    ``max_size`` keys, so no key is lost.

    Group sizes are counted first (a partial aggregate, so a prefix holding a
    third of all keys costs one counter) and joined back to the entries, whose
    side of the join can be split; with a bound no larger group is gathered.
    """
    keyed = loc.select("key", "value", key_prefix("key").alias("prefix"))
    sizes = keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_size)
    if max_size is not None and oversize == "drop":
        sizes = sizes.where(F.col("_n") <= max_size)
    parts = F.ceil(F.col("_n") / max_size) if max_size is not None and oversize == "split" else F.lit(1)
    entries = keyed.join(sizes, "prefix").withColumn("_part", F.pmod(keyed_hash("part", "key"), parts))
    grouped = entries.groupBy("prefix", "_part").agg(F.array_sort(F.collect_list(F.struct("key", "value"))).alias("kv"))
    return grouped.select(
        F.lit(SYSTEM_LOCALIZATION).alias("system"),
        F.replace(F.lit(LOC_INSTRUCTION), F.lit("{prefix}"), F.col("prefix")).alias("instruction"),
        F.concat(F.lit(LOC_HEADER + "\n"),
                 F.array_join(F.transform("kv", lambda x: F.concat(F.lit("  "), x["key"], F.lit(':0 "'),
                                                                   x["value"], F.lit('"'))), "\n")).alias("completion"),
        F.lit("localization").alias("category"),
        F.col("prefix").alias("name"))
