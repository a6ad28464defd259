"""Engine logs and data-type dumps to reference entries and instruction pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DATA_TYPE_QUESTION, LOG_QUESTIONS, SYSTEM_ENGINE
from ..functions.text import WSL, col_of, py_strip


def delimiter_re(dashes: int) -> str:
    """A line whose stripped form starts with ``dashes`` dashes, with the
    newline before it (or the start of the text)."""
    return rf"(?:^|\n){WSL}*-{{{dashes}}}[^\n]*"


def split_entries(df: DataFrame, dashes: int, text: str = "text") -> DataFrame:
    """One row per entry between delimiter lines: ``entry_no`` (1-based among
    non-empty entries) and ``entry`` (stripped).  Other columns are kept."""
    pieces = F.filter(F.transform(F.split(col_of(text), delimiter_re(dashes), -1), py_strip),
                      lambda x: x != "")
    return (df.select("*", F.posexplode(pieces).alias("entry_no", "entry"))
              .withColumn("entry_no", (F.col("entry_no") + 1).cast("long"))
              .drop(text))


def first_line(entry) -> Column:
    return py_strip(F.substring_index(col_of(entry), "\n", 1))


def log_entry_name(entry) -> Column:
    """First line, before `` - `` and then before ``:``, stripped."""
    return py_strip(F.substring_index(F.substring_index(first_line(entry), " - ", 1), ":", 1))


def data_type_name(entry) -> Column:
    """First line before ``(``, stripped."""
    return py_strip(F.substring_index(first_line(entry), "(", 1))


def log_question(category, name) -> Column:
    """Question chosen by the first matching substring of the category."""
    c = col_of(category)
    q = None
    for needle, text in LOG_QUESTIONS[:-1]:
        q = F.when(c.contains(needle), F.lit(text)) if q is None else q.when(c.contains(needle), F.lit(text))
    q = q.otherwise(F.lit(LOG_QUESTIONS[-1][1]))
    return F.replace(q, F.lit("{name}"), col_of(name))


def named_entries(entries: DataFrame, name, min_chars: int = 10) -> DataFrame:
    """``file, entry_no, name, entry`` of the entries of ``min_chars`` characters or
    more, however they were cut out of their files."""
    return (entries.where(F.length("entry") >= min_chars)
            .select("file", "entry_no", name("entry").alias("name"), "entry"))


def log_entries(logs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``file, entry_no, name, entry`` from log files (4-dash delimiters)."""
    return named_entries(split_entries(logs.select("file", "text"), 4), log_entry_name, min_chars)


def data_type_entries(types: DataFrame, min_chars: int = 10) -> DataFrame:
    """``file, entry_no, name, entry`` from data-type files (5-dash delimiters)."""
    return named_entries(split_entries(types.select("file", "text"), 5), data_type_name, min_chars)


def entry_counts(logs: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """Entries per file before the short-entry filter: ``kind, file, n_entries``.

    Counted from the size of each file's entry array: no shuffle.
    """
    def counted(df: DataFrame, dashes: int, kind: str) -> DataFrame:
        pieces = F.filter(F.transform(F.split("text", delimiter_re(dashes), -1), py_strip), lambda x: x != "")
        return df.select(F.lit(kind).alias("kind"), "file", F.size(pieces).cast("long").alias("n_entries"))
    out = counted(logs, 4, "log")
    if types is not None:
        out = out.unionByName(counted(types, 5, "data_type"))
    return out


def engine_reference(logs: DataFrame, log_categories: DataFrame,
                     types: DataFrame | None = None, min_chars: int = 10) -> DataFrame:
    """Reference pairs from logs (category by file name) and data-type files.

    ``log_categories`` maps ``file`` to ``category``; files without a
    category are not read.  The two sources are unioned by name.
    """
    known = logs.join(log_categories.select("file"), "file", "left_semi")
    return reference_pairs(log_entries(known, min_chars), log_categories,
                           None if types is None else data_type_entries(types, min_chars))


def reference_pairs(entries: DataFrame, log_categories: DataFrame, type_entries: DataFrame | None = None) -> DataFrame:
    """Reference pairs from entries (``file, name, entry``), cut out of whole files or of chunks of lines."""
    le = entries.join(log_categories.select("file", "category"), "file")
    out = le.select(F.lit(SYSTEM_ENGINE).alias("system"),
                    log_question("category", "name").alias("instruction"),
                    F.col("entry").alias("completion"), "category", "name",
                    F.concat(F.lit("logs/"), "file").alias("source_file"))
    if type_entries is not None:
        out = out.unionByName(type_entries.select(
            F.lit(SYSTEM_ENGINE).alias("system"),
            F.replace(F.lit(DATA_TYPE_QUESTION), F.lit("{name}"), F.col("name")).alias("instruction"),
            F.col("entry").alias("completion"), F.lit("data_type").alias("category"), "name",
            F.concat(F.lit("logs/data_types/"), "file").alias("source_file")))
    return out
