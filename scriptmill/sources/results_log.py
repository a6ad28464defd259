"""The sweep's tab-separated result log: append and read.

Appends go to a directory of part files with a header line each, so concurrent
sweeps never rewrite a shared file and an append runs on as many tasks as its
rows have partitions.  A line holds the eight result fields and, behind them,
the row's ``seq``: the order of the log is in the log, not in file names or
times.  Reading keeps the original's leniency: lines are stripped and split on
tabs, lines with fewer fields than the header are dropped, numeric fields that
do not parse become null.  Logs of the original tool have no ``seq`` field, and one
begun by it may be continued by ours: ``_numbered_fields`` says how such logs are
numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import EXPERIMENT_LOG_COLUMNS, RESULTS_COLUMNS
from ..functions.text import col_of, py_strip
from ..operators.ordered import position_by, running_max_by_seq
from ..operators.results import format_result_rows, normalise_log, typed_results


def append_results(rows: DataFrame, path: str, ts_col: str = "ts") -> None:
    """Format rows as result fields and append them as TSV; ``seq`` must be
    unique over all appends to a log."""
    (format_result_rows(rows, ts_col).select(*RESULTS_COLUMNS, "seq")
     .write.mode("append").option("sep", "\t").option("quote", "").option("escape", "")
     .option("header", "true").option("emptyValue", "").csv(path))


def quoted_fields(line) -> Column:
    """The tab-separated fields of a line; a field in double quotes loses them,
    keeps tabs, and ``""`` in it is one quote."""
    # possessive runs: fields of any length pass
    field = r'(?:^|\t)("[^"]*+(?:""[^"]*+)*+"(?=\t|$)|[^\t]*+)'
    bare = lambda x: F.when(x.rlike(r'^"[\s\S]*"$') & (F.length(x) >= 2), F.replace(
        F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
    return F.transform(F.regexp_extract_all(col_of(line), F.lit(field), F.lit(1)), bare)


def _numbered_fields(spark: SparkSession, path: str | list[str], columns, quoted: bool = False, strict: bool = False) -> DataFrame:
    """``seq`` and the fields of every line that has all of them, headers left out.

    A log whose lines all carry a number keeps it.  A log of lines without
    (the original tool's) is numbered in file order: modification time, path,
    place.  A log with both is numbered anew, from 0 without gaps: numbered lines
    stay in their order, and each line without a number stands behind the numbered
    ones whose files, and those of all numbered lines before them, are not newer
    than its own.  ``strict``: a line without a number raises.
    """
    text = py_strip("value") if not quoted else F.regexp_replace("value", r"[\r\n]+$", "")
    lines = spark.read.text(path).select(
        F.col("_metadata.file_modification_time").alias("_time"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_place"),
        (quoted_fields(text) if quoted else F.split(text, "\t", -1)).alias("_f"))
    rows = lines.where((F.size("_f") >= len(columns)) & (F.slice("_f", 1, len(columns)) != F.array(*[F.lit(c) for c in columns])))
    stored = F.expr(f"try_cast(get(_f, {len(columns)}) as bigint)")
    rows = rows.withColumn("_seq", stored).select("_time", "_file", "_block", "_place", "_seq", *[F.col("_f")[i].alias(c) for i, c in enumerate(columns)])
    if strict:
        known = F.coalesce("_seq", F.raise_error(F.lit("a line of the log has no number")).cast("bigint"))
        return rows.select(known.alias("seq"), *columns)
    own, foreign = rows.where("_seq is not null"), rows.where("_seq is null")
    if not foreign.limit(1).count():
        return own.select(F.col("_seq").alias("seq"), *columns)
    if not own.limit(1).count():
        return foreign.orderBy("_time", "_file", "_block", "_place").select(F.monotonically_increasing_id().alias("seq"), *columns)
    # a numbered line's time never falls in the order of the numbers
    timed = running_max_by_seq(own, "_time", "_seq", "_at").withColumn("_after", F.lit(0))
    merged = timed.unionByName(foreign.withColumn("_at", F.col("_time")).withColumn("_after", F.lit(1)))
    where = F.struct("_at", "_after", F.coalesce("_seq", F.lit(0)).alias("_seq"), F.when(F.col("_after") == 1, F.col("_file")).alias("_file"),
                     F.when(F.col("_after") == 1, F.col("_block")).alias("_block"), F.when(F.col("_after") == 1, F.col("_place")).alias("_place"))
    return position_by(merged.withColumn("_where", where), "_where", "seq").select("seq", *columns)


def read_results(spark: SparkSession, path: str, columns=RESULTS_COLUMNS) -> DataFrame:
    """Result rows with ``seq`` in log order; numeric fields parsed leniently."""
    return typed_results(_numbered_fields(spark, path, columns))


def read_new_results(spark: SparkSession, paths: list[str], columns=RESULTS_COLUMNS) -> DataFrame:
    """The result rows of some files of a log, numbered as stored."""
    return typed_results(_numbered_fields(spark, paths, columns, strict=True))


def read_new_experiments(spark: SparkSession, paths: list[str], columns=EXPERIMENT_LOG_COLUMNS) -> DataFrame:
    """The experiment rows of some files of a log, numbered as stored."""
    return normalise_log(_numbered_fields(spark, paths, columns, quoted=True, strict=True))


def append_experiments(rows: DataFrame, path: str, columns=EXPERIMENT_LOG_COLUMNS) -> None:
    """Append experiment rows as TSV lines with their ``seq``; line breaks
    inside a field become spaces, fields with tabs or quotes are quoted."""
    def written(c: str) -> Column:
        text = F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\r\n]", " ")
        return F.when(text.rlike(r'[\t"]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    # one column of whole lines: the writer quotes nothing by itself
    line = F.concat_ws("\t", *[written(c) for c in columns], F.col("seq").cast("string"))
    (rows.select(line.alias("\t".join([*columns, "seq"]))).write.mode("append").option("sep", "\x01").option("quote", "").option("escape", "")
     .option("header", "true").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))


def read_experiments(spark: SparkSession, path: str, columns=EXPERIMENT_LOG_COLUMNS) -> DataFrame:
    """The experiment log with ``seq`` in log order, normalised: quotes around
    fields taken off, numbers parsed leniently, status stripped and upper-cased."""
    return normalise_log(_numbered_fields(spark, path, columns, quoted=True))
