"""File sources and sinks: script trees, localization, engine logs, JSONL.

Files are read with Spark's ``binaryFile`` source (one row per file, content
as bytes) and decoded with the text rules of :mod:`..functions.text`.  The
extension and directory restrictions go into the load (glob and paths), so
unwanted files are never opened; unreadable files are skipped.  Whether a path
exists is asked of its own file system, so any URI that Spark can read works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import LOG_FILE_CATEGORIES, SCRIPT_EXTENSIONS
from ..functions.text import decode_text, is_blank, relative_path

SCRIPT_GLOB = "*.{" + ",".join(e.lstrip(".") for e in SCRIPT_EXTENSIONS) + "}"


def _binary(spark: SparkSession, paths: list[str] | str, glob: str, recursive: bool = True) -> DataFrame:
    r = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
         .option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true"))
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(paths)


def _hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, by the session's Hadoop settings."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI that file listings show for a path."""
    p, fs = _hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def _texts(spark: SparkSession, dirs: list[str], glob: str, root: str) -> DataFrame:
    """``path`` (below ``root``) and ``text`` of the files below the directories that exist."""
    found = [d for d in dirs if path_exists(spark, d)]
    if not found:
        return spark.createDataFrame([], "path string, text string")
    return _binary(spark, found, glob).select(relative_path("path", qualified(spark, root)).alias("path"),
                                              decode_text("content").alias("text"))


def scan_scripts(spark: SparkSession, root: str, subdirs: list[str] | None = None,
                 extensions_glob: str = SCRIPT_GLOB) -> DataFrame:
    """``path, text`` of every script file below ``root`` (or below the given
    subdirectories of it); ``path`` is relative to ``root`` with ``/``."""
    root = root.rstrip("/")
    return _texts(spark, [f"{root}/{d}" for d in subdirs] if subdirs else [root], extensions_glob, root)


def scan_localization(spark: SparkSession, root: str, lang: str = "english") -> DataFrame:
    """``path, text`` of ``localization/<lang>/**/*.yml``; empty when absent."""
    root = root.rstrip("/")
    return _texts(spark, [f"{root}/localization/{lang}"], "*.yml", root)


def _named(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``file, text`` of the files right in a folder; empty when it is absent."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "file string, text string")
    return _binary(spark, folder, glob, recursive=False).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), decode_text("content").alias("text"))


def scan_logs(spark: SparkSession, logs_dir: str, log_files=LOG_FILE_CATEGORIES) -> DataFrame:
    """``file, text`` of the named engine logs; missing or blank ones skipped."""
    names = [n for n, _ in log_files]
    return _named(spark, logs_dir, "*.log").where(F.col("file").isin(names) & ~is_blank("text"))


def scan_data_types(spark: SparkSession, logs_dir: str) -> DataFrame:
    """``file, text`` of ``data_types/*.txt`` below the logs directory."""
    return _named(spark, f"{logs_dir.rstrip('/')}/data_types", "*.txt")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line with an explicit schema (no inference pass); a
    line that is no JSON is an error, as in the original."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 JSON lines, non-ASCII kept, null fields written as null."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_reports(reports: DataFrame, path: str, report: str = "report", mode: str = "append") -> None:
    """Evaluation reports or run metrics, one JSON object per line."""
    reports.select(F.col(report).alias("value")).write.mode(mode).text(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """``report``: the JSON text of every stored report."""
    return spark.read.text(path).select(F.col("value").alias("report"))


def dataset_sizes(spark: SparkSession, datasets: dict[str, str]) -> DataFrame:
    """``dataset, records, mb`` for JSON-lines datasets; ``found = false``
    (records and mb null) for a missing one.  Sizes come from the files'
    metadata (distinct files), records from a count."""
    rows = []
    for name, path in datasets.items():
        if not path_exists(spark, path):
            rows.append(spark.createDataFrame([(name,)], "dataset string")
                        .select("dataset", F.lit(None).cast("long").alias("records"),
                                F.lit(None).cast("double").alias("mb"), F.lit(False).alias("found")))
            continue
        df = spark.read.text(path).select("_metadata.file_path", "_metadata.file_size")
        records = df.agg(F.count(F.lit(1)).alias("records"))
        mb = (df.select("file_path", "file_size").distinct().agg(F.sum("file_size").alias("b"))
                .select(F.round(F.col("b") / 1048576.0, 1)).scalar())
        rows.append(records.select(F.lit(name).alias("dataset"), "records", mb.alias("mb"), F.lit(True).alias("found")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
